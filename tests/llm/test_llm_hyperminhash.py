"""HyperMinHash near-duplicates against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF01
from tests.harness import compare, duck
from tests.llm.test_llm_hashing import brute
from tickframe.llm import hyperminhash, jaccard, queries
from tickframe.llm.blocks import mix, text_bytes


def plain(rows, words=5, percent=80):
    return Counter({(i, n, c, i == c): 0 for i, n, c, _ in brute(rows, words, percent)}) + Counter(
        (i, n, c, i == c) for (i, n, c, _), m in brute(rows, words, percent).items() for _ in range(m))


def read(df):
    return Counter(map(tuple, df.collect()))


def sets(rng, n, j):
    """Two random sets of about ``n`` hashes with Jaccard similarity ``j``."""
    h = mix(np.array(rng.sample(range(1 << 60), 2 * n), np.uint64))
    both = round(2 * n * j / (1 + j))
    return np.sort(h[:n]), np.sort(np.append(h[n - both:n], h[n:2 * n - both]))


def regs(*some):
    row = np.repeat(np.arange(len(some)), [len(s) for s in some])
    return hyperminhash.registers(row, np.concatenate(some), len(some))


def test_registers_are_those_of_the_least_hashes():
    rng = random.Random(1)
    h = [rng.getrandbits(64) for _ in range(700)] + [5, 1 << 56, (1 << 56) + 1]
    want = np.zeros(256, np.uint16)
    for b in range(256):
        mine = [x & ((1 << 56) - 1) for x in h if x >> 56 == b]
        if mine:
            bits = f"{min(mine):056b}"
            zeros = len(bits) - len(bits.lstrip("0"))
            want[b] = 1 + (min(zeros, 62) << 10) + int((bits[zeros + 1:] + "0" * 70)[:10], 2)
    assert (regs(np.sort(np.array(h, np.uint64)))[0] == want).all()


@pytest.mark.parametrize("n", [12, 100, 3000])
def test_estimates_and_bands(n):
    rng = random.Random(n)
    for j in (0.0, 0.5, 0.85):
        got, hits = [], 0
        for _ in range(60):
            r = regs(*sets(rng, n, j))
            equal, used = int(((r[0] == r[1]) & (r[0] > 0)).sum()), int(((r[0] > 0) | (r[1] > 0)).sum())
            got.append(hyperminhash.estimate(np.array([equal]), np.array([used]), np.array([n]))[0])
            keys = hyperminhash.band_keys(r)
            hits += bool((keys[0] == keys[1]).any())
        assert abs(np.mean(got) - j) < 0.06
        if j == 0.0:
            assert hits == 0
        if j == 0.85:
            assert hits == 60


def test_chance_collisions():
    """The expected share of equal registers of disjoint sets, with few bits so that it can be seen."""
    rng = np.random.default_rng(5)
    assert 0.1 / 1024 < hyperminhash.collision_table()[20] < 0.4 / 1024
    row = np.repeat(np.arange(400), 2000)
    h = rng.integers(0, 1 << 63, 800_000, dtype=np.uint64) * np.uint64(2)
    order = np.lexsort((h, row))
    r = hyperminhash.registers(row, h[order], 400)
    zeros = (r.astype(int) - 1) >> 7                      # three bits of mantissa are left
    share = (zeros[::2] == zeros[1::2]).mean()
    table = hyperminhash.collision_table()[22] * 128      # the cells are 128 times as wide
    assert abs(share / table - 1) < 0.1


def test_sets_and_signatures_are_those_of_the_texts(corpus):
    texts = [t for _, t in corpus]
    off, data = text_bytes(pa.array(texts, pa.string()))
    for k in (1, 3, 4):
        row, h = hyperminhash.shingles(off - off[0], data[off[0]:], k)
        want = list(jaccard.shingle_sets(off, data, k))
        n, sig = hyperminhash.signatures(row, h, len(texts))
        assert [h[row == r].tolist() for r in range(len(texts))] == [s.tolist() for s in want]
        assert sig == [jaccard.signature(s) for s in want] and n.tolist() == [len(s) for s in want]


@pytest.mark.parametrize("k, percent", [(4, 80), (2, 60)])
def test_rows_equal_brute_force(docs, corpus, k, percent):
    assert read(hyperminhash.near_duplicates(docs, k, percent)) == plain(corpus, k, percent)


@pytest.mark.parametrize("direct, block", [(64, 512), (1, 8)])
def test_large_groups(spark, vocabulary, monkeypatch, direct, block):
    """Groups of near copies, some linked only through others, and many documents that share half their text."""
    monkeypatch.setattr(hyperminhash, "DIRECT", direct)
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rng = random.Random(3)
    rows, base = [], [rng.choice(vocabulary) for _ in range(120)]
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(base[:80] + rng.choices(vocabulary, k=30 + i % 20))) for i in range(80)]
    rows += [(None if i % 3 else 77, rows[i][1]) for i in range(40)] + [(None, " ".join(base[1:]))] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert read(hyperminhash.near_duplicates(df, 3, 80)) == plain(rows, 3, 80)


def test_edges(spark, messy, nothing):
    assert hyperminhash.near_duplicates(nothing).collect() == []
    assert read(hyperminhash.near_duplicates(messy)) == plain([(r["doc_id"], r["text"]) for r in messy.collect()])


def test_query_matches_its_sql(spark):
    ok, message = compare(queries.queries()["op11_hyperminhash"](spark, SF01), duck(SF01), queries.oracle_sql()["op11_hyperminhash"])
    assert ok, message
