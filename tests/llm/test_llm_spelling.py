"""Spelling variants against plain definitions."""

import re
import zlib
from collections import Counter

import pytest

from tickframe.llm import spelling


def slow_words(rows, damage=31):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def slow_variants(words):
    form, near = {}, {}
    for w in words:
        some = sorted((x for x in words if one_edit(w, x)), key=lambda x: (-words[x], x))
        near[w] = len(some)
        form[w] = some[0] if some and words[some[0]] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], near[w], words[form[w]] if form[w] else None)
    return out


@pytest.fixture(scope="module")
def texts(corpus):
    import random
    rng = random.Random(11)
    base = ["mountain", "fountain", "stationery", "stationary", "Àlarmënde", "grüßende", "aaaaaaaa", "abababab", "xylophone"]
    rows = [(None if k % 50 == 0 else k, " ".join(rng.choices(base, weights=[60, 1, 30, 3, 20, 20, 9, 9, 2], k=40)) + "あmountainÂ Āfountains")
            for k in range(300)]
    for k in range(300):                                  # rare misspellings by hand, every kind and place
        w = rng.choice(base)
        at = rng.randrange(len(w) + 1)
        w = rng.choice([w[:at] + w[at + 1:], w[:at] + "q" + w[at:], w[:at] + "é" + w[at + 1:]])
        rows.append((1000 + k, f"{w} {w.upper()}"))
    return rows + corpus + corpus[:3] + [(5, "Z" * 70 + " " + "Z" * 70 + " " + "z" * 71 + " " + "z" * 72)] * 2


def read(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("block", [4, 2048])
def test_variants_are_the_plain_ones(spark, texts, block):
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = read(spelling.variants(docs, block=block))
    want = slow_variants(slow_words(texts))
    assert got == want
    assert any(f and r != f for f, r, *_ in got.values()) or sum(1 for f, *_ in got.values() if f) > 20


def test_chains_end_at_the_root(spark):
    rows = [(1, " ".join(["abcdefgh"] * 3000 + ["abcdefgx"] * 250 + ["abcdefyx"] * 20 + ["abcdezyx"] * 2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = read(spelling.variants(docs, damage=0))
    assert got == slow_variants(slow_words(rows, damage=0))
    assert got["abcdezyx"][1] == "abcdefgh"


def test_edges(spark, nothing, messy):
    assert spelling.variants(nothing).count() == 0
    assert read(spelling.variants(messy)) == slow_variants(slow_words([(r["doc_id"], r["text"]) for r in messy.collect()]))


def test_query_on_the_table(spark):
    from tests.conftest import SF001
    from tickframe.llm.queries import queries
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert read(queries()["op13_spelling"](spark, SF001)) == slow_variants(slow_words(rows))
