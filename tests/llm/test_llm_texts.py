"""Decontamination, license scans, packing, preference pairs and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF01
from tests.harness import compare, duck
from tickframe.llm import chat, decontaminate, licenses, packing, queries


# ---------------------------------------------------------------- decontamination
def slow_align(passage, item):
    best, row = 0, [0] * (len(passage) + 1)
    for w in item:
        new = [0] * (len(passage) + 1)
        for j, x in enumerate(passage, 1):
            new[j] = max(0, row[j - 1] + (2 if w == x else -1), row[j] - 1, new[j - 1] - 1)
        row, best = new, max(best, *new)
    return best


def test_alignment_equals_the_slow_one():
    rng = random.Random(1)
    for _ in range(80):
        a = np.array(rng.choices(range(4), k=rng.randint(1, 25)), np.uint64)
        b = np.array(rng.choices(range(4), k=rng.randint(1, 12)), np.uint64)
        score, start, end = decontaminate.align(a, b)
        assert score == slow_align(a.tolist(), b.tolist()) and 0 <= start <= end <= len(a)
        assert slow_align(a[start:end].tolist(), b.tolist()) == score if score else True


@pytest.fixture(scope="module")
def leaky(spark, vocabulary):
    rng = random.Random(8)
    items = [(k, " ".join(rng.choices(vocabulary, k=30))) for k in range(30)] + [(90, "two words"), (91, None), (92, "")]
    rows, expect = [], set()
    for i in range(120):
        w = rng.choices(vocabulary, k=rng.randint(60, 200))
        if i % 3 == 0:
            item = rng.randrange(30)
            copy = items[item][1].split()
            for _ in range(i % 4):                        # up to three edits
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["added", copy[at]], ["changed"]])
            w[20:20] = [x.upper() + "," if i % 2 else x for x in copy]
            expect.add((i, item))
        rows.append((i, " ".join(w)))
    rows += [(500, None), (501, ""), (502, "these two words stand here")]
    expect.add((502, 90))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), expect


@pytest.mark.parametrize("words", [4_000_000, 300])
def test_leaks_are_found_in_blocks_too(leaky, words):
    docs, items, expect = leaky
    got = decontaminate.find_leaks(docs, items, block_words=words).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expect
    assert all(r["score"] >= 0.5 and r["end"] > r["start"] for r in got)


def test_edited_copies_are_found_as_by_plain_alignment(spark, vocabulary):
    """5 to 9 spread edits, alone in the corpus and beside a verbatim copy; items of frequent pairs; short items."""
    rng = random.Random(12)
    items = [(k, rng.choices(vocabulary, k=30)) for k in range(20)] + [(50 + n, rng.choices(vocabulary, k=n)) for n in range(3, 9)]
    items += [(60, (vocabulary[:6] * 5)), (61, vocabulary[:6] + rng.choices(vocabulary, k=20))]
    rows = []
    for k, (_, item) in enumerate(items):
        for way in range(6):
            copy, edits = list(item), min(5 + (k + way) % 5, len(item) // 3)
            places = [len(item) * j // edits for j in range(edits)] if way % 2 else rng.sample(range(len(item)), edits)
            for at in sorted(places, reverse=True):
                copy[at:at + 1] = [["edited%d" % rng.randrange(10**6)], ["edited%d" % rng.randrange(10**6)], [], ["added", copy[at]]][rng.randrange(4) if way > 2 else 0]
            w = rng.choices(vocabulary, k=40)
            w[20:20] = copy
            rows.append((len(rows), " ".join(w)))
        if k % 2:
            rows.append((len(rows), " ".join(item)))
    rows += [(len(rows) + j, " ".join(vocabulary[:6] * 8)) for j in range(5)]
    number = {w: j for j, w in enumerate({w for _, t in rows for w in t.split()} | {w for _, i in items for w in i})}
    coded = [(k, np.array([number[w] for w in i], np.uint64)) for k, i in items]
    scores = {(d, k): decontaminate.align(np.array([number[w] for w in t.split()], np.uint64), i)[0] / (2 * len(i)) for d, t in rows for k, i in coded}
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                   spark.createDataFrame([(k, " ".join(i)) for k, i in items], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == {x: s for x, s in scores.items() if s >= 0.5}


def test_clean_documents_stay(leaky, messy, nothing, spark):
    docs, items, expect = leaky
    kept = {r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in expect}
    out = decontaminate.without_leaks(messy, items)
    assert out.columns == messy.columns and out.count() == messy.count()
    assert decontaminate.find_leaks(nothing, items).collect() == []
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("words", [4_000_000, 40])
def test_leaking_rows_go_whatever_their_ids(spark, vocabulary, words):
    rng = random.Random(13)
    items = [(k, " ".join(rng.choices(vocabulary, k=30))) for k in range(3)]
    prose = [" ".join(rng.choices(vocabulary, k=50)) for _ in range(8)]
    clean = [(None, prose[0], 1), (None, prose[1], 2), (None, None, 3), (7, prose[2], 4), (7, prose[3], 5), (8, prose[4], 6), (None, "", None)]
    bad = [(None, f"{prose[5]} {items[0][1]}", 7), (7, f"{items[1][1]} {prose[6]}", 8), (9, items[2][1], 9)]
    docs = spark.createDataFrame(clean + bad, "doc_id long, text string, more long")
    out = decontaminate.without_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=words)
    assert out.schema == docs.schema and Counter(map(tuple, out.collect())) == Counter(clean)


def test_every_verbatim_passage_of_the_tables_is_found(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    full = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if i["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert full <= got and len(got) <= len(full) + 3


# ---------------------------------------------------------------- licenses
def test_license_rows(spark, messy, nothing):
    rows = [(1, "Released under the MIT License."), (2, "GNU  General-Public\nLICENSE, gnu general public license"), (3, "CC BY-NC 4.0 cc by"),
            (4, "This is under the GNU Genral Publc License v3"), (5, "licenced undr the Apache License"), (6, None), (7, ""), (8, "mit"),
            (9, "é Permission is hereby granted, free of chage, to any person obtaning a copy"), (10, "plain prose, nothing else " * 50),
            (11, "Apache"), (12, "License 2.0")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        hits = [(k, v) for p, v in licenses.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted({v for _, v in hits})))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[4]["labels"] == "gpl" and got[4]["base_labels"] == "" and 0.8 < got[4]["score"] < 1
    assert got[5]["labels"] == "apache" and got[9]["labels"] == "mit" and not got[10]["labels"]
    span = got[4]["finds"][0]
    assert rows[3][1][span["start"]:span["end"]] == "GNU Genral Publc License" and span["edits"] == 2
    s9 = got[9]["finds"][0]
    assert rows[8][1][s9["start"]:s9["end"]].startswith("Permission") and rows[8][1][s9["start"]:s9["end"]].endswith("copy")
    assert licenses.scan_licenses(messy).count() == messy.count() and licenses.scan_licenses(nothing).collect() == []


def test_seeds_are_a_pigeonhole_cut():
    for n, (text, _, most) in enumerate(licenses.NOTICES):
        own = [s for s in licenses.seeds() if s.notice == n]
        assert len(own) == most + 1 and b"".join(s.piece for s in own) == text.encode()


# ---------------------------------------------------------------- packing
def slow_cuts(place, cost, size):
    best = {0: (0.0, [])}
    for j, c in zip(place, cost):
        last = j == place[-1]
        best[j] = min((best[i][0] + (0 if last else size - (j - i) + c), best[i][1] + [j]) for i in best if j - size <= i < j)
    return best[place[-1]][0]


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        place = sorted(rng.sample(range(1, 120), rng.randint(5, 40)))
        place = sorted({*place, *range(10, place[-1], 10)})
        cost = [rng.choice([0.0, 1.0, 9.0]) for _ in place]
        got = packing.cuts(place, cost, 24)
        at = [0, *got]
        assert all(b - a <= 24 for a, b in zip(at, at[1:])) and got[-1] == place[-1]
        value = sum(24 - (b - a) + cost[place.index(b)] for a, b in zip(at, at[1:-1]))
        assert abs(value - slow_cuts(place, cost, 24)) < 1e-9


@pytest.fixture(scope="module")
def encoded(corpus):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.tokenizer_path())
    return {i: [*t.encode(x or "", add_special_tokens=False).ids, packing.END_ID] for i, x in corpus}


def test_pieces_cover_every_document(docs, encoded):
    rows = packing.pack(docs).collect()
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) > 0
    assert set(own) == set(encoded)
    for i, parts in own.items():
        parts.sort(key=lambda r: r["start"])
        assert sum((r["ids"] for r in parts), []) == encoded[i]
        assert [r["start"] for r in parts] == np.cumsum([0, *[r["length"] for r in parts]])[:-1].tolist()
        assert {r["doc_tokens"] for r in parts} == {len(encoded[i])}
    total = padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda r: r["offset"])
        n = sum(r["length"] for r in parts)
        assert [r["offset"] for r in parts] == np.cumsum([0, *[r["length"] for r in parts]])[:-1].tolist() and n <= 2048
        total += n
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding < 0.02 * total


def test_words_are_encoded_as_in_their_text():
    import pyarrow as pa
    from tokenizers import Tokenizer
    texts = ["it's John's. e.g. 3.14, don't!!", "<|endoftext|> a <|ENDOFTEXT|>b", "ÀÉ İstanbul ß ẞ ﬁ Å å", "x y z\u0085w", "日本語。テスト", "a" * 3000,
             "tab\tnew\nline\x0bv\x0cf", "mixed123abc,.;x?!y", "'s 't 're", "ª º µ", "end.", "", "Ω Σς ΑΣ", "😀 👍🏽 ok"]
    t = Tokenizer.from_file(packing.tokenizer_path())
    words = packing.WordIds(packing.tokenizer_path())
    from tickframe.llm.blocks import pieces
    for limit in (1, 40, 1 << 20):
        got = []
        for lo, hi, off, data in pieces(pa.array(texts), limit):
            ids, counts, _ = words.ids(off, data)
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [[*t.encode(x, add_special_tokens=False).ids, packing.END_ID] for x in texts]


def test_word_cache_starts_anew_when_full(monkeypatch, vocabulary):
    import pyarrow as pa
    from tickframe.llm.blocks import pieces
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    words = packing.WordIds(packing.tokenizer_path())
    rng = random.Random(1)
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([5, 40, 300]))) for _ in range(30)]
    for lo, hi, off, data in pieces(pa.array(texts), 200):
        ids, counts, _ = words.ids(off, data)
        for x, part in zip(texts[lo:hi], np.split(ids, np.cumsum(counts)[:-1])):
            assert part.tolist() == [*words.tokenizer.encode(x, add_special_tokens=False).ids, packing.END_ID]


def test_rows_without_an_id_are_several_streams(spark, vocabulary):
    rng = random.Random(12)
    rows = [(None, " ".join(rng.choices(vocabulary, k=60))) for _ in range(400)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len({r["sequence_id"] >> 40 for r in out}) > 1 and all(r["doc_id"] is None for r in out)
    assert sum(r["length"] for r in out) == sum(r["doc_tokens"] for r in out if r["start"] == 0)
    assert sum(r["start"] == 0 for r in out) == len(rows)


def test_packing_of_messy_rows(messy, nothing):
    ids = Counter(r["doc_id"] for r in packing.pack(messy).filter("start = 0").collect())
    assert ids == Counter(r["doc_id"] for r in messy.collect())
    assert packing.pack(nothing).collect() == []


# ---------------------------------------------------------------- preference pairs
def test_common_prefix_and_masks(spark):
    turns = chat.TURNS
    pairs = spark.createDataFrame([
        (1, [("user", "hi"), ("assistant", "yes"), ("user", "go")], [("user", "hi"), ("assistant", "no")]),
        (2, [("user", "same")], [("user", "same")]),
        (3, [], [("assistant", "é\U0001F600")]),
        (4, [("user", "a"), ("assistant", "b")], [("user", "a")]),
    ], f"pair_id long, chosen {turns}, rejected {turns}")
    got = {r["pair_id"]: r for r in chat.format_pairs(pairs).collect()}
    assert got[1]["prompt"] == "<|user|>\nhi<|end|>\n" and got[1]["prompt_turns"] == 1
    assert got[1]["chosen"] == "<|assistant|>\nyes<|end|>\n<|user|>\ngo<|end|>\n"
    for i, side in ((1, "chosen"), (1, "rejected"), (3, "rejected"), (4, "chosen")):
        (s, e), = got[i][f"{side}_mask"]
        assert got[i][side][:s].endswith("<|assistant|>\n") and got[i][side][s:e].endswith("<|end|>\n")
    assert (got[2]["prompt_turns"], got[2]["chosen"], got[2]["rejected"], got[2]["chosen_mask"]) == (1, "", "", [])
    assert got[3]["prompt"] == "" and got[4]["rejected"] == ""


def test_the_next_conversation_is_the_next_id_with_an_answer(spark):
    rng = random.Random(9)
    ids = sorted(rng.sample(range(-10**6, 10**6), 120)) + [(1 << 63) - 1, -1 << 63]
    rows = [(i, 0, "user", "q") for i in ids]
    answered = sorted(i for k, i in enumerate(ids) if k % 3 or i < -10**6)
    rows += [(i, 1, "assistant", f"a{i}") for i in answered] + [(None, 1, "assistant", "none")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r["pair_id"]: [t["text"] for t in r["rejected"]] for r in chat.preference_pairs(df).collect()}
    assert got == {i: ["q"] + [f"a{n}" for n in nxt] for i, nxt in zip(answered, [*([x] for x in answered[1:]), []])}


def test_pairs_of_messy_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, pair_id string, chosen string"
    rows = [(1, 0, "user", "a", "x", "x"), (1, 1, "assistant", "b", "x", "x"), (1, 1, "assistant", "b", "x", "x"), (2, 0, None, None, "x", "x"),
            (2, None, "assistant", "late", "x", "x"), (3, 0, "user", "alone", "x", "x"), (None, 0, "assistant", "n", "x", "x")]
    got = {r["pair_id"]: r for r in chat.format_pairs(chat.preference_pairs(spark.createDataFrame(rows, schema))).collect()}
    assert set(got) == {1, 2}
    assert got[1]["prompt_turns"] == 2 and got[1]["rejected"] == "<|assistant|>\nlate<|end|>\n"
    assert got[2]["prompt"] == "<|" + "|>\n<|end|>\n" and got[2]["rejected"] == ""
    assert chat.format_pairs(chat.preference_pairs(spark.createDataFrame([], schema))).collect() == []


# ---------------------------------------------------------------- registered queries
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    ok, said = compare(queries.queries()[name](spark, SF01), duck(SF01), queries.oracle_sql()[name])
    assert ok, said


def test_every_query_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 14)} and set(queries.queries()) | {"pipeline"} <= names
