"""Fingerprints, Jaccard join and sharding against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickframe.llm import fingerprint, jaccard, sharding
from tickframe.llm.fingerprint import PrefixHash, likeness


# ---------------------------------------------------------------- fingerprints
def test_span_equality_and_extensions():
    rng = random.Random(1)
    for _ in range(60):
        a = "".join(rng.choices("ab", k=rng.randint(0, 40)))
        b = "".join(rng.choices("ab", k=rng.randint(0, 40)))
        x, y = PrefixHash(a), PrefixHash(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        most = min(len(a) - i, len(b) - j)
        assert x.common_extension(i, y, j, most) == next((k for k in range(most) if a[i + k] != b[j + k]), most)
        back = min(i, j)
        assert x.common_extension(i, y, j, back, back=True) == next((k for k in range(back) if a[i - 1 - k] != b[j - 1 - k]), back)
        assert (x.digest() == y.digest()) == (a == b)


def test_likeness_orders_texts():
    rng = random.Random(2)
    a = "".join(rng.choices("abcdefgh ", k=2000))
    edit = a[:700] + "XYZ" + a[705:]
    other = "".join(rng.choices("abcdefgh ", k=2000))
    assert likeness(PrefixHash(a), PrefixHash(a))[0] == 1
    assert likeness(PrefixHash(a), PrefixHash(edit))[0] > 0.95 > 0.2 > likeness(PrefixHash(a), PrefixHash(other))[0]
    moved = a[900:] + a[:900]
    assert likeness(PrefixHash(a), PrefixHash(moved))[0] > 0.8
    assert likeness(PrefixHash(""), PrefixHash(""))[0] == 1 and likeness(PrefixHash(""), PrefixHash("a"))[0] == 0


def test_fingerprints_of_neighbours(docs, corpus):
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    text = {i: t or "" for i, t in corpus}
    ids = sorted(text, reverse=True)
    assert set(got) == set(ids)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        t, half = text[i], len(text[i]) // 2
        edit = t[:len(t) - half] + text[nxt][:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edit.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (PrefixHash(t).digest(), PrefixHash(edit).digest())
        assert 0 <= r["near_next"] <= 1 and r["near_edited"] == likeness(PrefixHash(t), PrefixHash(edit))[0]


def test_many_rows_of_one_id_or_none_are_several_ranges(spark):
    rng = random.Random(14)
    texts = ["".join(rng.choices("abcd ", k=rng.randint(1, 40))) for _ in range(900)]
    rows = [(None if k < 300 else 7 if k < 600 else k - 500, t) for k, t in enumerate(texts)] + [(None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spread = fingerprint.with_next(df).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) <= 300
    hashes = {r["t"]: r["h"] for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -hashes[r[1]], r[1]))
    want = Counter()
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        want[i, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in fingerprint.fingerprints(df).collect()) == want


def test_fingerprints_of_messy_rows(spark, messy, nothing):
    rows = fingerprint.fingerprints(messy).collect()
    assert len(rows) == messy.count() and sum(r["doc_id"] is None for r in rows) == 2
    assert fingerprint.fingerprints(nothing).collect() == []
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert fingerprint.fingerprints(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


# ---------------------------------------------------------------- Jaccard join
def brute(rows, k, percent):
    sets, index, links, root = {}, defaultdict(list), Counter(), {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (_, t) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group(0).lower(), t or ""))
        sets[n] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
        root[n] = n
        common = Counter(m for s in sets[n] for m in index[s])
        for s in sets[n]:
            index[s].append(n)
        for m, c in common.items():
            if 100 * c >= percent * (len(sets[n]) + len(sets[m]) - c):
                links[n] += 1
                links[m] += 1
                root[find(n)] = find(m)
    ids = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        ids[find(n)].append(i)
    least = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return Counter((i, len(sets[n]), least[find(n)], links[n]) for n, (i, _) in enumerate(rows))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_classes_equal_brute_force(docs, corpus, k, percent):
    got = Counter(map(tuple, jaccard.classes(docs, k, percent).collect()))
    assert got == brute(corpus, k, percent)


@pytest.mark.parametrize("bounded", [1 << 16, 4])
def test_blocks_of_a_large_group(spark, vocabulary, monkeypatch, bounded):
    """A group of near copies larger than the direct join, than a block, and than a bounded bucket."""
    monkeypatch.setattr(jaccard, "BOUNDED", bounded)
    rng = random.Random(3)
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "DIRECT", 6)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.classes(df, 3, 80).collect())) == brute(rows, 3, 80)


def test_rows_sent_to_blocks_do_not_grow_with_the_square_of_a_group(spark, vocabulary, monkeypatch):
    """A class goes once to each frequent shingle, whatever the number of blocks; links and components stay exact."""
    from pyspark.sql import functions as F
    rng = random.Random(9)
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randint(1, 5)):
            w[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i if i % 50 else None, " ".join(w)))
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    sent, before = {}, jaccard.block_links

    def counted(found, *more):
        sent["shingles"] = found.select(F.explode("found.p").alias("p")).filter(F.col("p") > jaccard.DIRECT).count()
        sent["rows"] = 0
        Frame, Groups = type(spark.range(1)), type(spark.range(1).groupBy())
        grouped, mapped = Groups.applyInArrow, Frame.mapInArrow

        def count_grouped(data, *args, **kw):
            sent["rows"] += data._df.count()
            return grouped(data, *args, **kw)

        def count_mapped(df, *args, **kw):
            sent["rows"] += df.count()
            return mapped(df, *args, **kw)

        with monkeypatch.context() as m:
            m.setattr(Groups, "applyInArrow", count_grouped)
            m.setattr(Frame, "mapInArrow", count_mapped)
            out = before(found, *more)
        sent["links"] = out.count()
        return out

    monkeypatch.setattr(jaccard, "block_links", counted)
    got = Counter(map(tuple, jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()))
    assert got == brute(rows, 3, 80)
    assert sent["shingles"] > 2000 and sent["links"] < sent["shingles"]
    assert sent["rows"] < 1.5 * sent["shingles"]


def test_classes_are_compared_where_enough_common_shingles_can_follow(spark):
    """Of five frequent shingles a class that asks for three needs the three rarest alone, and one that has two needs none."""
    D = jaccard.DIRECT
    rows = [(1, 3, [(t, D + 9 - t) for t in range(5)] + [(50, 2)]), (2, 3, [(t, D + 9 - t) for t in range(5)]),
            (3, 4, [(3, D + 6), (4, D + 5)]), (4, 3, [(0, D + 9), (1, D + 8)])]
    df = spark.createDataFrame(rows, "cid long, matches int, found array<struct<token:long,p:long>>")
    got = {(r["cid"], r["token"], r["place"], r["p"]) for r in jaccard.compared_under(df).collect()}
    assert got == {(c, t, 4 - t, 2) for c in (1, 2) for t in (4, 3, 2)}


def test_one_of_each(docs, corpus, messy, nothing):
    kept = {r["doc_id"] for r in jaccard.one_of_each(docs).select("doc_id").collect()}
    assert kept == {i for (i, _, c, _) in brute(corpus, 5, 80) if i == c}
    out = jaccard.one_of_each(messy)
    assert out.columns == messy.columns and out.filter("doc_id is not null").count() == len({r[0] for r in messy.filter("doc_id is not null").select("doc_id").collect()})
    assert jaccard.classes(nothing).collect() == [] and jaccard.one_of_each(nothing).collect() == []


def test_one_of_each_decides_rows_of_null_and_repeated_ids_by_class(spark, vocabulary):
    rng = random.Random(21)
    text = [" ".join(rng.choices(vocabulary, k=80)) for _ in range(12)]

    def near(t):
        return t + " and more"

    stay = [(1, text[0]), (2, text[1]), (None, text[2]), (None, text[3]), (5, text[4]), (12, text[5]), (None, None), (None, ""), (20, ""), (20, None)]
    go = [(None, near(text[0])), (5, near(text[1])), (5, text[1]), (12, text[5]), (13, text[5]), (None, text[5]), (None, near(text[5]))]
    one = [{(6, text[6]), (6, near(text[6]))}, {(None, text[7]), (None, near(text[7]))}]   # either one stays
    rows = stay + go + [r for pair in one for r in pair] + [(None, text[3])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sig string").repartition(4)
    out = jaccard.one_of_each(df)
    assert out.schema == df.schema
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    for pair in one:
        assert sum(r in pair for r in kept) == 1
    assert Counter(r for r in kept if not any(r in pair for pair in one)) == Counter(stay)


def test_prefix_asks_for_more_matches_under_frequent_shingles():
    import numpy as np
    s = np.sort(np.random.default_rng(0).integers(0, 2**63, 200).astype(np.uint64))
    few, many = np.zeros(1 << jaccard.BUCKET_BITS, np.int64), np.full(1 << jaccard.BUCKET_BITS, 1000)
    assert jaccard.prefix_of(s, few, 1.0, 90)[0] == 1 < jaccard.prefix_of(s, many, 1.0, 90)[0]
    assert len(jaccard.prefix_of(s, few, 1.0, 90)[1]) == 200 - 180 + 1


# ---------------------------------------------------------------- sharding
def test_shards_are_even_and_slots_gapless(spark, corpus):
    rng = random.Random(4)
    rows = [(k, "copy of one text" if k % 3 == 0 else "x" * rng.randint(0, 60)) for k in range(6000)] + [(7000, None)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=10, range_bytes=4000).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    total, slots = Counter(), defaultdict(list)
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(total) == list(range(10))
    assert max(total.values()) - min(total.values()) <= 0.02 * sum(total.values()) / 10
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("copies", [1000, 4000])
def test_repeated_rows_are_cut_too(spark, copies):
    """Rows equal in id and text, more than a shard holds: shards stay even, slots gapless, columns their own."""
    rng = random.Random(6)
    rows = [(k, "x" * rng.randint(0, 60), "a", k) for k in range(2000)]
    rows += [(None, "the same text without an id", "b", -k) for k in range(copies)] + [(7, None, "c", 0)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, _part long").repartition(6)
    got = sharding.shard(df, shards=8, range_bytes=9000)
    assert got.columns == [*df.columns, "size", "slot", "shard"]
    out = got.collect()
    assert Counter((r["doc_id"], r["text"], r["_key"], r["_part"]) for r in out) == Counter(rows)
    total, slots = Counter(), defaultdict(list)
    for r in out:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(total) == list(range(8)) and max(total.values()) - min(total.values()) <= 160
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_histogram_counts_exactly(spark):
    keys = spark.range(500).select(sharding.sort_key("id", "id").alias("key"), F.lit(3).cast("long").alias("size"))
    values = [int(r["key"], 16) for r in keys.collect()]
    rng = random.Random(1)
    probes = sorted(rng.getrandbits(128) for _ in range(9))
    assert sharding.histogram(keys, probes) == [(3 * n, n) for n in (sum(v < p for v in values) for p in probes)]


def test_shards_of_messy_rows(messy, nothing):
    out = sharding.shard(messy, shards=4)
    assert out.count() == messy.count() and set(messy.columns) <= set(out.columns)
    assert {r["bucket"] for r in out.collect()} == {"clash"}
    assert sharding.shard(nothing).collect() == []


def test_crc_is_unsigned():
    assert zlib.crc32(b"abc") == 891568578


def test_many_rows_without_id_cost_what_rows_with_ids_cost(spark, vocabulary):
    """Rows are known by id and text: no row of a null or repeated id meets the others of it."""
    import time
    rng = random.Random(31)
    base = [rng.choice(vocabulary) for _ in range(70)]
    texts = []
    for _ in range(500):
        w = list(base)
        w[rng.randrange(70)] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    took = {}
    for name, ids in (("own", range(500)), ("null", [None] * 500), ("same", [4] * 500)):
        rows = list(zip(ids, texts))
        start = time.perf_counter()
        got = Counter(map(tuple, jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()))
        took[name] = time.perf_counter() - start
        assert got == brute(rows, 3, 80)
    assert max(took.values()) < 3 * took["own"] + 20


def test_bitmaps_lose_no_link():
    rng = random.Random(8)
    import numpy as np
    for n in (5, 60, 900, 5000):
        for _ in range(30):
            h = np.array([rng.getrandbits(64) for _ in range(n + n // 4)], np.uint64)
            drop = rng.randint(0, n // 8)
            a, b = np.unique(h[:n]), np.unique(np.append(h[drop:n], h[n:n + rng.randint(0, n // 8)]))
            common = len(np.intersect1d(a, b))
            least = -(-80 * (len(a) + len(b)) // 180)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = (np.frombuffer(jaccard.bitmap(s), np.uint64) for s in (a, b))
                assert int(np.bitwise_count(x ^ y).sum()) <= len(a) + len(b) - 2 * least
