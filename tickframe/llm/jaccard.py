"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles.  Documents with equal sets form a
class, and only classes are joined.  All sets are ordered alike, rare shingles
first (by exact counts of hash buckets over the whole corpus).  If two sets of
at least ``o`` common elements are cut to their first ``size - o + l`` elements,
the cuts share at least ``l``.  Each document picks its own ``l``: a longer
prefix costs rows and postings, but fewer pairs share so many elements of it;
the estimated cost of both decides.  A pair must share ``min(l, l')`` elements
of its prefixes, and is then verified with the whole sets.

Documents that share a shingle of few documents are joined directly and their
common shingles counted.  The pairs that share frequent shingles alone are
compared under the rarest of these: it deals its documents into blocks, a
document goes once to each such shingle that can be the first of enough common
ones, and a task compares a block with itself as matrices.  Where there are
several blocks, each is packed into one compressed row, and a task streams the
other blocks past its own.  No pairs are returned: only each document's number
of links and what joins linked groups, which is all that degrees and components
need.  So no document's rows and no task's memory grow with a group.  The
comparisons do, as links are counted exactly, and with them the packed blocks
that are sent, the square of their number.  Nothing is capped.

Cases: documents without words have the empty set, link with nothing and are a
component of their own; fewer words than the shingle are one shingle; rows with
null ids take part, and a component's id is null only if all its ids are;
repeated rows are copies; an empty table gives no rows; further columns are
ignored by ``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.llm.blocks import SPACE_WORDS, Words, batch_of, boxed, mix, partitions, pieces, runs_of, unboxed, written

BUCKET_BITS = 20
#: shingles whose bucket holds more occurrences may be frequent: their rows are counted and joined by Spark alone
BOUNDED = 1 << 16
#: prefix rows that a task packs at once
PACKED_ROWS = 1 << 20
#: pairs whose texts a task unpacks at once
SLICE = 256
#: bits of a set's bitmap
BITMAP = 2048
#: classes of one block, and the most under which a shingle's classes are joined directly
BLOCK, DIRECT = 256, 48
#: longest extra prefix, and costs of a prefix row, of reading a posting, of verifying a candidate
MOST_MATCHES, ROW_COST, POSTING_COST, VERIFY_COST = 6, 1.0, 0.2, 4.0


def shingle_sets(off: np.ndarray, data: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted set of each text's shingle hashes."""
    w = Words(off, data, SPACE_WORDS)
    h, at = runs_of(w, k)
    rows = w.row[at]
    first = np.searchsorted(rows, np.arange(len(off)))
    for r in range(len(off) - 1):
        n = w.first[r + 1] - w.first[r]
        if n >= k:
            yield np.unique(h[first[r]:first[r + 1]])
        elif n:
            x = np.array([n], np.uint64)
            for word in w.hash[w.first[r]:w.first[r + 1]]:
                with np.errstate(over="ignore"):
                    x = mix(x * np.uint64(0x9E6C63D0676A9A99) + word)
            yield x
        else:
            yield np.zeros(0, np.uint64)


def signature(s: np.ndarray) -> bytes:
    """128 bits that depend on the set alone."""
    if not len(s):
        return b""
    with np.errstate(over="ignore"):
        return np.array([mix(s).sum(), np.bitwise_xor.reduce(mix(s + np.uint64(0x9E3779B97F4A7C15)))], np.uint64).tobytes()


def bitmap(s: np.ndarray) -> bytes:
    """Which of BITMAP places the set's elements fall on."""
    there = np.zeros(BITMAP, bool)
    there[(s & np.uint64(BITMAP - 1)).astype(np.int64)] = True
    return np.packbits(there).tobytes()


def row_hashes() -> list:
    """128 bits by which a row is known: of its id and text."""
    return [F.xxhash64("doc_id", "text").alias("rk"), F.xxhash64("text", "doc_id").alias("rk2")]


def bucket_counts(texts: DataFrame, k: int) -> np.ndarray:
    """Occurrences of the shingles of each hash bucket in the whole corpus (2**BUCKET_BITS numbers)."""
    segments = 16
    size = (1 << BUCKET_BITS) // segments

    def count(batches):
        n = np.zeros(1 << BUCKET_BITS, np.int64)
        for b in batches:
            for _, _, off, data in pieces(b.column(0)):
                h, _ = runs_of(Words(off, data, SPACE_WORDS), k)
                n += np.bincount((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(n))
        small = n.astype(np.min_scalar_type(int(n.max())))
        for s in range(segments):
            x = small[s * size:(s + 1) * size]
            yield batch_of(schema, [[s], [x.dtype.char.encode() + x.tobytes()]])

    def add(batches):
        n, s = np.zeros(size, np.int64), -1
        for b in batches:
            for r in range(b.num_rows):
                s, raw = b.column(0)[r].as_py(), b.column(1)[r].as_py()
                n += np.frombuffer(raw, np.dtype(raw[:1].decode()), offset=1)
        if s >= 0:
            yield batch_of(schema, [[s], [n.tobytes()]])

    schema = pa.schema([("segment", pa.int32()), ("counts", pa.binary())])
    sql = "segment int, counts binary"
    got = texts.select("text").mapInArrow(count, sql).repartitionById(segments, F.col("segment")).mapInArrow(add, sql).collect()
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in got:                                         # 16 rows of fixed size
        out[r["segment"] * size:(r["segment"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return out


def prefix_of(s: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple[int, np.ndarray]:
    """How many matches a document asks for, and the prefix that needs."""
    n = len(s)
    often = counts[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    spare = n - (percent * n + 99) // 100                 # n - o
    most = min(spare + MOST_MATCHES, n)
    order = np.argsort(often, kind="stable")[:most]       # s is sorted, so ties go by hash
    postings = np.cumsum(np.maximum(often[order] - usual, 0))[spare:]
    matches = np.arange(1, len(postings) + 1)
    cost = ROW_COST * matches + POSTING_COST * postings + VERIFY_COST * postings / matches
    pick = int(np.argmin(cost)) + 1
    return pick, s[order[:spare + pick]]


def sets_with_signature(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, sig) of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("sig", pa.binary())])

    def run(batches):
        for b in batches:
            for lo, hi, off, data in pieces(b.column(1)):
                rows = [(len(s), signature(s)) for s in shingle_sets(off, data, k)]
                yield batch_of(schema, [b.column(0).slice(lo, hi - lo), *zip(*rows)])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, n int, sig binary")


def prefixes(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, rk, rk2, n, sig, bits, matches, prefix, often) of each row with words: hashes of id and text, the bitmap of
    its set, its prefix, and the part of that in full buckets."""
    counts = bucket_counts(texts, k)
    usual = float(counts.mean() + 3 * np.sqrt(counts.mean()) + 1)
    sent = texts.sparkSession.sparkContext.broadcast(counts)
    schema = pa.schema([("doc_id", pa.int64()), ("rk", pa.int64()), ("rk2", pa.int64()), ("n", pa.int32()), ("sig", pa.binary()), ("bits", pa.binary()),
                        ("matches", pa.int32()), ("prefix", pa.list_(pa.int64())), ("often", pa.list_(pa.int64()))])

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate(arrays).view(np.int64)))

    def run(batches):
        counts = sent.value
        for b in batches:
            for lo, _, off, data in pieces(b.column(3)):
                rows = []
                for r, s in enumerate(shingle_sets(off, data, k)):
                    if len(s):
                        pick, prefix = prefix_of(s, counts, usual, percent)
                        full = counts[(prefix >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] > BOUNDED
                        rows.append((lo + r, len(s), signature(s), bitmap(s), pick, prefix[~full], prefix[full]))
                if rows:
                    at, n, sig, bits, pick, prefix, often = zip(*rows)
                    yield batch_of(schema, [*(b.column(j).take(pa.array(at)) for j in range(3)), n, sig, bits, pick, lists(prefix), lists(often)])

    return texts.select("doc_id", *row_hashes(), "text").mapInArrow(
        run, "doc_id long, rk long, rk2 long, n int, sig binary, bits binary, matches int, prefix array<long>, often array<long>")


def shared_tokens(cls: DataFrame) -> DataFrame:
    """(cid, token, p): prefix shingles that ``p`` classes have, p at least 2.

    Shingles of bounded buckets travel packed by hash range, and a task keeps
    those it sees twice.  The others are counted by a partial aggregation.
    """
    n = partitions(cls.sparkSession)
    packed = pa.schema([("part", pa.int32()), ("tokens", pa.binary()), ("cids", pa.binary())])
    found = pa.schema([("cid", pa.int64()), ("token", pa.int64()), ("p", pa.int64())])

    def send(tokens, cids):
        t, c = np.concatenate(tokens), np.concatenate(cids)
        order = np.argsort(t)
        t, c = t[order], c[order]
        part = ((t >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(n + 1))
        for k in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            yield batch_of(packed, [[k], [t[edges[k]:edges[k + 1]].tobytes()], [c[edges[k]:edges[k + 1]].tobytes()]])

    def pack(batches):
        tokens, cids, held = [], [], 0
        for b in batches:
            lists = b.column(1)
            flat = np.asarray(lists.flatten()).view(np.uint64)
            tokens.append(flat)
            cids.append(np.repeat(np.asarray(b.column(0)), np.asarray(lists.value_lengths())))
            held += len(flat)
            if held > PACKED_ROWS:
                yield from send(tokens, cids)
                tokens, cids, held = [], [], 0
        if held:
            yield from send(tokens, cids)

    def keep(batches):
        rows = [(b.column(1)[r].as_py(), b.column(2)[r].as_py()) for b in batches for r in range(b.num_rows)]
        if not rows:
            return
        t, c = (np.concatenate([np.frombuffer(r[j], np.int64) for r in rows]) for j in (0, 1))
        order = np.argsort(t, kind="stable")
        t, c = t[order], c[order]
        first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        p = np.diff(np.append(first, len(t)))
        p = np.repeat(p, p)
        some = np.flatnonzero(p > 1)
        for lo in range(0, len(some), 1 << 16):
            at = some[lo:lo + (1 << 16)]
            yield batch_of(found, [c[at], t[at], p[at]])

    seldom = cls.select("cid", "prefix").mapInArrow(pack, "part int, tokens binary, cids binary") \
        .repartitionById(n, F.col("part")).mapInArrow(keep, "cid long, token long, p long")
    rows = cls.select("cid", F.explode("often").alias("token"))
    many = rows.groupBy("token").agg(F.count(F.lit(1)).alias("p")).filter("p > 1")
    return seldom.unionByName(rows.join(many, "token").select("cid", "token", "p"))


def id_bits(ids: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """A bit table of hashed ids, built by Spark: its size (a power of two) and its bytes.

    Sixteen bits for each id, 64 MB at most; a fuller table lets more rows through,
    which a later join drops.
    """
    n = ids.count()
    size = 1 << min(29, max(16, (16 * n - 1).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(size)) + 1
    got = ids.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    table = np.zeros(size // 8, np.uint8)
    for r in got:                                         # at most size / 32768 rows of 4 KB
        part = np.frombuffer(r["bits"], np.uint8)
        table[4096 * (r["b"] - 1):4096 * r["b"]] = part[:len(table) - 4096 * (r["b"] - 1)]
    return size, table


def whole_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rk, rk2, text) of the rows whose hash ``rk`` is (by a bit table) among ``wanted`` (rk): no other text moves later.

    Equal rows come once; a text is compressed for the way.
    """
    size, table = id_bits(wanted, "rk")
    sent = texts.sparkSession.sparkContext.broadcast(table)          # 64 MB at most
    schema = pa.schema([("rk", pa.int64()), ("rk2", pa.int64()), ("text", pa.binary())])

    def run(batches):
        table, pack = sent.value, zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            place = np.asarray(b.column(3))
            some = b.filter(pa.array((table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))
            yield batch_of(schema, [some.column(0), some.column(1), [pack((t or "").encode()) for t in some.column(2).to_pylist()]])

    rows = texts.select(*row_hashes(), "text").withColumn("place", F.pmod(F.xxhash64("rk"), F.lit(size)))
    rows = rows.select("rk", "rk2", "text", "place").mapInArrow(run, "rk long, rk2 long, text binary")
    return rows.groupBy("rk", "rk2").agg(F.first("text").alias("text"))


def sets_of(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sets of compressed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    texts = pa.array([unpack(t).decode() for t in column.to_pylist()], pa.string())
    return [s for _, _, off, data in pieces(texts) for s in shingle_sets(off, data, k)]


# ------------------------------------------------------------------ candidate pairs and links
def _linked(common: np.ndarray, n1: np.ndarray, n2: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n1 + n2 - common)


def direct_pairs(found: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes that share shingles of few classes, and enough of them.

    What both may share of frequent shingles counts in full, so no pair is lost.
    """
    few = found.select("cid", "n", "matches", F.size(F.filter("found", lambda f: f["p"] > DIRECT)).alias("more"), F.explode("found").alias("f")) \
        .filter(F.col("f.p") <= DIRECT).select("cid", "n", "matches", "more", "f.token")
    a, b = few.alias("a"), few.alias("b")
    together = a.join(b, F.expr(f"""a.token = b.token and a.cid < b.cid
            and 100L * least(a.n, b.n) >= {percent}L * greatest(a.n, b.n)"""))
    return together.groupBy(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).agg(
        F.count(F.lit(1)).alias("c"), F.max(F.expr("least(a.matches, b.matches) - least(a.more, b.more)")).alias("need")) \
        .filter("c >= need").select("a", "b")


def possible(pairs: DataFrame, cls: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs whose bitmaps don't rule out a link.

    A place that is set in one bitmap alone has an element that the other set lacks, and linked sets
    differ in a bounded number of elements, so no link is lost.
    """
    def side(x: str) -> DataFrame:
        return cls.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"m{x}"))

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for whole in batches:
            for t in (whole.slice(lo, 4096) for lo in range(0, whole.num_rows, 4096)):
                x, y = (np.frombuffer(b"".join(t.column(j).to_pylist()), np.uint64).reshape(t.num_rows, -1) for j in (4, 5))
                both = np.asarray(t.column(2)).astype(np.int64) + np.asarray(t.column(3))
                least = -(-percent * both // (100 + percent))         # common elements of a link
                some = np.flatnonzero(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= both - 2 * least)
                if len(some):
                    yield batch_of(schema, [np.asarray(t.column(0))[some], np.asarray(t.column(1))[some]])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ma", "mb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, whole: DataFrame, names: DataFrame, k: int, percent: int) -> DataFrame:
    """(cid, root, weight): both directions of each linked pair; the weight is the other side's copies.

    The texts of both sides meet, as they are smaller than their sets.
    """
    def side(x: str) -> DataFrame:
        return names.join(whole, ["rk", "rk2"]).select(
            F.col("cid").alias(x), F.col("sig").alias(f"g{x}"), F.col("copies").alias(f"c{x}"), F.col("text").alias(f"t{x}"))

    schema = pa.schema([("cid", pa.int64()), ("root", pa.int64()), ("weight", pa.int64())])

    def run(batches):
        for t in (b.slice(lo, SLICE) for b in batches for lo in range(0, b.num_rows, SLICE)):
            out = []
            a, b, ga, gb, ca, cb = (t.column(j).to_pylist() for j in range(6))
            for x, y, *row in zip(sets_of(t.column(6), k), sets_of(t.column(7), k), a, b, ga, gb, ca, cb):
                one, other, sig, sig2, copies, copies2 = row
                if signature(x) != sig or signature(y) != sig2:
                    raise ValueError("two rows share the hashes of id and text")
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                if _linked(int((both[1:] == both[:-1]).sum()), len(x), len(y), percent):
                    out += [(one, other, copies2), (other, one, copies)]
            if out:
                yield batch_of(schema, list(zip(*out)))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ga", "gb", "ca", "cb", "ta", "tb") \
        .mapInArrow(run, "cid long, root long, weight long")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, by products of incidence matrices."""
    out = np.zeros((len(left), len(right)), np.float32)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    flat = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    for lo in range(0, len(shared), 4096):
        keys = shared[lo:lo + 4096]
        m = []
        for f, r, x in zip(flat, rows, (left, right)):
            at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
            hit = keys[at] == f
            one = np.zeros((len(x), len(keys)), np.float32)
            one[r[hit], at[hit]] = 1
            m.append(one)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def often_of() -> Column:
    """The frequent shingles of ``found``, rarest first."""
    many = F.filter("found", lambda f: f["p"] > DIRECT)
    return F.transform(F.array_sort(F.transform(many, lambda f: F.struct(f["p"], f["token"]))), lambda f: f["token"])


def compared_under(found: DataFrame) -> DataFrame:
    """(cid, token, place, p): frequent shingles under which ``p`` classes are compared, and their place among a class's own.

    Pairs that share no seldom shingle must share as many frequent ones as the one that asks for fewer does.  So their
    first common one has that many at or after it in both lists, and a class is left out where it has too few.
    """
    rows = found.filter(F.exists("found", lambda f: f["p"] > DIRECT)).select("cid", "matches", often_of().alias("often")) \
        .select("cid", "matches", F.size("often").alias("size"), F.posexplode("often").alias("place", "token"))
    least = rows.groupBy("token").agg(F.min("matches").alias("least"))
    some = written(rows.join(least, "token").filter("size - place >= least").select("cid", "token", "place"))
    return written(some.join(some.groupBy("token").agg(F.count(F.lit(1)).alias("p")).filter("p > 1"), "token"))


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column."""
    lists = column.combine_chunks()
    return np.split(np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths()))[:-1])


def _block(table: pa.Table) -> dict:
    """The columns of a block of classes, as arrays and lists of arrays."""
    block = {c: np.asarray(table.column(c)) for c in ("cid", "n", "matches", "copies", "place", "root")}
    block |= {c: _arrays(table.column(c)) for c in ("often", "seldom", "whole")}
    block["before"] = [s[:at] for s, at in zip(block["often"], block["place"].tolist())]
    return block


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _unpacked(packed: bytes) -> dict:
    return _block(pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all())


def _links(x: dict, y: dict, percent: int) -> np.ndarray:
    """Which classes of two blocks of a shingle are linked and have it as their first common one, and no seldom one."""
    n1, n2 = x["n"][:, None].astype(np.int64), y["n"][None, :].astype(np.int64)
    ok = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    ok &= _common(x["often"], y["often"]) >= np.minimum(x["matches"][:, None], y["matches"][None, :])
    # pairs that share a seldom shingle were joined directly; the others are looked at under their first one
    for c in ("seldom", "before"):
        if ok.any():
            ok &= _common(x[c], y[c]) == 0
    i, j = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
    if len(i):
        common = _common([x["whole"][r] for r in i], [y["whole"][r] for r in j])
        ok[np.ix_(i, j)] &= _linked(common, n1[i], n2[:, j], percent)
    return ok


def _least_linked(ok: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least one of its linked group."""
    root = np.arange(len(ok))
    i, j = np.nonzero(ok)
    while True:
        old = root.copy()
        np.minimum.at(root, i, root[j])
        root = root[root]
        if (old == root).all():
            return root


def block_links(found: DataFrame, under: DataFrame, whole: DataFrame, names: DataFrame, k: int, percent: int) -> DataFrame:
    """(cid, root, weight) of the links of pairs that share frequent shingles alone (``under``: see ``compared_under``)."""
    lists = found.select("cid", "n", "matches", often_of().alias("often"),
                         F.transform(F.filter("found", lambda f: f["p"] <= DIRECT), lambda f: f["token"]).alias("seldom"))
    dealt = under.withColumn("blocks", F.ceil(F.col("p") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")) \
        .join(lists, "cid").join(names.join(whole, ["rk", "rk2"]), "cid")
    fields = [("cid", pa.int64()), ("root", pa.int64()), ("weight", pa.int64())]
    links, sql = pa.schema(fields), "cid long, root long, weight long"
    schema = pa.schema([*fields, ("token", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("packed", pa.binary())])

    def within(table: pa.Table) -> pa.Table:
        sets = sets_of(table.column("text"), k)
        if [signature(s) for s in sets] != table.column("sig").to_pylist():
            raise ValueError("two rows share the hashes of id and text")
        table = table.append_column("whole", pa.array(sets, pa.list_(pa.uint64()))).append_column("root", table.column("cid"))
        block = _block(table)
        cid = block["cid"]
        ok = _links(block, block, percent) & ~np.eye(len(cid), dtype=bool)            # both directions of each pair stay
        weight, root = ok @ block["copies"], cid[_least_linked(ok)]
        some = np.flatnonzero(weight > 0)
        out = [batch_of(schema, [cid[some], root[some], weight[some], *[[None] * len(some)] * 4])]
        token, number, blocks = (table.column(c)[0].as_py() for c in ("token", "block", "blocks"))
        if blocks > 1:
            table = table.set_column(table.schema.get_field_index("root"), "root", pa.array(root)) \
                .select(["cid", "n", "matches", "copies", "place", "root", "often", "seldom", "whole"])
            out.append(batch_of(schema, [[None], [None], [None], [token], [number], [blocks], [_packed(table)]]))
        return pa.Table.from_batches(out)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine, weight, edges, label = None, None, None, [], {}

        def first(c: int) -> int:
            while label.setdefault(c, c) != c:
                c = label[c]
            return c

        def ended() -> Iterator[pa.RecordBatch]:
            if mine is not None:
                some = np.flatnonzero(weight > 0)
                rows = [(c, c, w) for c, w in zip(mine["cid"][some].tolist(), weight[some].tolist())] + edges
                if rows:
                    yield batch_of(links, list(zip(*rows)))

        for b in batches:
            for r in range(b.num_rows):                  # a block comes first among those that it is compared with
                token, own, number = (b.column(j)[r].as_py() for j in range(3))
                if (token, own) != key:
                    yield from ended()
                    key, mine, edges, label = (token, own), None, [], {}
                if number == own:
                    mine = _unpacked(b.column(3)[r].as_py())
                    weight = np.zeros(len(mine["cid"]), np.int64)
                elif mine is not None:
                    other = _unpacked(b.column(3)[r].as_py())
                    ok = _links(mine, other, percent)
                    weight += ok @ other["copies"]
                    if number > own and ok.any():        # what joins the groups that each block has linked
                        i, j = np.nonzero(ok)
                        for c, d in np.unique(np.stack([mine["root"][i], other["root"][j]], axis=1), axis=0).tolist():
                            e, f = first(c), first(d)
                            if e != f:
                                label[max(e, f)] = min(e, f)
                                edges.append((c, d, 0))
        yield from ended()

    cols = ["token", "block", "blocks", "cid", "n", "matches", "place", "often", "seldom", "sig", "text", "copies"]
    made = written(dealt.select(*cols).groupBy("token", "block").applyInArrow(within, f"{sql}, token long, block int, blocks int, packed binary"))
    sent = made.filter("packed is not null").select("token", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), "block", "packed")
    between = sent.repartition(partitions(found.sparkSession), "token", "own") \
        .sortWithinPartitions("token", "own", F.col("block") != F.col("own"), "block").mapInArrow(across, sql)
    return made.filter("packed is null").select("cid", "root", "weight").union(between)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b): alternating large and small stars until nothing changes."""
    e = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low).distinct()
        e = written(small)


def _grouped(texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sig) of each row, and (sig, component_id, n_links, first) of each class with words:
    ``first`` is true for one class of each component, one of the least id."""
    sets = written(sets_with_signature(texts, words))
    # classes go by their least id, or by a hash of the set where that is null or names two classes
    double = written(sets.filter("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi"))
                     .filter("lo <> hi").select(F.col("doc_id").alias("rep"), F.lit(True).alias("double")))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rk", "rk2")).alias("least")
    cls = written(prefixes(texts, words, percent).groupBy("sig").agg(
        least, F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", "bits", "matches", "prefix", "often")])
        .select("*", F.col("least.doc_id").alias("rep"), "least.rk", "least.rk2").drop("least")
        .join(double, "rep", "left")
        .withColumn("cid", F.when(F.col("rep").isNotNull() & F.col("double").isNull(), F.col("rep")).otherwise(F.xxhash64("sig"))).drop("double"))
    names = cls.select("cid", "sig", "rep", "rk", "rk2", "copies")
    found = written(shared_tokens(cls).groupBy("cid").agg(F.collect_list(F.struct("token", "p")).alias("found"))
                    .join(cls.select("cid", "n", "matches"), "cid"))
    pairs = written(possible(direct_pairs(found, percent), cls, percent))
    under = compared_under(found)
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).union(under.select("cid")).distinct()
    whole = written(whole_texts(texts, written(names.join(wanted, "cid").select("rk"))))
    links = written(verified(pairs, whole, names, words, percent).union(block_links(found, under, whole, names, words, percent)))
    group = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("cid").agg(F.sum("weight").alias("links"))
    named = names.join(group, F.col("cid") == F.col("node"), "left").join(degree, "cid", "left") \
        .select("sig", "rep", "copies", F.coalesce("root", "cid").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    least = named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("late"), "rep", F.col("sig").alias("head"))).alias("least"))
    return sets, named.join(least, "root").select(
        "sig", F.col("least.rep").alias("component_id"), (F.col("links") + F.col("copies") - 1).alias("n_links"),
        (F.col("sig") == F.col("least.head")).alias("first"))


def classes(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_shingles, component_id (least id reachable by links) and n_links (other documents it links with)."""
    texts = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    sets, final = _grouped(texts, words, percent)
    return sets.select("doc_id", "n", "sig").join(final.drop("first"), "sig", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def with_signature(docs: DataFrame, text_col: str, k: int, name: str) -> DataFrame:
    """``docs`` and the signature of each row's set."""
    place, out = docs.columns.index(text_col), docs.withColumn(name, F.lit(None).cast("binary")).schema

    def run(batches):
        for b in batches:
            sigs = [signature(s) for _, _, off, data in pieces(b.column(place)) for s in shingle_sets(off, data, k)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sigs, pa.binary())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, out)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with its least id.

    Rows are decided by class, not by id: rows that share an id, or have none, are told
    apart by the signatures of their sets (taken for those rows alone).  Rows without
    words are components of their own, so all of them stay.
    """
    texts = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    sets, final = _grouped(texts, words, percent)
    least = F.col("first") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    cl = written(sets.join(final, "sig", "left").select("doc_id", "n", "sig", F.when(F.col("n") > 0, least).otherwise(True).alias("stays")))
    ids = cl.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_and("stays").alias("stay"))
    decided = written(ids.filter("rows > 1 or not stay").select(F.col("doc_id").alias("id"), "rows"))
    again = decided.filter("rows > 1").select("id")
    rows = boxed(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    single = rows.filter("id is not null").join(decided.select("id"), "id", "left_anti")
    several = rows.filter("id is null").unionByName(rows.join(again, "id", "left_semi"))
    several = with_signature(several, "text", words, "sig")
    first = cl.filter("stays and n > 0").select(F.col("doc_id").alias("i"), F.col("sig").alias("s"))
    first = written(first.filter("i is null").unionAll(first.join(again, F.col("i") == F.col("id"), "left_semi")).distinct())
    copy = F.row_number().over(Window.partitionBy("id", "sig").orderBy("id"))
    full = several.filter("length(sig) > 0").withColumn("copy", copy).filter("copy = 1") \
        .join(first, (F.col("sig") == F.col("s")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    kept = single.select("row").unionAll(full.select("row")).unionAll(several.filter("length(sig) = 0").select("row"))
    return unboxed(kept, docs.columns)
