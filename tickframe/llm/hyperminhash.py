"""Near-duplicates by HyperMinHash sketches, banded, estimated, then verified.

A document is the set of its word shingles; documents with equal sets are one
class.  A sketch deals the 64-bit hashes of a set over :data:`BUCKETS` buckets and
keeps of each bucket's least hash the count of leading zeros and the
:data:`MANTISSA` bits behind the leading one (a 16-bit register; 0: empty).

Bands: an empty bucket borrows the register of another one, in a fixed order of
its own, with that bucket's number, so that registers of two sets agree with
probability J at every size.  Classes that agree in one of :data:`BANDS` bands of
:data:`WIDTH` registers are candidates; a pair at 0.8 is missed by all bands with
probability 3e-6.

Estimate: the share of equal registers, corrected by the expected share of equal
registers of disjoint sets; candidates more than :data:`SIGMAS` standard
deviations below the limit are dropped.  The others are verified on the whole
sets, made anew from the texts.

Components need no list of all pairs.  First each class of a band's bucket is
compared with the bucket's least class (a star, as many rows as members), and only
its best estimate is verified.  In large buckets the classes outside the largest
component are then compared with a member of it drawn by each bucket, round after
round, as long as many of them are linked.  What is linked needs no further look:
of a bucket that still holds several components, the classes outside its largest
one are compared with all others of other components.  Few of them make pairs
directly; many are dealt into blocks, whose sketches a task compares as matrices.
So a group of near copies costs rows in proportion to its size, and no pair
between different components goes unseen.

Cases: documents without words have the empty set, link with nothing and are
components of their own; fewer words than the shingle are one shingle; rows with
null ids take part, a component's id is null only if all its ids are; a row is
``kept`` if its id is the component's (rows of that id that are repeated or all
without id alike); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.blocks import SPACE_WORDS, Words, batch_of, mix, pieces, runs_of, written
from tickframe.llm.jaccard import _common as common_sizes, components, row_hashes, sets_of, signature, whole_texts

BUCKET_BITS, MANTISSA = 8, 10
BUCKETS = 1 << BUCKET_BITS
BANDS, WIDTH = 32, 5
#: estimates below the limit by so many deviations and registers are dropped
SIGMAS, SLACK = 5.0, 2.0
#: classes outside a bucket's largest component that are paired directly; classes of a block beyond
DIRECT, BLOCK = 16, 512
#: buckets of more classes draw members of their largest component for the others, as long as that links a quarter of these
LARGE, GAIN = 64, 0.25
#: pairs whose texts a task unpacks at once
SLICE = 256

_REST = 64 - BUCKET_BITS


def _orders() -> np.ndarray:
    """For each bucket the order in which it asks the others for a register."""
    with np.errstate(over="ignore"):
        keys = mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)).reshape(BUCKETS, BUCKETS)
    return np.argsort(keys, axis=1).T.copy()


_ASKS = _orders()


# ------------------------------------------------------------------ sketches
def shingles(off: np.ndarray, data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted by both."""
    w = Words(off, data, SPACE_WORDS)
    h, at = runs_of(w, k)
    row = w.row[at]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        one = n[short].astype(np.uint64)
        for j in range(k - 1):
            some = n[short] > j
            with np.errstate(over="ignore"):
                one[some] = mix(one[some] * np.uint64(0x9E6C63D0676A9A99) + w.hash[w.first[short[some]] + j])
        h, row = np.append(h, one), np.append(row, short)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def registers(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """(rows, BUCKETS) registers of sorted (row, hash): of each bucket's least hash, as the hashes are sorted."""
    bucket = (h >> np.uint64(_REST)).astype(np.int64)
    first = np.ones(len(h), bool)
    first[1:] = (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])
    rest = h[first] & np.uint64((1 << _REST) - 1)
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)          # bits up to the leading one
    down = bits - 1 - MANTISSA
    mantissa = np.where(down >= 0, rest >> np.maximum(down, 0).astype(np.uint64), rest << np.maximum(-down, 0).astype(np.uint64)).astype(np.int64) & ((1 << MANTISSA) - 1)
    out = np.zeros((rows, BUCKETS), np.uint16)
    out[row[first], bucket[first]] = 1 + (np.minimum(_REST - bits, 62) << MANTISSA) + mantissa
    return out


def signatures(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, list[bytes]]:
    """Size and 128-bit signature of each row's set (see ``jaccard.signature``)."""
    n = np.bincount(row, minlength=rows)
    out = np.zeros((rows, 2), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        first = np.cumsum(n)[some] - n[some]
        with np.errstate(over="ignore"):
            out[some, 0] = np.add.reduceat(mix(h), first)
            out[some, 1] = np.bitwise_xor.reduceat(mix(h + np.uint64(0x9E3779B97F4A7C15)), first)
    return n, [out[r].tobytes() if n[r] else b"" for r in range(rows)]


def sketched(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, rk, rk2, n, sig, regs) of each row (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("rk", pa.int64()), ("rk2", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("regs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, off, data in pieces(b.column(3)):
                row, h = shingles(off, data, k)
                n, sig = signatures(row, h, hi - lo)
                regs = [r.tobytes() for r in registers(row, h, hi - lo)]
                yield batch_of(schema, [*(b.column(j).slice(lo, hi - lo) for j in range(3)), n, sig, regs])

    return texts.select("doc_id", *row_hashes(), "text").mapInArrow(run, "doc_id long, rk long, rk2 long, n long, sig binary, regs binary")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers with their bucket's number; an empty bucket has the first one that it asks and that isn't empty."""
    own = np.where(regs > 0, regs.astype(np.int64) << BUCKET_BITS | np.arange(BUCKETS), 0)
    out = own.copy()
    rows = np.flatnonzero((regs > 0).any(axis=1) & (regs == 0).any(axis=1))
    for asked in _ASKS:
        if not len(rows):
            break
        got = out[rows]
        got = np.where(got == 0, own[rows][:, asked], got)
        out[rows] = got
        rows = rows[(got == 0).any(axis=1)]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(rows, BANDS) hashes of WIDTH registers each."""
    use = filled(regs)[:, :BANDS * WIDTH].astype(np.uint64).reshape(len(regs), BANDS, WIDTH)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), use.shape[:2]).copy()
        for j in range(WIDTH):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + use[:, :, j])
    return key


@lru_cache(maxsize=1)
def collision_table() -> np.ndarray:
    """For set sizes 2^(j/2): the probability that the registers of one bucket are equal though the sets are disjoint."""
    zeros = np.arange(_REST)[:, None]
    low = 2.0 ** -(zeros + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
    high = low + 2.0 ** -(zeros + 1 + MANTISSA)
    out = []
    for j in range(2 * 40):
        rate = 2.0 ** (j / 2) / BUCKETS                   # hashes of a bucket, Poisson; the least one is exponential
        cell = np.exp(-rate * low) * -np.expm1(-rate * (high - low)) / -np.expm1(-rate)
        out.append(float((cell ** 2).sum()))
    return np.array(out)


def estimate(equal: np.ndarray, used: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Jaccard estimate of ``equal`` among ``used`` registers of sets of about ``n`` elements, without chance collisions."""
    chance = collision_table()[np.minimum(np.rint(2 * np.log2(np.maximum(n, 1))).astype(np.int64), 79)]
    return (equal / np.maximum(used, 1) - chance) / (1 - chance)


def likely(equal: np.ndarray, used: np.ndarray, n1: np.ndarray, n2: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The estimate, and whether sets of these sizes may well be linked.

    The least hashes of the used buckets are drawn from the union without replacement, so the
    deviation at the limit is hypergeometric: small sets are known almost whole.
    """
    j, limit = estimate(equal, used, np.sqrt(n1 * 1.0 * n2)), percent / 100
    union = np.maximum((n1 + n2) / (1 + limit), used + 1)
    spread = np.sqrt(limit * (1 - limit) / np.maximum(used, 1) * (union - used) / (union - 1))
    near = j >= limit - SIGMAS * spread - SLACK / np.maximum(used, 1)
    return j, near & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))


# ------------------------------------------------------------------ candidates
def banded(classes: DataFrame) -> DataFrame:
    """(key, cid): the bands of each class."""
    schema = pa.schema([("key", pa.int64()), ("cid", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                b = whole.slice(lo, 2048)
                keys = band_keys(matrix(b.column(1)))
                yield batch_of(schema, [keys.view(np.int64).ravel(), np.repeat(np.asarray(b.column(0)), BANDS)])

    return classes.select("cid", "regs").mapInArrow(run, "key long, cid long")


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, j) of the pairs (a, b) whose estimate allows a link."""
    def side(x: str) -> DataFrame:
        return classes.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("j", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                t = whole.slice(lo, 2048)
                x, y = matrix(t.column(4)), matrix(t.column(5))
                j, near = likely(((x == y) & (x > 0)).sum(axis=1), ((x > 0) | (y > 0)).sum(axis=1), np.asarray(t.column(2)), np.asarray(t.column(3)), percent)
                some = np.flatnonzero(near)
                if len(some):
                    yield batch_of(schema, [np.asarray(t.column(0))[some], np.asarray(t.column(1))[some], j[some]])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long, j double")


def best_pairs(pairs: DataFrame, classes: DataFrame, percent: int, best: int) -> DataFrame:
    """(a, b): of the pairs of each ``a`` the ``best`` likeliest."""
    top = F.slice(F.sort_array(F.collect_list(F.struct("j", "b")), asc=False), 1, best)     # a class has at most BANDS pairs
    return estimated(pairs, classes, percent).groupBy("a").agg(top.alias("top")).select("a", F.explode("top.b").alias("b"))


def star_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each class its likeliest one among the least classes of its buckets."""
    pairs = members.filter("cid <> lead").select(F.col("cid").alias("a"), F.col("lead").alias("b")).distinct()
    return best_pairs(pairs, classes, percent, 1)


def mixed_buckets(members: DataFrame, group: DataFrame) -> DataFrame:
    """(key, cid, root, top, p, others) of the buckets with several components (``group``: node, root): the component
    with most of the bucket's ``p`` classes, and how many are in others."""
    rooted = written(members.select("key", "cid").join(group.select(F.col("node").alias("cid"), "root"), "cid", "left")
                     .select("key", "cid", F.coalesce("root", "cid").alias("root")))
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = sizes.groupBy("key").agg(F.sum("c").alias("p"), F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("roots")) \
        .filter("roots > 1").select("key", "p", F.col("top.root").alias("top"), (F.col("p") - F.col("top.c")).alias("others"))
    return written(rooted.join(written(mixed), "key"))


def outside_pairs(mixed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each class outside the largest component of a large bucket a few members of that component,
    drawn by bucket, that are likeliest."""
    large = mixed.filter(F.col("p") > LARGE)
    drawn = large.filter("root = top").groupBy("key").agg(F.min_by("cid", F.xxhash64("cid", "key")).alias("b"))
    pairs = large.filter("root <> top").select("key", F.col("cid").alias("a")).join(drawn, "key").select("a", "b").distinct()
    return best_pairs(pairs, classes, percent, 3)


def remaining_pairs(mixed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): the likely pairs of different components in buckets with few classes outside the largest one."""
    few = mixed.filter(F.col("others") <= DIRECT).select("key", "cid", "root", "top")
    x, y = few.filter("root <> top").alias("x"), few.alias("y")
    direct = x.join(y, F.expr("x.key = y.key and x.root <> y.root and (y.root = y.top or x.cid < y.cid)")) \
        .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
    return estimated(direct, classes, percent).select("a", "b")


# ------------------------------------------------------------------ links
def verified(pairs: DataFrame, texts: DataFrame, names: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) of the pairs whose whole sets are linked; ``names``: cid, rk, rk2, sig."""
    pairs = written(pairs)
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    whole = written(whole_texts(texts, written(names.join(wanted, "cid").select("rk"))))

    def side(x: str) -> DataFrame:
        return names.join(whole, ["rk", "rk2"]).select(F.col("cid").alias(x), F.col("sig").alias(f"s{x}"), F.col("text").alias(f"t{x}"))

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in (b.slice(lo, SLICE) for b in batches for lo in range(0, b.num_rows, SLICE)):
            out = []
            for x, y, a, b, sa, sb in zip(sets_of(t.column(4), k), sets_of(t.column(5), k), *(t.column(j).to_pylist() for j in range(4))):
                if signature(x) != sa or signature(y) != sb:
                    raise ValueError("two rows share the hashes of id and text")
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    out.append((a, b))
            if out:
                yield batch_of(schema, list(zip(*out)))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb", "ta", "tb").mapInArrow(run, "a long, b long")


def block_links(mixed: DataFrame, texts: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): stars of the linked classes in buckets with many classes outside the largest component.

    These are dealt into blocks, and so are all the bucket's classes; a task takes one block of each, compares
    their sketches as matrices and verifies the likely pairs on the sets of the texts that came along.
    """
    def blocks(of: str):
        return F.ceil(F.col(of) / BLOCK).cast("int")

    many = mixed.filter(F.col("others") > DIRECT)
    wanted = written(classes.join(many.select("cid").distinct(), "cid", "left_semi"))
    whole = wanted.join(whole_texts(texts, wanted.select("rk")), ["rk", "rk2"]).select("cid", "n", "sig", "regs", "text")
    place = F.xxhash64("cid")
    left = many.filter("root <> top").withColumn("l", F.pmod(place, blocks("others")).cast("int")) \
        .withColumn("r", F.explode(F.sequence(F.lit(0), blocks("p") - 1))).withColumn("first", F.lit(True))
    right = many.withColumn("r", F.pmod(place, blocks("p")).cast("int")) \
        .withColumn("l", F.explode(F.sequence(F.lit(0), blocks("others") - 1))).withColumn("first", F.lit(False))
    cols = ["key", "l", "r", "first", "cid", "root"]
    dealt = left.select(*cols).union(right.select(*cols)).join(written(whole), "cid")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        first = np.asarray(t.column("first"))
        cid, root, n = (np.asarray(t.column(c)) for c in ("cid", "root", "n"))
        regs = matrix(t.column("regs"))
        x, y = np.flatnonzero(first), np.flatnonzero(~first)
        near = np.zeros((len(x), len(y)), bool)
        other, set_there = regs[y], regs[y] > 0
        for i, own in enumerate(x.tolist()):
            equal, used = ((other == regs[own]) & set_there).sum(axis=1), (set_there | (regs[own] > 0)).sum(axis=1)
            near[i] = likely(equal, used, n[y], n[own], percent)[1] & (root[y] != root[own])
        i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(i):
            return schema.empty_table()
        near, x, y = near[np.ix_(i, j)], x[i], y[j]
        sets = []
        for side in (x, y):
            some = t.take(pa.array(side))
            sets.append(sets_of(some.column("text"), k))
            if [signature(s) for s in sets[-1]] != some.column("sig").to_pylist():
                raise ValueError("two rows share the hashes of id and text")
        common = common_sizes(*sets)
        linked = near & (100 * common >= percent * (n[x][:, None] + n[y][None, :] - common))
        label = {c: c for c in cid[x].tolist() + cid[y].tolist()}
        a, b = (cid[side[at]].tolist() for side, at in zip((x, y), np.nonzero(linked)))
        for c, d in zip(a, b):                            # the least class of each linked group
            while label[c] != c:
                c = label[c]
            while label[d] != d:
                d = label[d]
            label[max(c, d)] = min(c, d)
        pairs = [(c, d) for c, d in label.items() if c != d]
        return pa.Table.from_batches([batch_of(schema, list(zip(*pairs)))]) if pairs else schema.empty_table()

    return dealt.groupBy("key", "l", "r").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable by links) and kept (it is the row's own id)."""
    texts = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    rows = written(sketched(texts, words))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rk", "rk2")).alias("least")
    # the number of a class is fixed by the table it is written to
    classes = written(rows.filter("n > 0").groupBy("sig").agg(least, F.first("n").alias("n"), F.first("regs").alias("regs"))
                      .select(F.monotonically_increasing_id().alias("cid"), "sig", F.col("least.doc_id").alias("rep"), "least.rk", "least.rk2", "n", "regs"))
    names = classes.select("cid", "rk", "rk2", "sig")
    # a smaller set has no partner but itself
    joined = classes.filter(100 * F.col("n") >= percent * (F.col("n") + 1))
    bands = written(banded(joined))
    lead = bands.groupBy("key").agg(F.min("cid").alias("lead"), F.count(F.lit(1)).alias("p")).filter("p > 1").select("key", "lead")
    members = written(bands.join(lead, "key"))
    links = written(verified(star_pairs(members, classes, percent), texts, names, words, percent))
    mixed = mixed_buckets(members, components(links))
    outside = F.count_distinct(F.when((F.col("p") > LARGE) & (F.col("root") != F.col("top")), F.col("cid")))
    left = mixed.agg(outside).first()[0]
    while left:
        links = written(links.union(verified(outside_pairs(mixed, classes, percent), texts, names, words, percent)))
        mixed = mixed_buckets(members, components(links))
        before, left = left, mixed.agg(outside).first()[0]
        if left > (1 - GAIN) * before:
            break
    more = verified(remaining_pairs(mixed, classes, percent), texts, names, words, percent)
    group = components(links.union(more).union(block_links(mixed, texts, classes, words, percent)))
    named = classes.select("cid", "sig", "rep").join(group, F.col("cid") == F.col("node"), "left").select("sig", "rep", F.coalesce("root", "cid").alias("root"))
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    final = named.join(ids, "root").select("sig", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return rows.select("doc_id", "n", "sig").join(final, "sig", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
