"""Document fingerprints from prefix polynomial hashes.

A text's fingerprint is its modular prefix array: entry ``i`` is the polynomial
hash of the first ``i`` code points.  Two entries answer the equality of any two
spans in constant time, so the longest common extension of two positions is a
binary search.  ``digest`` writes the last entry (in four lanes) and the length
as a string; ``likeness`` compares two prefix arrays.

Cases: a null text is the empty text; two empty texts have likeness 1, an empty
and another one 0.  Rows are ordered by descending id, null ids last, and rows
of one id by descending hash of the text and then the text, so ties and repeated
rows have one defined order, and many rows of one id (or none) are several ranges.
Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.blocks import batch_of, partitions

#: Mersenne prime 2**31 - 1 and the bases of the lanes; the first two lanes keep prefix arrays.
PRIME = np.uint64((1 << 31) - 1)
BASES = (1_000_003_579, 1_597_334_677, 2_003_663_613, 1_220_703_125)
WINDOW = 32
_S31 = np.uint64(31)
_POWERS: dict[int, np.ndarray] = {}


def _reduce(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME for x below 2**63."""
    x = (x & PRIME) + (x >> _S31)
    x = (x & PRIME) + (x >> _S31)
    return np.where(x >= PRIME, x - PRIME, x)


def _powers(lane: int, n: int) -> np.ndarray:
    have = _POWERS.get(lane)
    if have is None or len(have) < n:
        size = max(n, 4096, 0 if have is None else 2 * len(have))
        out = np.ones(size, np.uint64)
        done, base = 1, BASES[lane] % int(PRIME)
        while done < size:                      # doubling: powers k..2k-1 = base**k * powers 0..k-1
            more = min(done, size - done)
            out[done:done + more] = _reduce(out[:more] * np.uint64(pow(base, done, int(PRIME))))
            done += more
        _POWERS[lane] = have = out
    return have


class PrefixHash:
    """Prefix arrays of one text: span equality, longest common extensions, digest."""

    def __init__(self, text: str):
        self.points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(self.points)
        self.lanes = []
        for lane in (0, 1):
            p = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_reduce(self.points * _powers(lane, self.n)[:self.n]), out=p[1:])
            self.lanes.append(_reduce(p))

    def digest(self) -> str:
        last = [int(p[-1]) for p in self.lanes]
        for lane in (2, 3):
            last.append(int(_reduce(self.points * _powers(lane, self.n)[:self.n]).sum() % PRIME))
        return f"{self.n:x}-" + "".join(f"{x:08x}" for x in last)

    def span(self, lane: int, at: int, size: int) -> int:
        p = self.lanes[lane]
        return (int(p[at + size]) - int(p[at])) % int(PRIME)

    def same(self, at: int, other: "PrefixHash", at2: int, size: int) -> bool:
        """Whether two spans of ``size`` code points are equal."""
        return all(self.span(k, at, size) * int(_powers(k, at2 + 1)[at2]) % int(PRIME)
                   == other.span(k, at2, size) * int(_powers(k, at + 1)[at]) % int(PRIME) for k in (0, 1))

    def common_extension(self, at: int, other: "PrefixHash", at2: int, most: int, back: bool = False) -> int:
        """Longest common extension from two positions (backwards: of the spans that end there)."""
        lo, hi = 0, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.same(at - mid * back, other, at2 - mid * back, mid):
                lo = mid
            else:
                hi = mid - 1
        return lo

    def windows(self, lo: int, hi: int, top: int, step: int) -> np.ndarray:
        """Hashes of the WINDOW-long spans that start at lo, lo + step, ... before hi, all brought to power ``top``."""
        at = np.arange(lo, hi - WINDOW + 1, step)
        out = np.zeros(len(at), np.uint64)
        for k in (0, 1):
            p = self.lanes[k]
            h = _reduce(p[at + WINDOW] + PRIME - p[at])
            out = (out << np.uint64(32)) | _reduce(h * _powers(k, top + 1)[top - at])
        return out


def likeness(a: PrefixHash, b: PrefixHash) -> tuple[float, int, int]:
    """Share of equal text (0 to 1), longest common prefix and suffix.

    The common prefix and suffix come from binary searches; between them, each
    WINDOW-long block of ``a`` counts if a span of ``b`` has its hash.
    """
    least = min(a.n, b.n)
    if not a.n or not b.n:
        return float(a.n == b.n), 0, 0
    head = a.common_extension(0, b, 0, least)
    tail = a.common_extension(a.n, b, b.n, least - head, back=True)
    matched = head + tail
    if a.n - matched >= WINDOW and b.n - matched >= WINDOW:
        top = max(a.n, b.n)
        blocks = a.windows(head, a.n - tail, top, WINDOW)
        spans = np.sort(b.windows(head, b.n - tail, top, 1))
        at = np.minimum(np.searchsorted(spans, blocks), len(spans) - 1)
        matched += WINDOW * int((spans[at] == blocks).sum())
    return min(1.0, 2.0 * min(matched, least) / (a.n + b.n)), head, tail


def edited(text: str, nxt: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + nxt[:half]


# ------------------------------------------------------------------ rows and their neighbours
def _places(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    """Places of rows in rising order (null ids first), as byte strings that compare alike."""
    out = np.zeros((len(ids), 17), np.uint8)
    out[:, 0] = np.asarray(ids.is_valid())
    for at, column in ((1, ids.fill_null(0)), (9, hashes)):
        flipped = np.asarray(column).astype(np.int64) ^ np.int64(-1 << 63)
        out[:, at:at + 8] = flipped.astype(">i8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view("S17")


def _cuts(rows: DataFrame, n: int) -> tuple[list[tuple[int | None, int]], bool]:
    """About n - 1 places that part rows evenly, as (id, hash); and whether one id (or none) has several."""
    total, valid = rows.agg(F.count(F.lit(1)), F.count("id")).first()
    null_parts = round(n * (total - valid) / total) if total else 0
    parts = max(1, n - null_parts)
    points = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 20 * n).alias("c")).first()["c"] or []
    least = -1 << 63

    def spread(i: int | None, k: int) -> list[tuple[int | None, int]]:
        return [(i, least + j * (1 << 64) // k) for j in range(k)]

    cuts = spread(None, null_parts)[1:]
    if null_parts:
        cuts.append((least, least))                                        # the ids begin
    for i, k in sorted(Counter(points).items()):                           # an id that is several percentiles is cut by hash
        cuts += spread(i, k)
    return sorted(set(cuts), key=lambda c: (c[0] is not None, c)), null_parts > 1 or len(set(points)) < len(points)


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, hash, bucket, extra): ranges of rows in buckets 0, 1, ... upwards, where each bucket also
    gets, as extra rows, the rows that come first after it in descending order."""
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts, within = _cuts(rows, n)
    # without an id of several ranges, ids alone tell the range, and the texts needn't be read for it
    rows = rows.withColumn("hash", F.xxhash64("text") if within else F.lit(0).cast("long"))
    edges = _places(pa.array([i for i, _ in cuts], pa.int64()), pa.array([h if within else -1 << 63 for _, h in cuts], pa.int64()))

    def bucket(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
        return np.searchsorted(edges, _places(ids, hashes), side="right")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch_of(pa.schema([("bucket", pa.int32()), ("id", pa.int64()), ("hash", pa.int64())]), [bucket(*b.columns), *b.columns])

    first = rows.select("id", "hash").mapInArrow(tops, "bucket int, id long, hash long") \
        .groupBy("bucket").agg(F.max(F.struct("id", "hash")).alias("top"))
    have = sorted((r["bucket"], tuple(r["top"])) for r in first.collect())  # one row per bucket
    # the first row of a bucket follows the last of the next bucket up; the very first follows the very last
    goes = sorted(((top, have[(k + 1) % len(have)][0]) for k, (_, top) in enumerate(have)), key=lambda g: (g[0][0] is not None, g[0]))
    tops_at = _places(pa.array([i for (i, _), _ in goes], pa.int64()), pa.array([h for (_, h), _ in goes], pa.int64()))
    to = np.array([t for _, t in goes], np.int32)
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("hash", pa.int64()), ("bucket", pa.int32()), ("extra", pa.bool_())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, text, hashes = b.columns
            yield batch_of(schema, [key, text, hashes, bucket(key, hashes), np.zeros(len(key), bool)])
            place = _places(key, hashes)
            at = np.minimum(np.searchsorted(tops_at, place), len(tops_at) - 1)
            some = np.flatnonzero(tops_at[at] == place)
            if len(some):
                yield batch_of(schema, [*(c.take(pa.array(some)) for c in (key, text, hashes)), to[at[some]], np.ones(len(some), bool)])

    return rows.mapInArrow(deal, "id long, text string, hash long, bucket int, extra boolean")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows sorted for a scan in which each is followed by the next by descending id.

    One shuffle of the texts.  The only rows sent twice are the first of each
    range, so no task sees more than its range and one row (and rows equal to it).
    """
    n = partitions(docs.sparkSession)
    dealt = _dealt(docs, id_col, text_col)
    return dealt.repartitionById(n, F.col("bucket")).sortWithinPartitions(
        F.desc("bucket"), F.asc("extra"), F.desc_nulls_last("id"), F.xxhash64("text").desc(), F.asc("text"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, next_prefix long, next_suffix long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: fingerprints of its text and of its text edited with the next one's, and their likeness.

    ``next_prefix`` and ``next_suffix`` are the longest common prefix and suffix
    with the next document in code points.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64()), ("next_prefix", pa.int64()), ("next_suffix", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None                                  # id, text, hash, bucket of the row before
        out: list[tuple] = []
        for b in batches:
            columns = [b.column(k) for k in ("id", "text", "bucket", "extra")]
            for k in range(b.num_rows):
                i, text, bucket, extra = (c[k].as_py() for c in columns)
                own = None
                if waiting is not None and waiting[3] == bucket:
                    own = PrefixHash(text)
                    edit = edited(waiting[1], text)
                    h = PrefixHash(edit)
                    near, head, tail = likeness(waiting[2], own)
                    out.append((waiting[0], waiting[2].n, hashlib.sha256(edit.encode()).hexdigest(), waiting[2].digest(),
                                h.digest(), likeness(waiting[2], h)[0], near, head, tail))
                waiting = None if extra else (i, text, own or PrefixHash(text), bucket)
                if len(out) >= 2048:
                    yield batch_of(schema, list(zip(*out)))
                    out = []
        if out:
            yield batch_of(schema, list(zip(*out)))

    return with_next(docs, id_col, text_col).mapInArrow(scan, RESULT)
