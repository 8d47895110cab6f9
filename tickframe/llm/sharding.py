"""Sharding by histogram sort: splitters from exact counts, then one exchange.

Rows have a 128-bit key: a hash of the text, then a hash of the id, so equal
texts lie next to each other and a large group of copies can still be cut
between its rows.  Each round counts the exact bytes below a set of candidate
boundaries over all rows (partial sums per task) and narrows the interval of
every splitter around its target, until the bytes below it meet the tolerance
or no row lies between the last two candidates.  Then rows move once, to ranges
of at most ``range_bytes``, and are numbered within their range; the counts of
the ranges before it complete the slot, so no task holds a whole shard.

Rows equal in id and text share a key.  Where such a key holds more bytes than a
boundary may miss, its rows are stored once with a number each, which lengthens
their key, and the boundaries are refined inside it.  The numbers are read from
the stored rows, so a task that runs again cuts at the same place.

Cases: a null text counts as no bytes; an empty table gives no rows; repeated
rows and rows without an id are cut like others; further columns pass through
whatever their names (``size``, ``shard`` and ``slot`` are replaced).
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.llm.blocks import batch_of, free_names, stored

#: hex digits of a key, and of the number that lengthens the key of repeated rows
KEY, NUMBER = 32, 16
#: bytes that a row takes besides its text
ROW_BYTES = 16


def sort_key(id_col: str, text_col: str) -> Column:
    """The key as 32 hex digits: their order is the order of the key."""
    return F.concat(_hex(F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))), _hex(F.xxhash64(F.col(id_col))))


def _hex(c: Column) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def row_size(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def _edges(cuts: list[int], digits: int) -> np.ndarray:
    return np.array([b"%0*X" % (digits, c) for c in cuts], f"S{digits}")


def histogram(keys: DataFrame, probes: list[int], digits: int = KEY) -> list[tuple[int, int]]:
    """Exact (bytes, rows) below each probe."""
    edges = _edges(probes, digits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(edges, np.array(b.column(0).to_pylist(), edges.dtype), side="right")
            np.add.at(size, at, np.asarray(b.column(1)))
            rows += np.bincount(at, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield batch_of(pa.schema([("at", pa.int32()), ("size", pa.int64()), ("rows", pa.int64())]), [some, size[some], rows[some]])

    got = keys.select("key", "size").mapInArrow(count, "at int, size long, rows long").groupBy("at").sum("size", "rows").collect()
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for at, s, r in got:                                  # at most one row per probe
        size[at], rows[at] = s, r
    return list(zip(np.cumsum(size)[:-1].tolist(), np.cumsum(rows)[:-1].tolist()))


def splitters(keys: DataFrame, targets: list[float], total: tuple[int, int], tolerance: float, digits: int = KEY,
              first: list[int] | None = None, fan: int = 63, most: int = 100_000) -> tuple[list[int], list[int]]:
    """For each target (rising) a boundary with (nearly) that many bytes below it; and
    the keys of several rows that hold a target farther than ``tolerance`` from their edges.

    ``known`` holds every probe so far in key order; a target lies between the
    last probe with no more bytes than it and the next one.  A round sets up to
    ``fan`` probes for each open target, and about ``most`` in all; ``first`` are
    probes to begin with.
    """
    space = 1 << 4 * digits
    known = [(0, 0, 0), (space, *total)]                  # key, bytes and rows below it
    chosen = [0] * len(targets)
    open_ = set(range(len(targets)))
    repeated: set[int] = set()
    probes = set(first or []) - {0, space}
    while open_:
        if probes:
            new = sorted(probes)
            known = sorted([*known, *((p, *c) for p, c in zip(new, histogram(keys, new, digits)))])
        below = [b for _, b, _ in known]
        each = max(1, min(fan, most // len(open_)))
        probes = set()
        for t in list(open_):
            at = min(max(1, bisect_right(below, targets[t])), len(known) - 1)
            (lo, lo_bytes, lo_rows), (hi, hi_bytes, hi_rows) = known[at - 1], known[at]
            chosen[t] = lo if targets[t] - lo_bytes <= hi_bytes - targets[t] else hi
            if min(targets[t] - lo_bytes, hi_bytes - targets[t]) <= tolerance or hi_rows - lo_rows <= 1:
                open_.discard(t)
            elif hi - lo <= 1:
                open_.discard(t)
                repeated.add(lo)
            else:
                probes |= {lo + (hi - lo) * k // (each + 1) for k in range(1, each + 1)} - {lo, hi}
    return [min(c, space - 1) for c in chosen], sorted(repeated)


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          tolerance: float = 0.0005, range_bytes: int = 64 << 20, most_ranges: int = 40_000) -> DataFrame:
    """``docs`` with ``size``, ``shard`` (0 .. shards - 1, nearly equal bytes) and ``slot`` (gapless from 0).

    ``tolerance`` is the allowed error of a boundary as a share of a shard's bytes.
    A shard is numbered in ranges of about ``range_bytes``; beyond ``most_ranges``
    in all they get larger.
    """
    key, part = free_names(docs, "key", "part")
    rows = docs.withColumn("size", row_size(text_col)).withColumn(key, sort_key(id_col, text_col))
    keys = stored(rows.select(F.col(key).alias("key"), "size"))                # narrow: rounds don't read the texts again
    whole = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = (whole[0] or 0, whole[1])
    per = max(1, min(math.ceil(total[0] / shards / range_bytes), most_ranges // shards))    # ranges in a shard
    n = shards * per
    targets, error, digits = [total[0] * k / n for k in range(1, n)], tolerance * total[0] / shards, KEY
    cuts, repeated = splitters(keys, targets, total, error)
    if repeated:                                                               # at most one per target
        digits = KEY + NUMBER
        among = np.array(["%0*X" % (KEY, k) for k in repeated])

        @F.pandas_udf("boolean")
        def is_repeated(k):
            return k.isin(among)

        number = _hex(F.xxhash64(F.monotonically_increasing_id()))
        numbered = stored(rows.filter(is_repeated(key)).withColumn(key, F.concat(key, number)))
        rows = rows.filter(~is_repeated(key)).withColumn(key, F.rpad(key, digits, "0")).unionByName(numbered)
        keys = keys.filter(~is_repeated("key")).withColumn("key", F.rpad("key", digits, "0")) \
            .unionAll(numbered.select(F.col(key).alias("key"), "size"))
        wide = 4 * NUMBER
        cuts, _ = splitters(keys, targets, total, error, digits, [c << wide for k in repeated for c in (k, k + 1)] + [c << wide for c in cuts])
    edges = _edges(cuts, digits)
    before = [0] + [r for _, r in histogram(keys, cuts, digits)]
    ahead = [before[k] - before[k - k % per] for k in range(n)]         # rows of its shard before each range

    @F.pandas_udf("int")
    def range_of(k):
        import pandas as pd
        return pd.Series(np.searchsorted(edges, k.to_numpy().astype(edges.dtype), side="right").astype(np.int32))

    ranged = rows.withColumn(part, range_of(key))
    place = F.row_number().over(Window.partitionBy(part).orderBy(key, id_col)) - 1
    # one literal for all ranges: an array written as text
    offset = F.element_at(F.split(F.lit(",".join(map(str, ahead))), ",").cast("array<long>"), F.col(part) + 1)
    return (ranged.withColumn("slot", (place + offset).cast("long"))
            .withColumn("shard", F.expr(f"cast({part} div {per} as int)")).drop(part, key))
