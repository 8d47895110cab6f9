"""Vectorised words over Arrow text columns, and the shared folder.

A batch of texts is read as one byte buffer.  The word patterns of the
operators only tell ASCII bytes apart and every byte of a multi-byte UTF-8
character counts as a word byte, so words can be found on bytes exactly.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickframe.session import checkpoint_dir

PIECE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, np.uint64)
_LOCK = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``)."""
    return checkpoint_dir(spark)


def mounted_path(folder: str) -> str:
    """The local path of a shared folder that every worker mounts, for memory maps."""
    u = urlparse(folder)
    if u.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped models need a mounted shared folder, not {folder}")
    return u.path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ texts as bytes
def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null row is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if offsets is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes (a longer text is a run of its own):
    first row, row after the last, offsets within the run, bytes of the run."""
    off, data = text_bytes(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi, off[lo:hi + 1] - off[lo], data[off[lo]:off[hi]]
        lo = hi


# ------------------------------------------------------------------ words
def word_table(separators: np.ndarray, lower: bool) -> np.ndarray:
    """For each byte 0 if it ends a word, else one plus the (lower-cased) byte."""
    t = np.arange(1, 257, dtype=np.uint16)
    if lower:
        t[65:91] = t[97:123]
    t[separators] = 0
    return t


_SPACE = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: words [^\x20\x09-\x0D]+, as written and with A-Z lower-cased
RAW_WORDS, SPACE_WORDS = word_table(_SPACE, False), word_table(_SPACE, True)
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
LETTER_WORDS = word_table(np.array([b for b in range(128) if not chr(b).isalnum()]), True)


def powers(n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (grown as needed)."""
    global _POWERS
    if len(_POWERS) < n:
        with _LOCK, np.errstate(over="ignore"):
            size = max(n, 2 * len(_POWERS), 1024)
            p = np.full(size, _BASE, np.uint64)
            p[0] = 1
            _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _inverse(a: int) -> np.uint64:
    return np.uint64(pow(a, -1, 1 << 64))


_INV1, _INV2 = _inverse(0x94D049BB133111EB), _inverse(0xBF58476D1CE4E5B9)


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mix`."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
        x = x * _INV1
        x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
        x = x * _INV2
        return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


class Words:
    """Words of a run of texts: ``row`` of each, byte ``start`` and ``end``, 64-bit ``hash``.

    ``first`` has each row's first word (``first[r]:first[r + 1]`` are row r's words).
    """

    __slots__ = ("row", "start", "end", "hash", "first")

    def __init__(self, offsets: np.ndarray, data: np.ndarray, table: np.ndarray, breaks: np.ndarray | None = None):
        """``breaks``: bytes at which, within a word, another one begins."""
        rows = len(offsets) - 1
        n = len(data)
        mapped = table[data]
        inside = mapped != 0
        cut = np.zeros(n + 1, bool)
        if breaks is not None:
            cut[:n] = breaks
        cut[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        if len(self.start):
            at = np.arange(n, dtype=np.int64)
            at -= np.maximum.accumulate(np.where(begins, at, 0))
            longest = int((self.end - self.start).max())
            np.minimum(at, longest, out=at)
            with np.errstate(over="ignore"):
                h = np.add.reduceat(mapped * powers(longest + 1)[at], self.start)
                self.hash = mix(h + (self.end - self.start).astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.row = np.repeat(np.arange(rows), np.diff(self.first))


def runs_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words of one row, and the index of their first word."""
    h = words.hash
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = words.row[:n] == words.row[k - 1:]
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[j:n + j])
    at = np.flatnonzero(same)
    return out[at], at


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again: its lineage ends there and columns stay prunable."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(df: DataFrame, **columns: str) -> DataFrame:
    """``row`` (all columns of ``df``, by place) and the given columns of it: names of ``df`` can't clash with any other."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns)]).alias("row")
    return df.select(row, *[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def unboxed(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The columns ``names`` of boxed rows, some of them ``changed``."""
    return df.select(*[changed.get(c, F.col(f"row.c{k}")).alias(c) for k, c in enumerate(names)])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns beside those of ``df``: each with as many underscores as it needs to be none of them."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        while name in taken:
            name = "_" + name
        return name
    return [free("_" + n) for n in names]
