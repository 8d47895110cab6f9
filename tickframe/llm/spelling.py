"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

Words are maximal runs of Latin letters, lower-cased in A-Z.  Two words are near
if one inserted, deleted or replaced code point makes them equal, that is, if
their common prefix and common suffix together reach the longer length minus one.

An edit lies either behind the first half of the shorter word or before its
second half, so near words share one of the two.  Words meet under their halves
(for their own length and for the length below, as the other word may be
shorter); a half with many words deals them into blocks, and a task takes two of
them.  A tile is a padded matrix of code points of one block against another:
prefixes are compared column by column from the left, suffixes from the right.
A tile returns no pairs, only each word's number of near words and the best of
them, so rows grow with the words and not with the pairs; nothing is capped.

A word's form is its near word of largest count (ties: the smallest) if that is
at least ``ratio`` times the word's own count.  Counts grow along forms, so they
end at a root, which pointer doubling finds.

Cases: a null or empty text has no words; a null id is the empty text in the
hash that damages words; repeated rows count again; an empty table gives no
rows; further columns are ignored.  A run of any length is one word.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.blocks import Words, batch_of, partitions, pieces, word_table, written

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: words of a block, and rows of a tile that are compared at once
BLOCK, ROWS = 2048, 128
#: one run in so many loses a code point (0: none)
DAMAGE = 31
#: runs of more bytes take zlib instead of the columns of the table
LONG = 48

_LETTERS = word_table(np.array([b for b in range(256) if not (chr(b).isascii() and chr(b).isalpha() or 0x80 <= b <= 0xBF or b == 0xC3)]), True)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def letter_runs(off: np.ndarray, data: np.ndarray) -> Words:
    """Runs of ``[A-Za-z\\u00C0-\\u00FF]``: of the longer characters only those that begin with byte C3."""
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    foreign = (data >= 0x80) & (data != 0xC3) & ~after
    return Words(off, np.where(foreign, np.uint8(0x20), data), _LETTERS)


def crc_of(low: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each run behind what its row's crc has seen, all runs a byte at a time."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    state = begun[order] ^ np.uint32(0xFFFFFFFF)
    first, sizes = start[order], size[order]
    whole = int(np.searchsorted(-sizes, -LONG, side="left"))   # runs before it are longer than LONG
    for j in range(int(sizes[whole]) if whole < len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -j, side="left"))      # runs with a byte j
        s = state[whole:n]
        state[whole:n] = _CRC[(s ^ low[first[whole:n] + j]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:whole].tolist():
        out[i] = zlib.crc32(low[start[i]:end[i]].tobytes(), int(begun[i]))
    return out


def strings(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    off = np.append(0, np.cumsum(size))
    at = np.arange(off[-1]) + np.repeat(start - off[:-1], size)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(low[at].tobytes()))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points.

    ``damage``: a run whose crc32 of ``<id>:<run>`` it divides loses the code point at crc32 modulo length.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo, hi, off, data in pieces(b.column(1), 2 << 20):
                w = letter_runs(off, data)
                low = _LOWER[data]
                wide = np.append(0, np.cumsum(data == 0xC3))
                length = w.end - w.start - (wide[w.end] - wide[w.start])
                some = np.flatnonzero(length >= min_length)
                if not len(some):
                    continue
                start, end, length, hashes = w.start[some], w.end[some], length[some], w.hash[some]
                hit = np.zeros(len(some), bool)
                changed: Counter = Counter()
                if damage:
                    begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids[lo:hi]], np.uint32)
                    crc = crc_of(low, start, end, begun[w.row[some]])
                    hit = crc % np.uint32(damage) == 0
                    for k in np.flatnonzero(hit & (length > min_length)).tolist():
                        s = low[start[k]:end[k]].tobytes().decode()
                        at = int(crc[k]) % len(s)
                        changed[s[:at] + s[at + 1:]] += 1
                kept = np.flatnonzero(~hit)
                _, first, n = np.unique(hashes[kept], return_index=True, return_counts=True)
                yield batch_of(schema, [strings(low, start[kept[first]], end[kept[first]]), n])
                if changed:
                    yield batch_of(schema, [list(changed), list(changed.values())])

    texts = docs.selectExpr(f"cast(`{id_col}` as string) as id", f"cast(`{text_col}` as string) as text")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def halves(words: DataFrame, min_length: int) -> DataFrame:
    """(key, m, side, word, n): a word under the halves it shares with near words, ``m`` the length of the shorter one."""
    at = F.explode(F.expr("filter(array(length(word), length(word) - 1), m -> m >= %d)" % min_length)).alias("m")
    side = F.explode(F.array(F.lit(False), F.lit(True))).alias("tail")
    half = F.expr("if(tail, right(word, m - m div 2), left(word, m div 2))")
    return words.select("word", "n", at).select("*", side).withColumn("key", F.xxhash64("m", "tail", half))


class Block:
    """Words as code-point matrices, aligned on the left and on the right."""

    __slots__ = ("left", "right", "size")

    def __init__(self, words: list[str], width: int, pad: int):
        self.size = np.array([len(w) for w in words])
        m = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint8)   # the letters are Latin-1
        at = np.arange(width)
        self.left = np.where(at < self.size[:, None], m, np.uint8(pad))
        from_right = at - (width - self.size[:, None])
        self.right = np.where(from_right >= 0, np.take_along_axis(m, np.maximum(from_right, 0), 1), np.uint8(pad))[:, ::-1]


def tile(a: Block, b: Block, m: int, tail: bool) -> np.ndarray:
    """Which words of ``a`` and ``b`` are near, the shorter of ``m`` code points, if this half is the one that counts."""
    def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        alive = np.ones((len(x), len(y)), bool)
        n = np.zeros((len(x), len(y)), np.int16)
        for c in range(x.shape[1]):
            alive &= x[:, c, None] == y[None, :, c]
            if not alive.any():
                break
            n += alive
        return n

    prefix, suffix = common(a.left, b.left), common(a.right, b.right)
    short, long = np.minimum(a.size[:, None], b.size[None, :]), np.maximum(a.size[:, None], b.size[None, :])
    near = (short == m) & (prefix + suffix >= long - 1) & ((long > m) | (prefix < m))
    return near & ((prefix < m // 2) & (suffix >= m - m // 2) if tail else prefix >= m // 2)


def compare(words: list[str], counts: list[int], block: list[int], m: int, tail: bool, same: bool) -> tuple[list, list, list, list]:
    """Word, number of near words, best near word and its count, of the words of one or two blocks."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))       # so the first near word is the best
    words, counts, block = ([x[i] for i in order] for x in (words, counts, block))
    sides = [np.arange(len(words))] * 2 if same else [np.flatnonzero(np.array(block) == k) for k in (0, 1)]
    if not len(sides[0]) or not len(sides[1]):
        return [], [], [], []
    number, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    columns = Block([words[i] for i in sides[1]], m + 1, 1)
    for lo in range(0, len(sides[0]), ROWS):
        rows = sides[0][lo:lo + ROWS]
        near = tile(Block([words[i] for i in rows], m + 1, 0), columns, m, tail)
        some = np.flatnonzero(near.any(axis=1))
        number[rows] += near.sum(axis=1)
        best[rows[some]] = np.minimum(best[rows[some]], sides[1][near[some].argmax(axis=1)])
        if not same:
            some = np.flatnonzero(near.any(axis=0))
            number[sides[1]] += near.sum(axis=0)
            best[sides[1][some]] = np.minimum(best[sides[1][some]], rows[near[:, some].argmax(axis=0)])
    found = np.flatnonzero(number).tolist()
    return [words[i] for i in found], number[found].tolist(), [words[best[i]] for i in found], [counts[best[i]] for i in found]


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the words of ``words`` (word, n; distinct) that have a near word."""
    n = partitions(words.sparkSession)
    keys = halves(words, min_length)
    big = keys.groupBy("key").agg(F.count(F.lit(1)).alias("p")).filter("p > 1") \
        .select("key", F.ceil(F.col("p") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("word", F.lit(7)), F.col("blocks")).cast("int")
    dealt = keys.join(big, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .selectExpr("key", "m", "tail", "least(own, other) as lo", "greatest(own, other) as hi", "int(own > other) as second", "word", "n")
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                       # the last group of a batch may go on: two blocks at most

        def groups(t: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            out = [[], [], [], []]
            m, tail, lo, hi, second, words, counts = (t.column(c).to_pylist() for c in ("m", "tail", "lo", "hi", "second", "word", "n"))
            for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
                if z - a > 1:
                    for x, y in zip(out, compare(words[a:z], counts[a:z], second[a:z], m[a], tail[a], lo[a] == hi[a])):
                        x += y
            if out[0]:
                yield batch_of(schema, out)

        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            if not t.num_rows:
                continue
            change = np.zeros(t.num_rows, bool)
            change[0] = True
            for c in ("key", "m", "tail", "lo", "hi"):
                x = t.column(c).to_numpy()
                change[1:] |= x[1:] != x[:-1]
            ends = np.flatnonzero(change)
            yield from groups(t, ends)
            held = t.slice(int(ends[-1]))
        if held is not None:
            yield from groups(held, np.array([0, held.num_rows]))

    order = ["key", "m", "tail", "lo", "hi"]
    found = dealt.repartition(n, "key", "lo", "hi").sortWithinPartitions(*order) \
        .mapInArrow(run, "word string, n_near long, best string, best_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("late"), "best")).alias("best")) \
        .select("word", "n_near", F.col("best.best").alias("best"), (-F.col("best.late")).alias("best_n"))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, root) of (word, form), by doubling: no chain has more than ``longest`` steps."""
    out = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(longest, 1))))):
        on = out.select(F.col("word").alias("root"), F.col("root").alias("further"))
        out = written(out.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return out


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = RATIO, damage: int = DAMAGE, block: int = BLOCK) -> DataFrame:
    """Per word of ``min_count`` or more: form, root, n, n_near, form_n."""
    words = written(word_counts(docs, id_col, text_col, min_length, damage).filter(F.col("n") >= min_count))
    best = near_words(words, min_length, block)
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    all_words = written(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
                                                                F.when(form.isNotNull(), F.col("best_n")).alias("form_n")))
    top = words.agg(F.max("n")).first()[0] or 1
    root = roots(all_words.filter("form is not null"), int(math.log(max(top, 1), ratio)) + 1)
    return all_words.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
