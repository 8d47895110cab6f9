"""Benchmark decontamination: pairs of near words as seeds, then Smith-Waterman alignment.

Words are compared by hash.  A leak is a passage whose Smith-Waterman alignment
with an item (``match`` a word, ``miss`` for an exchanged, added or left-out word)
scores ``limit`` or more of the item's own score.  With n words in the item and m
matched ones, such an alignment has at most 2 (m - limit n) misses, so at least
``limit n - 1`` of the m - 1 steps from one matched word to the next have one miss
or none.  In such a step the two words stand one or two apart on both sides.
These pairs are the seeds, so no edited copy that scores enough is without them,
and a text is aligned only where as many of them as a leak must have lie on near
diagonals.

Every seed is counted in the whole corpus (partial counts per task).  Of pairs
in more than one of ``FREQUENT`` words an item keeps what it needs: leaving some
out lowers the number of hits asked for by as many steps as they can hold, never
below ``FEWEST`` (an item of frequent pairs alone keeps them).  So frequent pairs
cost no hits and lose no leaks; Smith-Waterman decides.

Benchmark items are sent to the tasks in blocks of at most ``block_words`` words
whose size is counted first; a larger benchmark takes one scan per block, so the
memory of a task does not grow with it and no item is left out.

Cases: null and empty texts have no words and match nothing; an item of one or
two words has one seed, all its words; equal items are reported each under
its id; repeated documents each get their rows; long texts are read whole, and
aligned only around their seeds; further columns are ignored by ``find_leaks``
and kept by ``without_leaks``, which decides row by row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.blocks import LETTER_WORDS, Words, batch_of, mix, pieces, text_bytes

MATCH, MISS = 2, -1
LIMIT = 0.5
BLOCK_WORDS = 4_000_000
#: a pair that is seen more than once in so many words of the corpus is frequent; the fewest hits that are asked for if some are left out
FREQUENT, FEWEST = 20_000, 3
#: hits that a task holds at once
HITS = 1 << 21
#: hits held at once where a task keeps whole rows in the JVM beside it
FEW_HITS, SMALL_PIECE = 1 << 18, 1 << 18
SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("seeds", pa.int64()),
                    ("start", pa.int64()), ("end", pa.int64())])
SCHEMA_SQL = "doc_id long, item_id long, score double, seeds long, start long, end long"


def pairs_of(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of single words and of words one and two apart in one row, and the index of the last word of each."""
    hashes, at = [mix(words)], [np.arange(len(words))]
    for step in (1, 2):
        there = np.flatnonzero(row[step:] == row[:-step])
        with np.errstate(over="ignore"):
            hashes.append(mix(words[there] * np.uint64(0xD6E8FEB86659FD93) + words[there + step]))
        at.append(there + step)
    return np.concatenate(hashes), np.concatenate(at)


def steps_in(ends: np.ndarray, starts: np.ndarray) -> int:
    """The most of these steps that an alignment can take one after the other."""
    n, last = 0, -1
    for end, start in sorted(zip(ends.tolist(), starts.tolist())):
        if start >= last:
            n, last = n + 1, end
    return n


class Items:
    """A block of benchmark items: words, and where each seed stands (by sorted hash)."""

    def __init__(self, ids: list[int], texts: list[str], limit: float = LIMIT):
        off, data = text_bytes(pa.array(texts, pa.string()))
        w = Words(off, data, LETTER_WORDS)
        keep = [r for r in range(len(ids)) if w.first[r + 1] > w.first[r]]
        self.ids = [ids[r] for r in keep]
        self.words = [w.hash[w.first[r]:w.first[r + 1]] for r in keep]
        size = np.array([len(x) for x in self.words], np.int64)
        #: steps of one miss or none in any leak, and the most that its diagonals differ
        self.needs = np.maximum(1, np.ceil(limit * size - 1e-9).astype(np.int64) - 1)
        self.reach = np.floor(2 * size * (1 - limit) + 1e-9).astype(np.int64)
        item = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        words = np.concatenate(self.words) if len(size) else np.zeros(0, np.uint64)
        gram, at = pairs_of(words, item)
        # the first part of the hashes has single words, which only an item of one word has as a seed
        apart = np.repeat([0, 1, 2], [len(words), *np.diff([len(words), *self._edges(item)])])
        ok = (apart > 0) | (size[item[at]] == 1)
        gram, at, apart = gram[ok], at[ok], apart[ok]
        order = np.argsort(gram, kind="stable")
        self.gram, self.item = gram[order], item[at][order]
        self.at, self.apart = (at - first[item[at]])[order], apart[order]
        self.grams = np.unique(self.gram)

    @staticmethod
    def _edges(item: np.ndarray) -> tuple[int, int]:
        one = len(item) + int((item[1:] == item[:-1]).sum())
        return one, one + int((item[2:] == item[:-2]).sum())

    def without_frequent(self, count: np.ndarray, usual: float) -> "Items":
        """Leave out seeds that are seen more than ``usual`` times (``count`` by ``grams``), most frequent first,
        as long as any leak still has ``FEWEST`` hits of the others."""
        n = count[np.searchsorted(self.grams, self.gram)]
        stay = np.ones(len(self.gram), bool)
        often = np.flatnonzero(n > usual)
        often = often[np.lexsort((self.gram[often], -n[often], self.item[often]))]
        edges = np.flatnonzero(np.append(True, self.item[often][1:] != self.item[often][:-1])) if len(often) else []
        for lo, hi in zip(edges, [*edges[1:], len(often)]):
            own, k = often[lo:hi], int(self.item[often[lo]])
            # the most seeds that can go: their number of steps grows with each
            low, high = 0, len(own)
            while low < high:
                mid = (low + high + 1) // 2
                some = own[:mid]
                if self.needs[k] - steps_in(self.at[some], self.at[some] - self.apart[some]) >= FEWEST:
                    low = mid
                else:
                    high = mid - 1
            some = own[:low]
            stay[some] = False
            self.needs[k] -= steps_in(self.at[some], self.at[some] - self.apart[some])
        self.gram, self.item, self.at, self.apart = (x[stay] for x in (self.gram, self.item, self.at, self.apart))
        self.keys, self.first = np.unique(self.gram, return_index=True)
        self.last = np.append(self.first[1:], len(self.gram))
        return self


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: best score, first word and word after the last of its span in the passage.

    One row per word of the item, over the whole passage at once; a running
    maximum carries gaps along the passage.
    """
    n = len(passage)
    score, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    steps = -MISS * np.arange(n + 1)
    for word in item:
        up = score + MISS                                 # the item's word is left out
        cross = np.zeros(n + 1, np.int64)
        cross[1:] = score[:-1] + np.where(passage == word, MATCH, MISS)
        came = np.arange(n + 1)
        came[1:] = np.where(score[:-1] > 0, begin[:-1], np.arange(n))
        row = np.maximum(np.maximum(up, cross), 0)
        start = np.where(row == 0, np.arange(n + 1), np.where(cross >= up, came, begin))
        lifted = row + steps                              # words of the passage left out
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row = np.maximum(top - steps, 0)
        begin, score = start[source], row
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), int(begin[at]), at)
    return best


def leaks_in(items: Items, words: Words, limit: float, hits: int = HITS) -> Iterator[tuple[int, int, float, int, int, int]]:
    """Leaks of a piece's texts: row, item, score, seeds, and the span in words."""
    gram, at = pairs_of(words.hash, words.row)
    place = found_in(items.keys, gram)
    some = np.flatnonzero(place >= 0)
    some = some[np.argsort(at[some], kind="stable")]
    place, at = place[some], at[some]
    many = items.last[place] - items.first[place]
    total = np.cumsum(many)
    rows = words.row[at]
    ends = np.append(np.flatnonzero(rows[1:] != rows[:-1]) + 1, len(rows)) if len(rows) else []
    lo, before = 0, 0
    for j, end in enumerate(ends):                        # whole rows, and as many of them as hold so many hits
        if j + 1 == len(ends) or total[ends[j + 1] - 1] - before > hits:
            yield from _aligned(items, words, place[lo:end], at[lo:end], many[lo:end], limit)
            lo, before = end, int(total[end - 1])


def _aligned(items: Items, words: Words, place: np.ndarray, at: np.ndarray, many: np.ndarray,
             limit: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    own = np.repeat(np.arange(len(place)), many)
    entry = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + items.first[place[own]]
    at, item = at[own], items.item[entry]
    row = words.row[at]
    there, gram = items.at[entry], place[own]
    diagonal = at - words.first[row] - there
    order = np.lexsort((diagonal, item, row))
    row, item, there, gram, diagonal = (x[order] for x in (row, item, there, gram, diagonal))
    group = np.cumsum(np.append(0, (row[1:] != row[:-1]) | (item[1:] != item[:-1]))) if len(row) else row
    span = int(diagonal.max() - diagonal.min() + items.reach.max() + 1) if len(row) else 1
    key = group * span + diagonal
    stop = np.searchsorted(key, key + items.reach[item], side="right")   # hits of one leak lie from here to there
    dense = np.flatnonzero(stop - np.arange(len(key)) >= items.needs[item])
    best: dict[tuple[int, int], tuple] = {}
    lo = 0
    while lo < len(dense):                                # windows that meet are one passage
        first, last = int(dense[lo]), int(stop[dense[lo]])
        k, r = int(item[first]), int(row[first])
        enough = False
        while lo < len(dense) and int(dense[lo]) < last:
            last = int(stop[dense[lo]])
            # a word of the item ends one step of an alignment at most
            enough = enough or len(set(there[dense[lo]:last].tolist())) >= items.needs[k]
            lo += 1
        if enough:
            size, reach = len(items.words[k]), int(items.reach[k])
            text = words.hash[words.first[r]:words.first[r + 1]]
            start = max(0, int(diagonal[first]) - reach)
            end = min(len(text), int(diagonal[last - 1]) + size + reach)
            score, a, b = align(text[start:end], items.words[k])
            found = (score / (MATCH * size), len(set(gram[first:last].tolist())), start + a, start + b)
            if found[0] >= limit:
                best[r, k] = max(best.get((r, k), found), found)
    for (r, k), found in best.items():
        yield r, k, *found


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that it holds: score, seeds, and the span in words (from 0, end exclusive)."""
    texts = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    out = None
    for items in item_blocks(benchmark, limit, block_words):
        part = _find_block(texts, items, limit)
        out = part if out is None else out.union(part)
    return out


def item_blocks(benchmark: DataFrame, limit: float, block_words: int) -> Iterator[Items]:
    items = benchmark.selectExpr("cast(item_id as long) as item_id", "cast(text as string) as text").filter("text is not null")
    total = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0   # no text has more words
    blocks = max(1, math.ceil(total / block_words))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield Items([r["item_id"] for r in rows], [r["text"] for r in rows], limit)


def counted(texts: DataFrame, items: Items) -> Items:
    """The items, without frequent seeds that they don't need in these texts (column text)."""
    wanted = texts.sparkSession.sparkContext.broadcast(items.grams)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = wanted.value
        n, seen = np.zeros(len(keys), np.int64), 0
        for b in batches:
            for _, _, off, data in pieces(b.column(0)):
                w = Words(off, data, LETTER_WORDS)
                at = found_in(keys, pairs_of(w.hash, w.row)[0])
                n += np.bincount(at[at >= 0], minlength=len(keys))
                seen += len(w.hash)
        some = np.flatnonzero(n)
        yield batch_of(pa.schema([("at", pa.int32()), ("n", pa.int64())]), [np.append(some, -1), np.append(n[some], seen)])

    counts, total = np.zeros(len(items.grams), np.int64), 0
    if len(items.grams):
        for at, n in texts.select("text").mapInArrow(count, "at int, n long").groupBy("at").sum("n").collect():
            if at < 0:
                total = n
            else:
                counts[at] = n                            # one row per seed of the block
    return items.without_frequent(counts, total / FREQUENT)


def _find_block(texts: DataFrame, items: Items, limit: float) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(counted(texts, items))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for b in batches:
            for lo, _, off, data in pieces(b.column(1)):
                out = [(b.column(0)[lo + row].as_py(), block.ids[item], *rest)
                       for row, item, *rest in leaks_in(block, Words(off, data, LETTER_WORDS), limit)]
                if out:
                    yield batch_of(SCHEMA, list(zip(*out)))

    return texts.mapInArrow(scan, SCHEMA_SQL)


def found_in(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted keys, or -1; most hashes end at a table of their top 20 bits."""
    out = np.full(len(wanted), -1, np.int64)
    if len(keys):
        maybe = np.zeros(1 << 20, bool)
        maybe[keys >> np.uint64(44)] = True
        some = np.flatnonzero(maybe[wanted >> np.uint64(44)])
        at = np.minimum(np.searchsorted(keys, wanted[some]), len(keys) - 1)
        hit = keys[at] == wanted[some]
        out[some[hit]] = at[hit]
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows that hold no item, whatever their ids: the scan passes them on, and no join is needed."""
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    for items in item_blocks(benchmark, limit, block_words):
        docs = _clean_of(docs, counted(texts, items), text_col, limit)
    return docs


def _clean_of(docs: DataFrame, items: Items, text_col: str, limit: float) -> DataFrame:
    """Texts go to Python and one boolean comes back; the rows stay in the JVM."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    @F.arrow_udf("boolean")
    def clean_text(column: pa.Array) -> pa.Array:
        block = sent.value
        clean = np.ones(len(column), bool)
        for lo, _, off, data in pieces(column, SMALL_PIECE):
            for row, *_ in leaks_in(block, Words(off, data, LETTER_WORDS), limit, FEW_HITS):
                clean[lo + row] = False
        pa.default_memory_pool().release_unused()
        return pa.array(clean)

    return docs.filter(clean_text(F.col(f"`{text_col}`").cast("string")))
