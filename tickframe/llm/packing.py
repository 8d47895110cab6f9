"""Packing token streams into sequences by order-preserving dynamic programming.

Documents keep their order (by id).  Each range of ids is one stream of tokens,
cut into windows of at most ``size`` tokens.  A cut costs nothing at the end of
a document, a little at the end of a sentence and more elsewhere; a window costs
its padding.  With ``f(j)`` the least cost of the stream up to cut ``j``,
``f(j) = min over i of f(i) + i, i >= j - size, plus size - j + cost(j)``: the
minimum over a sliding window, which a monotone queue gives in constant time.
The rest at the end of a range is cut into powers of two, which need no padding.

Tokens come from a public tokenizer that lower-cases and whose words never cross
ASCII white space, so each distinct word is encoded once and its ids are gathered.

Cases: a null text is empty and has only its end token; rows of one id are
ordered by a hash of the text and then the text, so many of them make several
ranges; null ids come last; very long texts are cut like others; an
empty table gives no pieces; further columns of the input are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.blocks import RAW_WORDS, SPACE_WORDS, Words, batch_of, partitions, pieces

SIZE = 2048
END_ID = 1
#: cost, in tokens of padding, of a cut after a document, after a sentence, elsewhere
COSTS = (0.0, 1.0, 16.0)
#: sentence ends closer than this to the next one are not tried
GRID = 32
#: where nothing ends for this many tokens, cuts are tried at this distance
STRIDE = 48
STREAM = 1 << 17
CACHED_WORDS = 500_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class HashTable:
    """Numbers by 64-bit hash: open addressing, looked up and filled for whole arrays."""

    def __init__(self, bits: int):
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.mask = np.uint64((1 << bits) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        out, open_, at = np.full(len(h), -1, np.int64), np.arange(len(h)), h & self.mask
        while len(open_):
            key, wanted = self.keys[at], h[open_]
            hit = key == wanted
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (key != 0)
            open_, at = open_[on], (at[on] + np.uint64(1)) & self.mask
        return out

    def add(self, h: np.ndarray, values: np.ndarray) -> None:
        """Distinct hashes that aren't there yet."""
        at = h & self.mask
        while len(h):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[free]
            won = self.keys[at] == h
            self.values[at[won]] = values[won]
            h, values, at = h[~won], values[~won], (at[~won] + np.uint64(1)) & self.mask


def word_breaks(data: np.ndarray) -> np.ndarray:
    """Where a mark .,!?;: follows an ASCII letter or digit, or the other way round: the tokenizer splits there too."""
    kind = _KINDS[data]
    out = np.zeros(len(data), bool)
    out[1:] = (kind[1:] * kind[:-1]) == 2
    return out


_KINDS = np.array([1 if chr(b) in ".,!?;:" else 2 if b < 128 and chr(b).isalnum() else 0 for b in range(256)], np.uint8)


class WordIds:
    """Ids of words, each encoded once while it stays cached; one per worker and tokenizer."""

    _of: dict[str, "WordIds"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)          # ids that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    @classmethod
    def of(cls, path: str) -> "WordIds":
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def clear(self) -> None:
        self.table = HashTable((2 * CACHED_WORDS).bit_length())
        self.size = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self.words = self.used = 0

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        ids: list[np.ndarray] = []
        sizes = np.zeros(len(words), np.int64)
        # words of Latin letters have one end each, so many can be encoded as one text
        plain = [k for k, w in enumerate(words) if w.isalpha() and max(w) < "\u0130"]
        groups = [plain[k:k + 256] for k in range(0, len(plain), 256)]
        order: list[int] = []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join([words[k] for k in g]) for g in groups], add_special_tokens=False)):
            flat = np.array(e.ids, np.uint32)
            last = np.flatnonzero(self.ends[flat])
            if len(last) == len(group):
                ids.append(flat)
                sizes[group] = np.diff(last, prepend=-1)
                order += group
        done = set(order)
        rest = [k for k in range(len(words)) if k not in done]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
            ids.append(np.array(e.ids, np.uint32))
            sizes[k] = len(e.ids)
        order += rest
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        start = np.zeros(len(words), np.int64)
        start[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat, np.stack([start, sizes])

    def add(self, hashes: np.ndarray, words: list[str]) -> None:
        flat, (start, size) = self.encoded(words)
        n = self.words
        while len(self.size) < n + len(words):
            self.size, self.at = np.resize(self.size, 2 * len(self.size)), np.resize(self.at, 2 * len(self.at))
        while len(self.pool) < self.used + len(flat):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used:self.used + len(flat)] = flat
        self.size[n:n + len(words)] = size
        self.at[n:n + len(words)] = self.used + start
        self.table.add(hashes, np.arange(n, n + len(words)))
        self.used += len(flat)
        self.words += len(words)

    def ids(self, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a run of texts: all ids with each text's end id, ids of each text, places after a sentence end."""
        raw = data.tobytes()
        special = b"<|" in raw                            # special tokens are told by case
        w = Words(off, data, RAW_WORDS if special else SPACE_WORDS, word_breaks(data))
        hashes = w.hash ^ np.uint64(0xA5A5A5A5A5A5A5A5) if special else w.hash
        uniq, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        slot = self.table.find(uniq)
        new = np.flatnonzero(slot < 0)
        if self.words + len(new) > CACHED_WORDS:
            if self.words:
                self.clear()
            if len(uniq) > CACHED_WORDS:                  # one very long text: a table of its own
                self.table = HashTable((2 * len(uniq)).bit_length())
            new = np.arange(len(uniq))
        if len(new):
            at = first[new]
            self.add(uniq[new], [raw[s:e].decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist())])
            slot = self.table.find(uniq)
        slot = slot[which]
        rows = len(off) - 1
        # one more "word" at the end of each text: its end id
        sizes = np.insert(self.size[slot].astype(np.int64), w.first[1:], 1)
        starts = np.insert(self.at[slot], w.first[1:], -1)
        ends = w.first[1:] + np.arange(rows)
        till = np.cumsum(sizes)
        at = np.arange(till[-1] if len(till) else 0) + np.repeat(starts - (till - sizes), sizes)
        out = self.pool[at]
        out[till[ends] - 1] = END_ID
        last = np.isin(data[w.end - 1], [33, 46, 63])     # . ! ? before white space or the end
        last &= (w.end == off[1:][w.row]) | (SPACE_WORDS[data[np.minimum(w.end, len(data) - 1)]] == 0)
        stop = np.insert(last, w.first[1:], False)
        return out, np.diff(np.concatenate([[0], till[ends]])), till[stop & (sizes > 0)]


def candidates(n: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[list[int], list[float]]:
    """Rising places (0 excluded) where the stream may be cut, and their costs; n is the last."""
    s = np.sort(sentence_ends)
    s = s[np.append(s[1:] // GRID != s[:-1] // GRID, True)] if len(s) else s
    soft = np.unique(np.concatenate([[0], s, doc_ends, [n]])).astype(np.int64)
    wide = np.flatnonzero(np.diff(soft) > STRIDE)
    hard = [np.arange(soft[k] + STRIDE, soft[k + 1], STRIDE) for k in wide]
    place = np.concatenate([soft[1:], *hard])
    cost = np.full(len(place), COSTS[2])
    cost[:len(soft) - 1] = COSTS[1]
    cost[np.isin(place, doc_ends)] = COSTS[0]
    order = np.argsort(place, kind="stable")
    return place[order].tolist(), cost[order].tolist()


def cuts(place: list[int], cost: list[float], size: int = SIZE) -> list[int]:
    """The cheapest cuts of a stream whose last place must be one; the last window costs no padding."""
    best, came = [0.0] * (len(place) + 1), [0] * (len(place) + 1)
    at = [0, *place]
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])   # best + place, rising; index
    for j in range(1, len(at)):
        least = at[j] - size
        while at[queue[0][1]] < least:
            queue.popleft()
        value, came[j] = queue[0]
        best[j] = value + size - at[j] + cost[j - 1]
        key = best[j] + at[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], len(at) - 1
    came[j] = min((i for i in range(bisect_left(at, at[j] - size), j)), key=best.__getitem__, default=0)
    while j:
        out.append(at[j])
        j = came[j]
    return out[::-1]


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])


class Stream:
    """One range's tokens: pieces go out once their windows are settled."""

    def __init__(self, first_sequence: int, size: int):
        self.sequence, self.size = first_sequence, size
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[list] = []                        # id, tokens, tokens that went out before
        self.parts: list[np.ndarray] = []
        self.stops: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: list, ids: np.ndarray, counts: np.ndarray, stops: np.ndarray) -> None:
        self.stops.append(stops + self.held)
        self.parts.append(ids)
        self.held += len(ids)
        self.docs += [[k, c, 0] for k, c in zip(keys, counts.tolist())]

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        ids, stops = np.concatenate(self.parts), np.concatenate(self.stops)
        left = np.array([c - gone for _, c, gone in self.docs], np.int64)
        place, cost = candidates(len(ids), np.cumsum(left), stops)
        at = cuts(place, cost, self.size)
        if last and at[-1] - (at[-2] if len(at) > 1 else 0) < self.size:
            rest = at[-1] - (at[-2] if len(at) > 1 else 0)
            at = at[:-1] + (at[-1] - rest + np.cumsum(powers_of_two(rest))).tolist()
        elif not last:
            at = at[:-1]                                  # the last window goes on with what follows
        out, k, done = [], 0, 0
        for end in at:
            offset = 0
            while done < end:
                doc = self.docs[k]
                take = min(end - done, doc[1] - doc[2])
                piece = ids[done:done + take]
                out.append((doc[0], doc[2], take, zlib.crc32(piece.astype("<u4").tobytes()), doc[1], self.sequence, offset, piece))
                doc[2] += take
                done += take
                offset += take
                k += doc[2] == doc[1]
            self.sequence += 1
        self.docs = self.docs[k:]
        self.parts, self.stops, self.held = [ids[done:]], [stops[stops > done] - done], len(ids) - done
        if out:
            columns = list(zip(*out))
            lengths = np.cumsum([0, *columns[2]])
            flat = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(ids[:done].astype(np.int32)))
            yield batch_of(SCHEMA, [*columns[:7], flat])


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ``ids``.

    Texts are shuffled once, by ranges of ids and, within an id, of text hashes; a task holds ``STREAM`` tokens and one batch.
    """
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stream = None, None
        for b in batches:
            for lo, hi, off, data in pieces(b.column(1), 1 << 19):
                if words is None:
                    words = WordIds.of(path)
                    stream = Stream(b.column(2)[0].as_py() << 40, size)
                stream.add(b.column(0).slice(lo, hi - lo).to_pylist(), *words.ids(off, data))
                if stream.held >= STREAM:
                    yield from stream.flush(False)
        if stream:
            yield from stream.flush(True)

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    order = F.asc_nulls_last("doc_id"), F.xxhash64("text").asc()
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order, F.asc("text"))\
        .withColumn("part", F.spark_partition_id())
    return ranged.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                                  "offset long, ids array<int>")
