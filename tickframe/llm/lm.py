"""N-gram scoring: an interpolated modified Kneser-Ney model of word pairs.

Counting is packed: a task counts the hashes of its tokens in numpy and sends,
per hash range, one row with a sorted array of hashes and their counts.  Spark
deals the rows by range, and one task per range merges them and writes the
range's sorted arrays into the shared folder.  Three passes do this, for tokens,
for pairs, and for what each word's pairs add up to; their sizes all grow with
the corpus and none of them meets in one task.  Scoring tasks memory-map the
arrays and look hashes up by binary search.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end
token per text.  A pair's hash is a bijection of both token numbers, so pairs
never collide and spread evenly over the ranges whatever the hot words are.
Unknown words share the probability that the lowest order leaves to one unseen
word.  The order is two: while pairs are counted and stored, they already take
three times the input in disk.

Files are written under a temporary name and renamed, so a task that runs twice
leaves the same file.  The folder must be mounted on every worker.

Cases: a null text is empty and has only its end; without training rows every
token is unknown; repeated rows count as often as they come; further columns of
the input are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.blocks import SPACE_WORDS, Words, batch_of, mix, mounted_path, partitions, pieces, shared_folder, unmix

END_HASH = np.uint64(0x5851F42D4C957F2D)
#: distinct hashes that a task holds before it sends them on
HELD = 2_000_000
PACKED = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
PACKED_SQL = "part int, keys binary, counts binary"


# ------------------------------------------------------------------ packed counts
def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(first) else c


def least(x: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def send(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys as one row per range of their top ``bits``."""
    edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
    for part, (k, c) in enumerate(zip(np.split(keys, edges), np.split(counts, edges))):
        if len(k):
            small = least(c)
            yield batch_of(PACKED, [[part], [k.tobytes()], [small.dtype.char.encode() + small.tobytes()]])


def received(batches: Iterator[pa.RecordBatch]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    keys, counts, part = [], [], -1
    for b in batches:
        for row in range(b.num_rows):
            part = b.column(0)[row].as_py()
            raw = b.column(2)[row].as_py()
            keys.append(np.frombuffer(b.column(1)[row].as_py(), np.uint64))
            counts.append(np.frombuffer(raw, np.dtype(raw[:1].decode()), offset=1))
    return keys, counts, part


class Counter:
    """Counts of a task, sent on when more than HELD distinct keys are held."""

    def __init__(self, bits: int):
        self.bits, self.keys, self.counts, self.held = bits, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, c = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(c)
        self.held += len(k)
        if self.held > 2 * HELD:
            k, c = merged(self.keys, self.counts)
            self.keys, self.counts, self.held = [k], [c], len(k)
            if len(k) > HELD:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        k, c = merged(self.keys, self.counts)
        self.keys, self.counts, self.held = [], [], 0
        yield from send(k, c, self.bits)


def save(folder: str, name: str, x: np.ndarray) -> None:
    own = os.path.join(folder, f".{uuid.uuid4().hex}")
    with open(own, "wb") as f:
        np.save(f, np.ascontiguousarray(x))
    os.replace(own, os.path.join(folder, f"{name}.npy"))


def opened(folder: str, name: str) -> np.ndarray:
    path = os.path.join(folder, f"{name}.npy")
    return np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, np.uint64)


# ------------------------------------------------------------------ the model
@dataclass
class Model:
    folder: str
    bits: int                                             # ranges of token and of pair hashes: 2**bits
    sizes: list[int]                                      # distinct tokens of each range
    tokens: int = 0                                       # all tokens (N)
    pair_discount: list[float] = field(default_factory=lambda: [0.0] * 3)
    word_discount: list[float] = field(default_factory=lambda: [0.0] * 3)
    pairs: int = 0                                        # distinct pairs
    word_left: float = 1.0                                # probability that the lowest order leaves to unseen words

    @property
    def vocabulary(self) -> int:
        return sum(self.sizes)


class Lookup:
    """A worker's memory maps of a model."""

    _open: dict[str, "Lookup"] = {}

    def __init__(self, model: Model):
        self.model = model
        parts = range(1 << model.bits)
        self.base = np.concatenate([[0], np.cumsum(model.sizes)])
        self.hashes = [opened(model.folder, f"token-{p}") for p in parts]
        self.counts = [opened(model.folder, f"token-count-{p}") for p in parts]
        self.pairs = [opened(model.folder, f"pair-{p}") for p in parts]
        self.pair_counts = [opened(model.folder, f"pair-count-{p}") for p in parts]
        self.words = [opened(model.folder, f"word-{p}") for p in parts]

    @classmethod
    def of(cls, model: Model, state: str) -> "Lookup":
        """One set of maps per worker, model and state of its building."""
        key = f"{model.folder}:{state}"
        if key not in cls._open:
            cls._open.clear()
            cls._open[key] = cls(model)
        return cls._open[key]

    def ranges(self, sorted_hashes: np.ndarray) -> Iterator[tuple[int, slice]]:
        bits = self.model.bits
        edges = np.searchsorted(sorted_hashes, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, int)
        edges = np.concatenate([[0], edges, [len(sorted_hashes)]])
        for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            yield p, slice(edges[p], edges[p + 1])

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of sorted distinct token hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for p, s in self.ranges(hashes):
            at, hit = self._find(self.hashes[p], hashes[s])
            number[s] = np.where(hit, at + self.base[p], -1)
            count[s] = np.where(hit, self.counts[p][at] if len(self.counts[p]) else 0, 0)
        return number, count

    def pair_count(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        for p, s in self.ranges(hashes):
            at, hit = self._find(self.pairs[p], hashes[s])
            out[s] = np.where(hit, self.pair_counts[p][at] if len(self.pair_counts[p]) else 0, 0)
        return out

    def word(self, numbers: np.ndarray) -> np.ndarray:
        """Rows (pairs begun, of them distinct with count 1, 2, 3 or more, distinct pairs ended) of word numbers."""
        out = np.zeros((len(numbers), 5), np.int64)
        part = word_part(numbers, self.model)
        lows = word_lows(self.model)
        for p in np.unique(part).tolist():
            at = np.flatnonzero(part == p)
            if len(self.words[p]):
                out[at] = self.words[p][numbers[at] - lows[p]]
        return out


def word_lows(model: Model) -> np.ndarray:
    """First word number of each range; one number more than the vocabulary: the begin of a text."""
    n = model.vocabulary + 1
    return np.arange((1 << model.bits) + 1, dtype=np.int64) * n // (1 << model.bits)


def word_part(numbers: np.ndarray, model: Model) -> np.ndarray:
    return np.searchsorted(word_lows(model), numbers, side="right") - 1


def token_rows(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a run of texts, each text's end included; tokens of each text."""
    w = Words(off, data, SPACE_WORDS)
    return np.insert(w.hash, w.first[1:], END_HASH), np.diff(w.first) + 1


def pair_hashes(numbers: np.ndarray, sizes: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each token: the number before it (the begin of its text first) and the pair's hash."""
    before = np.roll(numbers, 1)
    before[np.cumsum(sizes) - sizes] = begin
    return before, mix((before.astype(np.uint64) << np.uint64(32)) | (numbers.astype(np.uint64) & np.uint64(0xFFFFFFFF)))


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [k - (k + 1) * y * nxt / now if now else 0.5 * k for k, now, nxt in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


def count_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count ``docs`` into a model in the shared folder.  The driver gets a few numbers per range."""
    spark = docs.sparkSession
    folder = os.path.join(mounted_path(shared_folder(spark)), f"lm-{uuid.uuid4().hex}")
    bits = max(0, (partitions(spark) - 1).bit_length())
    parts = 1 << bits
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    def count_tokens(batches):
        counter = Counter(bits)
        for b in batches:
            for _, _, off, data in pieces(b.column(0)):
                yield from counter.add(token_rows(off, data)[0])
        yield from counter.rest()

    def keep_tokens(batches):
        keys, counts, part = received(batches)
        if part >= 0:
            keys, counts = merged(keys, counts)
            os.makedirs(folder, exist_ok=True)
            save(folder, f"token-{part}", keys)
            save(folder, f"token-count-{part}", least(counts))
            yield batch_of(pa.schema([("part", pa.int32()), ("n", pa.int64()), ("total", pa.int64())]), [[part], [len(keys)], [int(counts.sum())]])

    got = {r["part"]: r for r in texts.mapInArrow(count_tokens, PACKED_SQL).repartitionById(parts, F.col("part"))
           .mapInArrow(keep_tokens, "part int, n long, total long").collect()}
    model = Model(folder, bits, [got[p]["n"] if p in got else 0 for p in range(parts)], sum(r["total"] for r in got.values()))
    if not model.tokens:
        return model
    if model.vocabulary >= 1 << 32:
        raise ValueError("word numbers take 32 bits; the vocabulary has more words")

    def count_pairs(batches):
        look, counter = Lookup.of(model, "tokens"), Counter(bits)
        for b in batches:
            for _, _, off, data in pieces(b.column(0)):
                hashes, sizes = token_rows(off, data)
                uniq, which = np.unique(hashes, return_inverse=True)
                yield from counter.add(pair_hashes(look.numbers(uniq)[0][which], sizes, model.vocabulary)[1])
        yield from counter.rest()

    stats_sql = "part int, numbers binary, stats binary, counts array<long>"
    stats = pa.schema([("part", pa.int32()), ("numbers", pa.binary()), ("stats", pa.binary()), ("counts", pa.list_(pa.int64()))])

    def keep_pairs(batches):
        """Writes the range's pairs; sends each word's share of them to the word's range."""
        keys, counts, part = received(batches)
        if part < 0:
            return
        keys, counts = merged(keys, counts)
        save(folder, f"pair-{part}", keys)
        save(folder, f"pair-count-{part}", least(counts))
        code = unmix(keys)
        begun, ended = (code >> np.uint64(32)).astype(np.int64), (code & np.uint64(0xFFFFFFFF)).astype(np.int64)
        numbers = np.unique(np.concatenate([begun, ended]))
        rows = np.zeros((len(numbers), 5), np.int64)
        at = np.searchsorted(numbers, begun)
        rows[:, 0] = np.bincount(at, counts, len(numbers))
        for k, of in ((1, counts == 1), (2, counts == 2), (3, counts >= 3)):
            rows[:, k] = np.bincount(at[of], minlength=len(numbers))
        rows[:, 4] = np.bincount(np.searchsorted(numbers, ended), minlength=len(numbers))
        own = word_part(numbers, model)
        note = [*count_of_counts(counts), len(keys)]
        for p in np.unique(own).tolist():
            of = own == p
            wide = rows[of].astype(np.min_scalar_type(int(rows[of].max())))      # a frequent word begins more than 2**32 pairs
            yield batch_of(stats, [[p], [numbers[of].astype("<u4").tobytes()], [wide.dtype.char.encode() + wide.tobytes()], [note]])
            note = [0] * 5

    def keep_words(batches):
        part, numbers, rows, note = -1, [], [], np.zeros(5, np.int64)
        lows = word_lows(model)
        for b in batches:
            for r in range(b.num_rows):
                part = b.column(0)[r].as_py()
                numbers.append(np.frombuffer(b.column(1)[r].as_py(), "<u4"))
                raw = b.column(2)[r].as_py()
                rows.append(np.frombuffer(raw, np.dtype(raw[:1].decode()), offset=1).reshape(-1, 5))
                note += np.array(b.column(3)[r].as_py())
        if part < 0:
            return
        out = np.zeros((lows[part + 1] - lows[part], 5), np.int64)
        for n, x in zip(numbers, rows):
            out[n.astype(np.int64) - lows[part]] += x.astype(np.int64)     # a row's numbers are distinct
        save(folder, f"word-{part}", out)
        yield batch_of(pa.schema([("c", pa.list_(pa.int64())), ("w", pa.list_(pa.int64()))]),
                       [[note.tolist()], [[*count_of_counts(out[:, 4]), int((out[:, 4] >= 3).sum()), int(out[:, 4].sum())]]])

    ended = texts.mapInArrow(count_pairs, PACKED_SQL).repartitionById(parts, F.col("part")).mapInArrow(keep_pairs, stats_sql) \
        .repartitionById(parts, F.col("part")).mapInArrow(keep_words, "c array<long>, w array<long>").collect()
    pair, word = (np.array([r[k] for r in ended]).sum(axis=0).tolist() for k in ("c", "w"))
    model.pairs = pair[4]
    model.pair_discount = discounts(pair[:4])
    d = model.word_discount = discounts(word[:4])
    model.word_left = (d[0] * word[0] + d[1] * word[1] + d[2] * word[4]) / word[5]
    return model


def _discounted(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return counts - np.array([0.0, *d])[np.minimum(counts, 3)]


def score_tokens(model: Model, look: Lookup | None, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: training count, log10 of its smoothed share, log10 of its probability in the model."""
    v, n = model.vocabulary, model.tokens
    floor = np.log10(0.5) - np.log10(n + 0.5 * (v + 1))
    if look is None:
        return np.zeros(len(hashes), np.int64), np.full(len(hashes), floor), np.full(len(hashes), -np.log10(v + 1.0))
    uniq, which = np.unique(hashes, return_inverse=True)
    number, count = look.numbers(uniq)
    base = np.log10(count + 0.5) - np.log10(n + 0.5 * (v + 1))
    known = number >= 0
    words = np.zeros((len(uniq), 5), np.int64)
    words[known] = look.word(number[known])
    low = _discounted(words[:, 4], model.word_discount) / max(model.pairs, 1) + model.word_left / (v + 1)
    own = number[which]
    before, pair = pair_hashes(own, sizes, v)
    # what each token stands after: the row of its number, or of the begin of a text
    first = np.cumsum(sizes) - sizes
    after = np.roll(which, 1)
    rows = words[after]
    rows[first] = look.word(np.array([v]))[0]
    pairs, back = np.unique(pair, return_inverse=True)
    c = np.where((own >= 0) & (before >= 0), look.pair_count(pairs)[back], 0)
    begun = rows[:, 0]
    d = model.pair_discount
    total = np.maximum(begun, 1)
    left = np.where(begun > 0, (d[0] * rows[:, 1] + d[1] * rows[:, 2] + d[2] * rows[:, 3]) / total, 1.0)
    p = np.where(begun > 0, _discounted(c, d) / total, 0.0) + left * low[which]
    return count[which], base[which], np.log10(p)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_tokens, n_known, train_tokens, base_score, score (log10) and perplexity."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup.of(model, "whole") if model.tokens else None
        for b in batches:
            for lo, hi, off, data in pieces(b.column(1)):
                hashes, sizes = token_rows(off, data)
                count, base, own = score_tokens(model, look, hashes, sizes)
                first = np.cumsum(sizes) - sizes
                total = np.add.reduceat(own, first)
                yield batch_of(schema, [b.column(0).slice(lo, hi - lo), sizes, np.add.reduceat((count > 0).astype(np.int64), first),
                                        np.full(hi - lo, model.tokens), np.add.reduceat(base, first), total, 10 ** np.minimum(-total / sizes, 300)])

    return docs.selectExpr(f"cast(`{id_col}` as long) as id", f"cast(`{text_col}` as string) as text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
