"""Language identification by interpolated Kneser-Ney character models.

One model per language, of order 4 over symbols: lower-cased letters, and one
space for each run of other characters.  Counting runs in Spark over a bounded
sample of labelled rows; each order is stored as a sorted array of n-gram hashes
with one column of log-probabilities per language.  The language with the
lowest cross-entropy per symbol wins; a text is rejected if even that one is
above the language's calibrated limit.

The sample: per language the rows with the smallest hash of their id (or text), at most
``rows`` of them, whole texts while they hold no more than ``symbols``
characters together (the first one always).  A fifth of them is left out of the
counts and calibrates the limit: the mean cross-entropy plus ``z`` standard
deviations, wider for texts shorter than usual, or three quarters of the way to that
of the nearest other language's texts (or of evenly drawn symbols), if that is
more; texts that mix known languages stay below it.

Cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected; without labelled rows every text is ``und``; equal cross-entropies go
to the first language by name; rows with null labels are not learned from;
whole texts are read; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickframe.llm.blocks import batch_of, mix, pieces

ORDER = 4
#: bytes of text scored at once: their hashes, places and log-probabilities take some hundred times as much memory
PIECE = 1 << 17
SAMPLE_ROWS, SAMPLE_CHARS = 400, 1_500_000
#: texts of more than this part of the characters are sampled last
LONG = 25
SPACE = 32
#: columns that identify() adds; input columns of these names are replaced
RESULT = ("lang_pred", "score", "entropy", "rejected")
_SYMBOLS: np.ndarray | None = None


def symbol_table() -> np.ndarray:
    """Symbol of each code point: its lower-case letter, or SPACE."""
    global _SYMBOLS
    if _SYMBOLS is None:
        t = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _SYMBOLS = t
    return _SYMBOLS


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte each one starts at."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return points, np.flatnonzero((data & 0xC0) != 0x80)


def symbols(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a run of texts: ORDER - 1 spaces before each text, then its symbols with
    runs of spaces made one; the text of each symbol; whether it is scored (not one of those before)."""
    points, at = code_points(data)
    row = np.searchsorted(off, at[:len(points)], side="right") - 1
    s = symbol_table()[points]
    keep = np.ones(len(s), bool)
    if len(s) > 1:
        keep[1:] = (s[1:] != SPACE) | (s[:-1] != SPACE) | (row[1:] != row[:-1])
    s, row = s[keep], row[keep]
    n, pad = len(off) - 1, ORDER - 1
    place = np.arange(len(s)) + pad * (row + 1)
    out = np.full(len(s) + pad * n, SPACE, np.uint32)
    out[place] = s
    scored = np.zeros(len(out), bool)
    scored[place] = True
    rows = np.zeros(len(out), np.int64)
    rows[place] = row
    return out, rows, scored


def grams(s: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols that end at each place (of the first ones: with what precedes the run)."""
    h = np.full(len(s), k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k - 1, -1, -1):
            shifted = np.full(len(s), SPACE, np.uint64)
            shifted[j:] = s[:len(s) - j]
            h = h * np.uint64(0x9E3779B97F4A7C15) + shifted
    return mix(h)


# ------------------------------------------------------------------ training
def labelled_sample(docs: DataFrame, rows: int, chars: int) -> DataFrame:
    """(label, text, fit): the bounded sample described above, from (label, id, text, pick).

    The limit of ``pick`` per label comes from narrow rows, first within 64 parts
    of a label, so that no task sees a whole label; texts follow once it is known.
    """
    def first(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("pick"))).filter(F.col("_n") <= rows).drop("_n")

    narrow = docs.select("label", "pick", F.pmod("pick", F.lit(64)).alias("part"))
    limit = first(first(narrow, "label", "part"), "label").groupBy("label").agg(F.max("pick").alias("limit"))
    # texts that would take more than a share of the budget come last, so that they push out no other and a fifth can be held out
    order = Window.partitionBy("label").orderBy(F.length("text") > chars // LONG, "pick", "id", "text")
    limits = [x for r in limit.collect() for x in (F.lit(r["label"]), F.lit(r["limit"]))]       # one for each label
    within = F.col("pick") <= F.element_at(F.create_map(*limits), F.col("label")) if limits else F.lit(False)
    few = docs.filter(within).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows)
    size = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return few.withColumn("held", size).filter((F.col("held") <= chars) | (F.col("nth") == 1)) \
        .withColumn("fit", (F.col("nth") % 5 != 0)).select("label", "text", "fit", "pick")


def gram_counts(sample: DataFrame) -> DataFrame:
    """(label, k, gram, context, rest, n): k-grams with the hashes of their first and last k - 1 symbols."""
    schema = pa.schema([("label", pa.string()), ("k", pa.int32()), ("gram", pa.int64()), ("context", pa.int64()),
                        ("rest", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = b.column(0).to_pylist()
            for lo, hi, off, data in pieces(b.column(1), PIECE):
                s, row, scored = symbols(off, data)
                names, code = np.unique(np.array(labels[lo:hi], object).astype(str), return_inverse=True)
                own = code[row]
                for k in range(1, ORDER + 1):
                    g, r = grams(s, k), grams(s, k - 1)
                    c = np.roll(r, 1)                     # the k - 1 symbols before the last
                    for j, name in enumerate(names):
                        at = np.flatnonzero(scored & (own == j))
                        u, first, n = np.unique(g[at], return_index=True, return_counts=True)
                        at = at[first]
                        yield batch_of(schema, [[str(name)] * len(u), np.full(len(u), k), u.view(np.int64), c[at].view(np.int64), r[at].view(np.int64), n])

    raw = sample.select("label", "text").mapInArrow(count, "label string, k int, gram long, context long, rest long, n long")
    return raw.groupBy("label", "k", "gram", "context", "rest").agg(F.sum("n").alias("n"))


@dataclass
class Order:
    """One order: sorted n-gram hashes with log-probabilities, sorted contexts with log back-off weights."""
    gram: np.ndarray
    logp: np.ndarray
    context: np.ndarray
    weight: np.ndarray


@dataclass
class Model:
    languages: list[str]
    orders: list[Order]
    floor: np.ndarray                                     # log-probability of a symbol no model knows
    limit: np.ndarray                                     # languages x (mean, deviation, symbols of a usual text, three quarters of the way to other text)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted hash in a sorted array, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _fit(table, languages: list[str]) -> Model:
    """Interpolated Kneser-Ney: raw counts at the top, numbers of distinct left neighbours below."""
    size = len(languages)
    code = {x: j for j, x in enumerate(languages)}
    table = table.assign(l=table["label"].map(code))
    level = {k: table[table["k"] == k] for k in range(1, ORDER + 1)}
    alphabet = len(np.unique(level[1]["gram"])) + 1
    floor = np.full(size, -np.log(alphabet))
    orders: list[Order] = []
    lower = None
    for k in range(1, ORDER + 1):
        t = level[k][["l", "gram", "context", "rest", "n"]].copy()
        if k < ORDER:                                     # continuation counts from the order above
            up = level[k + 1].groupby(["l", "rest"]).size().rename("n")
            t = t.drop(columns="n").merge(up, left_on=["l", "gram"], right_index=True)
        gram = np.unique(t["gram"].to_numpy().view(np.uint64))
        context = np.unique(t["context"].to_numpy().view(np.uint64))
        g, c, l = np.searchsorted(gram, t["gram"].to_numpy().view(np.uint64)), np.searchsorted(context, t["context"].to_numpy().view(np.uint64)), t["l"].to_numpy()
        n = t["n"].to_numpy().astype(float)
        total, kinds = np.zeros((len(context), size)), np.zeros((len(context), size))
        np.add.at(total, (c, l), n)
        np.add.at(kinds, (c, l), 1.0)
        n1 = np.bincount(l, n == 1, size)
        n2 = np.bincount(l, n == 2, size)
        discount = np.where(n1 > 0, n1 / np.maximum(n1 + 2 * n2, 1), 0.5)
        seen = total > 0
        weight = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
        # each n-gram known to any language gets a probability in all of them
        of_gram = np.zeros(len(gram), np.int64)
        of_gram[g] = c
        if lower is None:
            base = np.tile(np.exp(floor), (len(gram), 1))
        else:
            rest = np.zeros(len(gram), np.uint64)
            rest[g] = t["rest"].to_numpy().view(np.uint64)
            base = lower.at_hash(rest)
        p = weight[of_gram] * base
        np.add.at(p, (g, l), np.maximum(n - discount[l], 0) / total[c, l])
        order = Order(gram, np.log(p).astype(np.float32), context, np.log(weight).astype(np.float32))
        orders.append(order)
        lower = _Lower(order)
    return Model(languages, orders, floor, np.zeros((size, 4)))


class _Lower:
    def __init__(self, order: Order):
        self.order = order

    def at_hash(self, hashes: np.ndarray) -> np.ndarray:
        at = find(self.order.gram, hashes)
        return np.exp(self.order.logp[at].astype(float))  # each rest is a known n-gram of the order below


def log_probs(model: Model, s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log-probability of the symbols at ``at`` in each language."""
    out = np.zeros((len(at), len(model.languages)), np.float32)
    open_ = np.arange(len(at))
    for k in range(ORDER, 0, -1):
        order = model.orders[k - 1]
        hit = find(order.gram, grams(s, k)[at[open_]])
        known = hit >= 0
        out[open_[known]] += order.logp[hit[known]]
        open_ = open_[~known]
        if not len(open_):
            return out
        ctx = find(order.context, np.roll(grams(s, k - 1), 1)[at[open_]])
        has = ctx >= 0
        out[open_[has]] += order.weight[ctx[has]]
    out[open_] += model.floor.astype(np.float32)
    return out


def entropies(model: Model, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text of a run: cross-entropy per symbol in each language, scored symbols, letters."""
    s, row, scored = symbols(off, data)
    at = np.flatnonzero(scored)
    n = len(off) - 1
    lp = log_probs(model, s, at)
    many = np.bincount(row[at], minlength=n)
    total = np.stack([np.bincount(row[at], lp[:, j], n) for j in range(lp.shape[1])], axis=1)
    letters = np.bincount(row[at], s[at] != SPACE, n)
    return -total / np.maximum(many, 1)[:, None], many, letters


def scored(model: Model, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``entropies`` of runs of the texts, in order."""
    for _, _, off, data in pieces(texts, PIECE):
        yield entropies(model, off, data)


def train(docs: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model | None:
    """A model of the labelled rows; None without any.  What reaches the driver is bounded by the sample."""
    labelled = docs.select(F.col(label_col).cast("string").alias("label"), F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .filter("label is not null and text is not null")\
        .withColumn("pick", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id")))
    sample = labelled_sample(labelled, rows, chars).persist()
    try:
        counts = gram_counts(sample.filter("fit")).toPandas()
        if not len(counts):
            return None
        languages = sorted(counts["label"].unique())
        model = _fit(counts, languages)
        held = sample.filter("not fit").select("label", "text").orderBy("label", "pick").toPandas()
    finally:
        sample.unpersist()
    own: list[np.ndarray] = []
    cross = np.full((len(languages), len(languages)), np.nan)           # texts of a language under each model
    for j, name in enumerate(languages):
        texts = pa.array(held["text"][held["label"] == name].tolist(), pa.string())
        runs = [(e[letters > 0], m[letters > 0]) for e, m, letters in scored(model, texts)]
        ce = np.concatenate([e for e, _ in runs]) if runs else np.zeros((0, len(languages)))
        own.append(np.concatenate([m for _, m in runs]) if runs else np.zeros(0))
        if len(ce) >= 5:
            cross[j] = ce.mean(axis=0)
            model.limit[j, :3] = cross[j, j], max(ce[:, j].std(), 0.05), np.median(own[j])
        else:
            model.limit[j, :3] = -model.floor[j], 0.3, 200
    for j in range(len(languages)):
        foreign = np.append(np.delete(cross[:, j], j), -model.floor[j])
        model.limit[j, 3] = 0.25 * model.limit[j, 0] + 0.75 * np.nanmin(foreign)
    return model


# ------------------------------------------------------------------ prediction
def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", z: float = 8.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``entropy`` per symbol and ``rejected``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)          # bounded by the sample

    def classify(column: pa.Array) -> list[np.ndarray | list]:
        m = shared.value
        if m is None:
            n = len(column)
            return [["und"] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)]
        pred, score, entropy, rejected = [], [], [], []
        for ce, many, letters in scored(m, column):
            n = len(many)
            best = ce.argmin(axis=1)
            low = ce[np.arange(n), best]
            weight = np.exp(-(ce - low[:, None]) * np.minimum(many, 50)[:, None])
            mean, deviation, usual, middle = m.limit[best].T
            top = np.maximum(middle, mean + z * deviation * np.sqrt(np.maximum(1, usual / np.maximum(many, 1))))
            none = letters == 0
            pred += [m.languages[b] if not x else "und" for b, x in zip(best.tolist(), none.tolist())]
            score.append(np.where(none, 0.0, 1 / weight.sum(axis=1)))
            entropy.append(np.where(none, np.nan, low))
            rejected.append(none | (low > top))
        return [pred, *(np.concatenate(x) if x else np.zeros(0) for x in (score, entropy, rejected))]

    # Arrow in and out: a batch of texts is never copied into Python strings
    @F.arrow_udf("lang_pred string, score double, entropy double, rejected boolean")
    def predict(text: pa.Array) -> pa.Array:
        types = pa.string(), pa.float64(), pa.float64(), pa.bool_()
        return pa.StructArray.from_arrays([pa.array(x, t, from_pandas=True) for x, t in zip(classify(text), types)], list(RESULT))

    kept = [f"`{c}`" for c in docs.columns if c not in RESULT]
    return docs.withColumn("_language", predict(F.col(text_col).cast("string"))).select(*kept, "_language.*")
