"""Filter interaction audit as an incremental stream with retractions.

Five filters look at whole texts (:data:`FILTERS`).  What each of them removes
depends on which ran before, so the audit wants, per part of the corpus, how many
documents fail each combination of filters.  Four filters need the text alone;
the fifth (a text that a smaller id has, too) needs all documents.

The files are read as available-now micro-batches of a stream.  Keyed state holds
for each text (by a 128-bit hash) the least id so far and what its rows count as.
A row with a larger id than that fails the fifth filter; when a smaller id
arrives, the rows that passed until then are retracted from the counters and
counted as failures.  So the counters are right after every micro-batch, and a
later run over new files goes on from the state.  The stream's output is a log of
signed counts, whose sum per (part, combination) is the table of counters; from
that small table all orders of the filters follow.

Texts never move: a task turns each into (id, part, hash, mask).  Rows of one text
are combined per Arrow batch before the shuffle, so a text that a third of all
rows share costs a row per batch; labels are joined salted, sorted and never
broadcast.  Texts are dealt into groups of about ``group_texts`` that share one
call and one state value.  State
lives in the session's state store, written to ``spark.checkpoint.dir`` after each
micro-batch; for state beyond the executors' memory set the RocksDB provider in
``spark.sql.streaming.stateStore.providerClass``.

Cases: a null text is empty; a null language is the part ''; rows with a null id
have no label, are no smaller id to others and have none; repeated rows of one id
don't fail the fifth filter through each other; of several labels of one id any
that is 1 counts; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickframe.llm.blocks import RAW_WORDS, Words, batch_of, pieces, shared_folder, written

#: under 100 words; distinct words under 80 %; upper case over 10 %; any of the signs; the text of a smaller id
FILTERS = "ABCDE"
SIGNS = b"#$%&*|"
GOOD, TOXIC = 32, 64                                      # bits of a mark beside the filters' five
SALTS = 16

_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS)] = True


def masks(off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Bits of the first four filters that each text fails."""
    def per_row(hit: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(hit))
        return total[off[1:]] - total[off[:-1]]

    w = Words(off, data, RAW_WORDS)
    words = np.diff(w.first)
    order = np.lexsort((w.hash, w.row))
    row, word = w.row[order], w.hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1])
    distinct = np.bincount(row[new], minlength=len(words))
    upper, points = per_row((data >= 65) & (data <= 90)), per_row((data & 0xC0) != 0x80)
    return (words < 100) + 2 * (100 * distinct < 80 * words) + 4 * (100 * upper > 10 * points) + 8 * (per_row(_SIGN[data]) > 0)


def masked(texts: DataFrame) -> DataFrame:
    """(doc_id, part, hash, mask) of (doc_id, part, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("hash", pa.binary()), ("mask", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, off, data in pieces(b.column(2)):
                raw, at = memoryview(data), off.tolist()
                hashes = [xxhash.xxh3_128_digest(raw[x:y]) for x, y in zip(at[:-1], at[1:])]
                yield batch_of(schema, [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), hashes, masks(off, data)])

    return texts.select("doc_id", "part", "text").mapInArrow(run, "doc_id long, part string, hash binary, mask int")


def combined(rows: DataFrame) -> DataFrame:
    """Rows of one (hash, part, mark) as one per Arrow batch: how many, without an id, the least id and how many have it."""
    schema = pa.schema([("grp", pa.int64()), ("hash", pa.binary()), ("part", pa.string()), ("mark", pa.int32()),
                        ("n", pa.int64()), ("none", pa.int64()), ("least", pa.int64()), ("at_least", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple, list] = {}
            for i, *key in zip(*(b.column(j).to_pylist() for j in range(5))):
                x = seen.setdefault(tuple(key), [0, 0, None, 0])
                x[0] += 1
                if i is None:
                    x[1] += 1
                elif x[2] is None or i < x[2]:
                    x[2:] = i, 1
                else:
                    x[3] += i == x[2]
            if seen:
                yield batch_of(schema, [*zip(*seen), *zip(*seen.values())])

    return rows.select("doc_id", "grp", "hash", "part", "mark").mapInArrow(
        run, "grp long, hash binary, part string, mark int, n long, none long, least long, at_least long")


# ------------------------------------------------------------------ state of a group of texts
STATE = "hashes binary, least binary, parts array<string>, entries binary"
#: hash -> [least id, {(part, mark): rows that have it}]
Texts = dict[bytes, list]


def unpacked(value: tuple) -> Texts:
    hashes, least, parts, entries = value
    names = [bytes(hashes[k:k + 16]) for k in range(0, len(hashes), 16)]
    out = {h: [i, {}] for h, i in zip(names, np.frombuffer(least, np.int64).tolist())}
    for text, part, mark, n in np.frombuffer(entries, np.int64).reshape(-1, 4).tolist():
        out[names[text]][1][parts[part], mark] = n
    return out


def packed(texts: Texts) -> tuple:
    parts = sorted({p for _, rows in texts.values() for p, _ in rows})
    place = {p: k for k, p in enumerate(parts)}
    entries = [(k, place[p], mark, n) for k, (_, rows) in enumerate(texts.values()) for (p, mark), n in rows.items()]
    return (b"".join(texts), np.array([i for i, _ in texts.values()], np.int64).tobytes(), parts, np.array(entries, np.int64).tobytes())


def arrive(texts: Texts, rows: Iterator[tuple]) -> Counter:
    """Takes combined rows into the state; returns the change of each counter (part, mark, fails the fifth filter)."""
    change: Counter = Counter()
    for h, part, mark, n, none, least, at_least in rows:
        change[part, mark, 0] += none
        if n == none:
            continue
        held = texts.get(h)
        if held is None:
            held = texts[h] = [least, {}]
        elif least < held[0]:
            for (p, m), earlier in held[1].items():       # they are no longer the least
                change[p, m, 0] -= earlier
                change[p, m, 1] += earlier
            held[:] = least, {}
        first = at_least if least == held[0] else 0
        if first:
            held[1][part, mark] = held[1].get((part, mark), 0) + first
            change[part, mark, 0] += first
        change[part, mark, 1] += n - none - first
    return change


def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    texts = unpacked(state.get) if state.exists else {}
    change: Counter = Counter()
    for f in frames:
        least = [None if x is None or x != x else int(x) for x in f["least"].astype(object)]
        change.update(arrive(texts, zip(map(bytes, f["hash"]), f["part"], f["mark"].tolist(), f["n"].tolist(), f["none"].tolist(),
                                        least, f["at_least"].tolist())))
    state.update(packed(texts))
    rows = [(*k, n) for k, n in change.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mark", "late", "n"])


# ------------------------------------------------------------------ the stream and its counters
def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``mark``: the mask and the labels.  An id with many rows (or none) is dealt by its texts' hashes."""
    def one(c: str):
        return F.max(F.when(F.col(c) == 1, 1).otherwise(0))

    ids = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(one("quality").alias("good"), one("toxic").alias("toxic")) \
        .filter("good = 1 or toxic = 1")
    ids = written(ids).withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("hash"), F.lit(SALTS)).cast("int")
    salt = F.when(F.col("doc_id").isNull(), salt + SALTS * (1 + F.pmod(F.xxhash64("hash", F.lit(1)), F.lit(1024)).cast("int"))).otherwise(salt)
    out = rows.withColumn("salt", salt)
    mark = F.expr(f"mask + if(good = 1, {GOOD}, 0) + if(toxic = 1, {TOXIC}, 0)")
    # not broadcast: Spark would go by the size of the file, which has each id once, not SALTS times
    return out.join(ids.hint("merge"), (out["doc_id"] == ids["id"]) & (out["salt"] == ids["at"]), "left").select("doc_id", "part", "hash", mark.alias("mark"))


def counter_log(spark: SparkSession, path: str, labels: DataFrame, folder: str, batches: int = 4, group_texts: int = 256) -> DataFrame:
    """(part, mark, late, n): the signed counts of all micro-batches so far, kept in ``folder``.

    The files of ``path`` are read in about ``batches`` micro-batches.  Called again with the
    same folder, it reads the files that came since and goes on from the state.
    """
    whole = spark.read.parquet(path)
    files = len(whole.inputFiles())
    groups = max(1, math.ceil(whole.count() / group_texts))
    key = f"{folder}/groups"
    groups = _kept(spark, key, groups)
    # a glob: the source takes a single file only so
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", max(1, math.ceil(files / batches))) \
        .parquet(f"{path[:-1]}[{path[-1]}]")
    texts = stream.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                          F.col("text").cast("string").alias("text"))
    grp = F.pmod(F.xxhash64("hash"), F.lit(groups)).cast("long").alias("grp")
    rows = combined(labelled(masked(texts), labels).select("*", grp))
    change = rows.groupBy("grp").applyInPandasWithState(update, "part string, mark int, late int, n long", STATE, "append", GroupStateTimeout.NoTimeout)
    change.writeStream.format("parquet").option("path", f"{folder}/log").option("checkpointLocation", f"{folder}/state") \
        .trigger(availableNow=True).outputMode("append").start().awaitTermination()
    return spark.read.schema("part string, mark int, late int, n long").parquet(f"{folder}/log")


def _kept(spark: SparkSession, path: str, value: int) -> int:
    """The number written at ``path``, or ``value`` written there: the groups of a state never change."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema("n long").parquet(path).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([(value,)], "n long").coalesce(1).write.parquet(path)
        return value


def interactions(log: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the log of signed counts."""
    mask = (F.col("mark").bitwiseAND(F.lit(15)) + 16 * F.col("late")).alias("mask")
    n = F.col("n")
    counts = log.groupBy("part", mask).agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("mark").bitwiseAND(F.lit(GOOD)) != 0, n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("mark").bitwiseAND(F.lit(TOXIC)) != 0, n).otherwise(0)).alias("bad"))
    orders = " ".join("".join(p) for p in itertools.permutations(FILTERS))
    rows = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), " "))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5)))) \
        .withColumn("own", F.expr("shiftleft(1, ascii(substring(filter_order, step, 1)) - 65)")) \
        .withColumn("before", F.expr("aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (a, c) -> a | shiftleft(1, ascii(c) - 65))"))

    def total(condition: str, what: str = "n"):
        return F.sum(F.expr(f"if({condition}, {what}, 0L)"))

    return rows.groupBy("part", "filter_order", "step").agg(
        total("mask & (before | own) = 0").alias("kept"),
        total("mask & own <> 0 and mask & before = 0").alias("removed"),
        total("mask & own <> 0 and mask & before <> 0").alias("redundant"),
        total("mask = own").alias("unique_fails"),
        total("mask & own <> 0 and mask & before = 0", "good").alias("good_lost"),
        total("mask & own <> 0 and mask & before = 0", "bad").alias("toxic_lost"),
        # of the filters that a document fails, each comes first in as many orders
        total("mask & own <> 0", "n * (120 div bit_count(mask))").alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, batches: int = 4, group_texts: int = 256) -> DataFrame:
    """The audit of the Parquet files at ``path`` (columns doc_id, text, lang); ``folder`` keeps state and log for later runs."""
    folder = folder or f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    return interactions(counter_log(spark, path, labels, folder, batches, group_texts))
