"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

Runs on DataFrame functions alone.  Matches are located by splitting a text at
its matches: the lengths of pieces and matches add up to their positions.

The method's part: runs of 16 or more letters, digits and ``+/_=-`` that no
pattern covers are scored by the log-likelihood ratio of two first-order
character models, one of random strings and one of ordinary identifiers.  Both
are counted by Spark from labelled samples; a run counts as a secret if the
ratio is at least ``ln(1e6)``, the odds against a secret.

The labelled samples come from a bounded set of documents (the ``sample`` ones
with the smallest hash of their id): random strings are the values their
patterns match and digests of their ids in three alphabets; identifiers are
their words, plain, upper-cased, and joined in snake and camel case.

Cases: a null text is empty; empty tables and samples work (the models are then
flat and add nothing); spans of one kind never overlap, spans of two kinds may;
added spans never overlap base ones; texts of any length are read whole; repeated
rows give repeated results; further columns of the input are ignored by ``scan``
and kept by ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tickframe.llm.arrays import with_running
from tickframe.llm.blocks import boxed, unboxed

#: The base patterns (a value of 12, 18 and 16 or more characters counts).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
RUN = r"[A-Za-z0-9+/_=-]{16,}"
SAMPLE_DOCS = 500
ODDS = math.log(1e6)
_SPAN = "array<struct<start: long, end: long, kind: int>>"


def _matches(df: DataFrame, pattern: str, out: str, keep: Column | None = None, group: int | None = None) -> DataFrame:
    """Column ``out``: the spans of a pattern's matches, and ``{out}_value`` their texts (of ``group``)."""
    some = F.col("_text").rlike(pattern)
    none = F.array().cast("array<string>")

    def all_of(g: int) -> Column:
        return F.when(some, F.regexp_extract_all("_text", F.lit(pattern), F.lit(g))).otherwise(none)

    df = df.withColumn("_m", all_of(0)).withColumn("_v", all_of(group) if group else F.col("_m"))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split("_text", pattern, -1)).otherwise(none))
    # before a match: the pieces up to it and the matches before it
    steps = F.transform("_m", lambda m, i: (F.length(m) + F.length(F.element_at("_p", i + 1))).cast("long"))
    df = with_running(df.withColumn("_n", steps), "_n", "_r")
    spans = F.transform("_m", lambda m, i: F.struct(
        (F.element_at("_r", i + 1) + F.length(F.element_at("_p", i + 1))).alias("start"),
        (F.element_at("_r", i + 1) + F.element_at("_n", i + 1)).alias("end"), F.element_at("_v", i + 1).alias("value")))
    return df.withColumn(out, F.filter(spans, keep) if keep is not None else spans).drop("_m", "_v", "_p", "_n", "_r")


def _base(df: DataFrame) -> DataFrame:
    df = _matches(df, ASSIGN, "_assign", lambda s: F.length(s["value"]) >= 12, group=2)
    df = _matches(df, ACCESS, "_access")
    return _matches(df, HEX, "_hex")


def _kind(column: str, kind: int) -> Column:
    return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


# ------------------------------------------------------------------ the models
def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS) -> DataFrame:
    """(value, random): labelled strings from at most ``sample`` documents."""
    picked = docs.select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    few = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(picked, "id", "left_semi")
    found = _base(few)
    values = found.select(F.explode(F.concat("_assign", "_access", "_hex")).alias("s")).select("s.value").filter(F.length("value") >= 12)
    digest = F.sha2(F.col("id").cast("string"), 256)
    digests = picked.select(F.explode(F.array(F.base64(F.unhex(digest)), digest, F.upper(F.base64(F.unhex(F.reverse(digest)))))).alias("value"))
    words = found.select(F.expr(r"regexp_extract_all(_text, '(?<![A-Za-z0-9+/_=-])([A-Za-z]{3,})(?![A-Za-z0-9+/_=-])', 1)").alias("w"))
    pairs = words.select(F.explode(F.transform("w", lambda x, i: F.struct(x.alias("a"), F.coalesce(F.get("w", i + 1), F.lit("")).alias("b")))).alias("s"))
    names = pairs.select(F.explode(F.array(
        F.col("s.a"), F.upper("s.a"), F.concat_ws("_", F.lower("s.a"), F.lower("s.b")),
        F.concat_ws("_", F.upper("s.a"), F.upper("s.b")), F.concat(F.lower("s.a"), F.initcap("s.b")))).alias("value"))
    return values.union(digests).withColumn("random", F.lit(True)).union(names.withColumn("random", F.lit(False)))


def train(samples: DataFrame, weight: float = 4.0) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII codes (0: the begin), as 128 * first + second.

    Each model's transitions are interpolated with its characters, and those with
    an even spread.  The counts that reach the driver number at most 2 * 128 * 128.
    """
    codes = F.transform(F.filter(F.split("value", ""), lambda c: F.length(c) > 0), lambda c: F.ascii(c))
    steps = samples.select("random", codes.alias("c")).select("random", F.explode(F.transform(
        "c", lambda x, i: F.struct(F.when(i > 0, F.get("c", i - 1)).otherwise(0).alias("a"), x.alias("b")))).alias("s"))
    rows = steps.filter("s.a < 128 and s.b < 128").groupBy("random", "s.a", "s.b").count().collect()
    ratio = [0.0] * (128 * 128)
    for label, sign in ((True, 1), (False, -1)):
        pair, one, start = {}, [0] * 128, [0] * 128
        for r in rows:
            if r["random"] == label:
                pair[r["a"], r["b"]] = r["count"]
                one[r["b"]] += r["count"]
                start[r["a"]] += r["count"]
        total = sum(one)
        for b in range(128):
            low = (one[b] + weight / 64) / (total + 2 * weight)
            for a in range(128):
                ratio[128 * a + b] += sign * math.log((pair.get((a, b), 0) + weight * low) / (start[a] + weight))
    return ratio


def _ratio(value: Column, table: str) -> Column:
    """A string's log-likelihood ratio, in one pass over its characters."""
    step = F.aggregate(F.split(value, ""), F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("s")),
                       lambda acc, c: F.when(F.length(c) == 0, acc).otherwise(F.struct(
                           F.ascii(c).alias("a"), (acc["s"] + F.element_at(F.col(table), acc["a"] * 128 + F.ascii(c) + 1)).alias("s"))))
    return step["s"]


def find(docs: DataFrame, model: list[float], text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text``, ``_base`` and ``_spans``: sorted spans (start, kind, end)."""
    table = ",".join(f"{x:.4f}" for x in model)
    df = _base(docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    df = df.withColumn("_base", F.array_sort(F.concat(_kind("_assign", 0), _kind("_access", 1), _kind("_hex", 2))))
    df = _matches(df, RUN, "_runs").withColumn("_table", F.split(F.lit(table), ",").cast("array<double>"))
    apart = F.filter("_runs", lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    df = df.withColumn("_random", F.filter(apart, lambda r: _ratio(r["value"], "_table") >= ODDS))
    return df.withColumn("_spans", F.array_sort(F.concat("_base", _kind("_random", 3)))).drop("_table", "_runs", "_random")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: counts of each kind, the digest of the base spans, and all spans as ``kind:start:end``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = find(rows, train(labelled_samples(rows, sample=sample)))
    return found.select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(_written(F.col("_base")), 256).alias("base_sha256"), _written(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", sample: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; a null text stays null."""
    rows = boxed(docs, doc_id=id_col, text=text_col)
    found = find(rows, train(labelled_samples(rows, sample=sample)))
    parts = F.aggregate("_spans", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(
            F.substring(F.col("_text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))))
        .otherwise(acc["out"]).alias("out")))
    clean = F.concat(F.concat_ws("", parts["out"]), F.substring(F.col("_text"), (parts["at"] + 1).cast("int"), F.length("_text")))
    return unboxed(found, docs.columns, **{text_col: F.when(F.size("_spans") > 0, clean).otherwise(F.col("text"))})
