"""Text functions (F1-F10): number formatting, lists, the prompt, answer parsing.

All are ``Column -> Column`` built from ``format_string``, ``format_number``,
``concat``, ``transform``/``array_join``, ``regexp_replace`` and ``from_json``,
so they run in the JVM inside whole-stage codegen.

Formatting rule (N13): a value is rounded half-up with ``rnd`` to the shown
number of places *before* it is formatted, so every engine prints the same
digits (printf-style formatting differs between engines on exact ties).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions.numeric import rnd

PLACEHOLDER = "—"      # shown for a missing number (F4)
NOT_AVAILABLE = "N/A"  # shown for a missing number in the prompt (F6)


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fixed(x: str | Column, d: int = 2, sign: bool = False) -> Column:
    """``{x:.{d}f}`` (``{x:+.{d}f}`` with ``sign``) after half-up rounding; null stays null."""
    return F.format_string(f"%{'+' if sign else ''}.{d}f", rnd(_c(x), d))


def fmt_num(x: str | Column, d: int = 2, suffix: str = "") -> Column:
    """thousands separators, ``d`` places, optional suffix; null -> placeholder."""
    v = F.format_number(rnd(_c(x), d), d)
    return F.coalesce(F.concat(v, F.lit(suffix)), F.lit(PLACEHOLDER))


def fmt_int(x: str | Column) -> Column:
    """``{v:,}`` of an integer count (volume); null -> ``N/A``."""
    return F.coalesce(F.format_number(_c(x).cast("long"), 0), F.lit(NOT_AVAILABLE))


def chg_class(x: str | Column) -> Column:
    """Sign class of a change: ``pos`` / ``neg`` / ``flat``; null -> null."""
    v = _c(x)
    return F.when(v > 0, F.lit("pos")).when(v < 0, F.lit("neg")).when(v == 0, F.lit("flat"))


def fmt_chg(x: str | Column) -> Column:
    """signed percent text (``+`` only above zero) with its class, as a struct."""
    v = _c(x)
    sign = F.when(v > 0, F.lit("+")).otherwise(F.lit(""))
    text = F.when(v.isNull(), F.lit(PLACEHOLDER)).otherwise(F.concat(sign, fixed(v, 2), F.lit("%")))
    return F.struct(chg_class(v).alias("tone"), text.alias("text"))


def fmt_or_na(x: str | Column, d: int = 2, sign: bool = False) -> Column:
    """printf formatting or ``N/A``; null never reaches ``format_string``."""
    v = _c(x)
    return F.when(v.isNull(), F.lit(NOT_AVAILABLE)).otherwise(fixed(v, d, sign))


def join_signed_list(arr: str | Column, name: str, value: str = "change_pct", d: int = 1) -> Column:
    """``"name (+1.2%), ..."`` from an array of records; empty or null -> ``N/A``."""
    items = F.transform(_c(arr), lambda x: F.concat(
        x[name], F.lit(" ("), F.format_string(f"%+.{d}f", rnd(x[value], d)), F.lit("%)")))
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit(NOT_AVAILABLE))


def strip_ws(x: Column) -> Column:
    """Python ``str.strip()`` for ASCII whitespace (Spark ``trim`` keeps newlines)."""
    return F.btrim(x, F.lit(" \t\n\r\f\x0b"))


def strip_fence(raw: str | Column) -> Column:
    """remove a markdown fence around an answer.

    The answer is stripped; if it then starts with a fence, the first line is
    dropped, everything from the last fence on is dropped, and the rest is
    stripped again.  A fenced answer without a newline becomes empty, so it
    is reported as malformed with its text (N17).
    """
    def fenced(s: Column) -> Column:
        first_nl = F.instr(s, "\n")
        tail = F.when(first_nl > 0, F.substr(s, first_nl + 1)).otherwise(F.lit(""))
        before_last = F.when(tail.contains("```"), F.regexp_extract(tail, r"(?s)^(.*)```", 1)) \
            .otherwise(tail)
        return F.when(s.startswith("```"), strip_ws(before_last)).otherwise(s)

    return _let(strip_ws(_c(raw)), fenced)


# The analysis record the answer must parse into.
TIMEFRAME = T.StructType([
    T.StructField("trend", T.StringType()), T.StructField("strength", T.StringType()),
    T.StructField("signals", T.ArrayType(T.StringType())), T.StructField("comment", T.StringType())])
ANALYSIS = T.StructType([
    T.StructField("summary", T.StringType()),
    T.StructField("market_description", T.StringType()),
    T.StructField("support_resistance", T.StructType([
        T.StructField("key_resistance", T.StringType()), T.StructField("key_support", T.StringType()),
        T.StructField("comment", T.StringType())])),
    T.StructField("timeframe_analysis", T.StructType([
        T.StructField("short_term", TIMEFRAME), T.StructField("mid_term", TIMEFRAME),
        T.StructField("long_term", TIMEFRAME)])),
    T.StructField("scenarios", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("probability", T.DoubleType()),
        T.StructField("condition", T.StringType()), T.StructField("target", T.StringType()),
        T.StructField("description", T.StringType())]))),
    T.StructField("key_levels", T.StructType([
        T.StructField(k, T.DoubleType()) for k in
        ("immediate_resistance", "immediate_support", "strong_resistance", "strong_support")])),
    T.StructField("sentiment", T.StringType()),
    T.StructField("recommendation", T.StringType()),
])
PARSE_ERROR = "JSON parse error"



def _let(x: Column, of) -> Column:
    """``of(x)`` with ``x`` evaluated once: a filter or a branch would evaluate it anew at each place it stands."""
    return F.get(F.transform(F.array(x), of), F.lit(0))


def _number(text: Column) -> Column:
    """A number written as such, with thousands separators, or with a percent sign; else null."""
    return F.regexp_replace(text, r"[,%\s]", "").try_cast("double")


def parse_analysis(raw: str | Column) -> Column:
    """answer text -> ``struct<analysis, error, raw>``.

    The fence is stripped first (F9).  Validity is one strict check of the whole
    text, which must be one JSON object.  The parser ignores what follows a
    value, so the text is parsed inside brackets and inside braces: no tail can
    close both.  The record's parts are then read one by one:
    a part of another type is null (numbers may be written as text), and the
    rest of the answer stays.  A malformed answer keeps its whole stripped text.
    """
    def part(value: Column, t: T.DataType, path: str) -> Column:
        if isinstance(t, T.StructType):
            return F.when(F.try_variant_get(value, path, "map<string,variant>").isNotNull(),
                          F.struct(*[part(value, f.dataType, f"{path}.{f.name}").alias(f.name) for f in t.fields]))
        if isinstance(t, T.ArrayType):
            whole = F.try_variant_get(value, path, "array<variant>")
            inside = t.elementType
            if isinstance(inside, T.StructType):
                return F.transform(whole, lambda v: F.struct(*[
                    leaf(f.dataType, F.try_variant_get(v, f"$.{f.name}", "string")).alias(f.name) for f in inside.fields]))
            return F.transform(whole, lambda v: F.try_variant_get(v, "$", "string"))
        return leaf(t, F.try_variant_get(value, path, "string"))

    def leaf(t: T.DataType, text: Column) -> Column:
        return _number(text) if isinstance(t, T.DoubleType) else text

    def one_object(s: Column, listed: Column) -> Column:
        return F.coalesce((F.size(listed) == 1) & F.schema_of_variant(F.get(listed, F.lit(0))).startswith("OBJECT")
                          & F.try_parse_json(F.concat(F.lit('{"":'), s, F.lit("}"))).isNotNull(), F.lit(False))

    def answer(s: Column, value: Column) -> Column:
        shown = F.when(s == "", strip_ws(_c(raw))).otherwise(s)
        ok = value.isNotNull()
        analysis = F.when(ok, F.struct(*[part(value, f.dataType, f"$.{f.name}").alias(f.name) for f in ANALYSIS.fields]))
        return F.struct(analysis.alias("analysis"),
                        F.when(~ok, F.lit(PARSE_ERROR)).alias("error"),
                        F.when(~ok, shown).alias("raw"))

    def parsed(s: Column) -> Column:
        listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), s, F.lit("]"))), "$", "array<variant>")
        value = _let(listed, lambda v: F.when(one_object(s, v), F.get(v, F.lit(0))))
        return _let(value, lambda v: answer(s, v))

    return _let(strip_fence(raw), parsed)
