"""Report tables (F8, F17-F24, J5, P16-P18, S8): the data behind every card.

Each card is a DataFrame with one row per index (or per index and item),
ordered by explicit rank columns.  Cards are built from the flat tables of
``market.MarketTables`` they need and from nothing else.  HTML is not produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.functions import labels, text
from tickframe.functions.numeric import rnd
from tickframe.functions.text import fixed, fmt_int, fmt_num, fmt_or_na, join_signed_list
from tickframe.operators.clean import short_circuit_error
from tickframe.operators.rank import collect_top_lists

NO_DATA = "no data"   # placeholder item of an empty list (F19)


# ------------------------------------------------------------------ J5 / F10
def latest_answers(answers: DataFrame, order: str | None = None) -> DataFrame:
    """One answer per index (``index, raw``): the last by column ``order``, such as a time or a run number.

    A later answer replaces an earlier one, as a rewritten document does.  Rows without an order
    come before all others; ties, and answers without an order column, go by the largest text.
    """
    place = F.struct(*([F.col(order)] if order else []), F.coalesce("raw", F.lit("")))
    return answers.groupBy("index").agg(F.max_by("raw", place).alias("raw"))


def analyses(indexes: DataFrame, errors: DataFrame, answers: DataFrame, order: str | None = None) -> DataFrame:
    """``index, analysis, error, raw``: the index codes left-joined with their latest answers.

    ``order`` is the column of ``answers`` that says which one of an index is the latest.
    An index that failed upstream is not analysed (P15): it keeps the upstream error.
    """
    parsed = latest_answers(answers, order).select("index", text.parse_analysis("raw").alias("_p"))
    upstream = errors.groupBy("index").agg(F.concat_ws("; ", F.array_sort(F.collect_list("error"))).alias("error"))
    ok, failed = short_circuit_error(indexes.select("index").join(upstream, "index", "left"))
    done = ok.join(parsed, "index", "left").select("index", "_p.analysis", "_p.error", "_p.raw")
    return done.unionByName(failed.select("index", "error"), allowMissingColumns=True)


def report_errors(indexes: DataFrame, errors: DataFrame) -> DataFrame:
    """The card of an index that failed: its errors, one row each."""
    return indexes.select("index", "ord").join(errors, "index").select("index", "ord", "error")


# ------------------------------------------------------------------------ F8
#: group, label, snapshot field, digits (None: a count), signed
PROMPT_FIELDS = [
    ("price", "close", "close", 2, False), ("price", "change %", "change_pct", 2, True),
    ("price", "open", "open", 2, False), ("price", "high", "high", 2, False), ("price", "low", "low", 2, False),
    ("volume", "traded", "volume", None, False), ("volume", "20-bar mean", "vol_ma20", 0, False),
    *[("average", f"{p} bars", f"ma{p}", 2, False) for p in (5, 10, 20, 50, 100, 200)],
    *[("band", side, f"bb_{side}", 2, False) for side in ("lower", "mid", "upper")],
    ("momentum", "RSI 14", "rsi14", 1, False), ("momentum", "stochastic K", "stoch_k", 1, False),
    ("momentum", "stochastic D", "stoch_d", 1, False), ("momentum", "MACD", "macd", 2, False),
    ("momentum", "MACD signal", "macd_signal", 2, False), ("momentum", "MACD histogram", "macd_hist", 2, False),
    ("range", "ATR 14", "atr14", 2, False), ("range", "52-week low", "lo52", 2, False), ("range", "52-week high", "hi52", 2, False),
    *[("pivot", name.upper(), name, 2, False) for name in ("s3", "s2", "s1", "pivot", "r1", "r2", "r3")],
    *[("retracement", f"{int(f) / 10:g} %", f"fibo_{f}", 2, False) for f in ("236", "382", "500", "618", "786")],
]
PROMPT_LISTS = [("strongest sectors", "leading", "name"), ("weakest sectors", "lagging", "name"),
                ("gainers", "top_gainers", "symbol"), ("losers", "top_losers", "symbol")]


def answer_shape(t: T.DataType = text.ANALYSIS) -> str:
    """The answer's schema as text: every key with the type of its value."""
    if isinstance(t, T.StructType):
        return "{" + ", ".join(f'"{f.name}": {answer_shape(f.dataType)}' for f in t.fields) + "}"
    if isinstance(t, T.ArrayType):
        return f"[{answer_shape(t.elementType)}, ...]"
    return "number" if isinstance(t, T.DoubleType) else "text"


def prompt_rules() -> list[str]:
    """What the answer must look like, from the record and the vocabularies that parse it."""
    return ["Reply with one JSON object of this shape and nothing else:", answer_shape(),
            "trend: " + ", ".join(t for t, _ in labels.TREND_TONE) + "; sentiment: " + ", ".join(s for s, _, _ in labels.SENTIMENT_ICON)
            + "; probability: percent, all scenarios together 100"]


def build_prompt(snap: DataFrame, movers: DataFrame, sectors: DataFrame) -> DataFrame:
    """F8: one prompt text per index: a line per field of PROMPT_FIELDS, a line per list, the rules."""
    lists = collect_top_lists(movers, sectors).withColumnRenamed("index", "_ix")
    j = snap.join(lists, F.col("index") == F.col("_ix"), "left")
    lines = [F.concat(F.lit("Index "), F.col("index"), F.lit(", bar of "), F.coalesce("date", F.lit("today")))]
    for group, label, field, digits, sign in PROMPT_FIELDS:
        value = fmt_int(F.col(field)) if digits is None else fmt_or_na(F.col(field), digits, sign)
        lines.append(F.concat(F.lit(f"[{group}] {label} = "), value))
    lines += [F.concat(F.lit(f"[market] {label} = "), join_signed_list(F.col(column), name)) for label, column, name in PROMPT_LISTS]
    lines += [F.lit(rule) for rule in prompt_rules()]
    return j.select("index", F.concat_ws("\n", *lines).alias("prompt"))


# ----------------------------------------------------------------------- F17
def report_hero(snap: DataFrame) -> DataFrame:
    """F17 + F16: code, price, signed change, date, volume, high, low."""
    d = labels.hero_direction("change_pct")
    change = F.concat(d["sign"], fixed("change", 2), F.lit(" ("), d["sign"], fixed("change_pct", 2), F.lit("%)"))
    return snap.select(
        "index", d["tone"].alias("tone"), fmt_num("close").alias("price"), change.alias("change"),
        F.coalesce("date", F.lit("")).alias("date"), fmt_int("volume").alias("volume"),
        fmt_num("high").alias("high"), fmt_num("low").alias("low"))


# ----------------------------------------------------------------------- F18
def report_summary(analysed: DataFrame) -> DataFrame:
    """shown only when the analysis has a summary."""
    a = F.col("analysis")
    icon = labels.sentiment_icon(F.coalesce(a["sentiment"], F.lit(labels.NEUTRAL_SENTIMENT)))
    return analysed.filter(F.coalesce(a["summary"], F.lit("")) != "").select(
        "index", icon["tone"].alias("tone"), icon["text"].alias("sentiment"),
        F.coalesce(a["market_description"], a["summary"]).alias("description"),
        F.nullif(a["recommendation"], F.lit("")).alias("recommendation"))


# ----------------------------------------------------------------------- F19
MOVER_LISTS = ("leading", "lagging", "gainers", "losers")


def report_movers(movers: DataFrame, sectors: DataFrame, reported: DataFrame) -> DataFrame:
    """four lists (leading / lagging sectors, top gainers / losers) of each ``reported`` index.

    One row per item with a signed percent; an empty list has one placeholder row with rank 0.
    """
    def sector(name: str, place: str, tone: str) -> DataFrame:
        return sectors.filter(F.col(place).isNotNull()).select(
            "index", F.lit(name).alias("list"), F.col(place).alias("rank"), F.col("sector").alias("name"), F.lit(tone).alias("tone"), "change_pct")

    side = F.col("side") == "gainer"
    stocks = movers.select("index", F.when(side, "gainers").otherwise("losers").alias("list"), "rank", F.col("symbol").alias("name"),
                           F.when(side, "pos").otherwise("neg").alias("tone"), "change_pct")
    items = sector("leading", "lead_rank", "pos").unionByName(sector("lagging", "lag_rank", "neg")).unionByName(stocks)
    wanted = reported.select("index", F.explode(F.array(*map(F.lit, MOVER_LISTS))).alias("list"))
    return wanted.join(items, ["index", "list"], "left").select(
        "index", "list", F.coalesce("rank", F.lit(0)).cast("long").alias("rank"), F.coalesce("name", F.lit(NO_DATA)).alias("name"),
        "tone", F.concat(fixed("change_pct", 2, sign=True), F.lit("%")).alias("change"))


# ----------------------------------------------------------------------- F20
LEVEL_ROWS = [  # (order, label, source, field)
    (1, "strong_resistance", "analysis", "strong_resistance"),
    (2, "immediate_resistance", "analysis", "immediate_resistance"),
    (3, "close", "snapshot", "close"),
    (4, "immediate_support", "analysis", "immediate_support"),
    (5, "strong_support", "analysis", "strong_support"),
    (6, "pivot", "snapshot", "pivot"), (7, "r1", "snapshot", "r1"), (8, "r2", "snapshot", "r2"),
    (9, "r3", "snapshot", "r3"), (10, "s1", "snapshot", "s1"), (11, "s2", "snapshot", "s2"),
    (12, "s3", "snapshot", "s3"), (13, "fibo_236", "snapshot", "fibo_236"),
    (14, "fibo_382", "snapshot", "fibo_382"), (15, "fibo_500", "snapshot", "fibo_500"),
    (16, "fibo_618", "snapshot", "fibo_618"), (17, "fibo_786", "snapshot", "fibo_786"),
]


def report_levels(snap: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """support / resistance card as rows ``index, pos, level, value, text``.

    Key levels come from the analysis (null without one), the rest from the
    snapshot; R3, S3 and the 78.6 % level are shown too (N15).
    """
    if analysed is None:
        j = snap.withColumn("_key", F.lit(None).cast(text.ANALYSIS["key_levels"].dataType))
    else:
        j = snap.join(analysed.select("index", F.col("analysis.key_levels").alias("_key")), "index", "left")
    rows = F.array(*[F.struct(F.lit(o).cast("long").alias("pos"), F.lit(lbl).alias("level"),
                              (F.col("_key")[fld] if so == "analysis" else F.col(fld)).cast("double").alias("value"))
                     for o, lbl, so, fld in LEVEL_ROWS])
    return j.select("index", F.explode(rows).alias("_r")).select(
        "index", "_r.pos", "_r.level", rnd("_r.value", 2).alias("value"), fmt_num("_r.value").alias("text"))


def report_levels_comment(analysed: DataFrame) -> DataFrame:
    """F20 comment line: only when the analysis has one."""
    c = F.col("analysis.support_resistance.comment")
    return analysed.filter(F.coalesce(c, F.lit("")) != "").select("index", c.alias("comment"))


# ----------------------------------------------------------------------- F21
TIMEFRAMES = [(1, "short", "short_term"), (2, "mid", "mid_term"), (3, "long", "long_term")]


def report_timeframes(analysed: DataFrame) -> DataFrame:
    """three cards; a missing card is skipped; one row per signal (a card without signals: one null signal)."""
    cards = F.array(*[F.struct(F.lit(o).cast("long").alias("pos"), F.lit(lbl).alias("frame"),
                               F.col("analysis.timeframe_analysis")[key].alias("tf")) for o, lbl, key in TIMEFRAMES])
    e = analysed.select("index", F.explode(cards).alias("_c")).filter(F.col("_c.tf").isNotNull())
    badge = labels.trend_badge(F.col("_c.tf.trend"), F.col("_c.tf.strength"))
    e = e.withColumn("_b", badge).select(
                 "index", "_c.pos", "_c.frame", F.col("_b.tone").alias("tone"), F.col("_b.text").alias("badge"),
                 F.coalesce("_c.tf.comment", F.lit("")).alias("comment"), F.posexplode_outer("_c.tf.signals").alias("_sp", "signal"))
    return e.select("index", "pos", "frame", "tone", "badge", "comment", (F.col("_sp") + 1).cast("long").alias("signal_pos"), "signal")


# ----------------------------------------------------------------------- F22
def report_scenarios(analysed: DataFrame) -> DataFrame:
    """one row per scenario with its class; probability defaults to 0."""
    e = analysed.select("index", F.posexplode("analysis.scenarios").alias("_p", "_s"))
    return e.select("index", (F.col("_p") + 1).cast("long").alias("pos"),
                    F.coalesce("_s.name", F.lit("")).alias("name"),
                    labels.scenario_class("_s.name").alias("tone"),
                    F.coalesce("_s.probability", F.lit(0.0)).alias("probability"),
                    F.coalesce("_s.target", F.lit("")).alias("target"),
                    F.coalesce("_s.condition", F.lit("")).alias("condition"),
                    F.coalesce("_s.description", F.lit("")).alias("description"))


# ----------------------------------------------------------------------- F23
INDICATOR_ROWS = [  # (pos, group, label, field, decimals, status)
    (1, "ma", "MA5", "ma5", 2, None), (2, "ma", "MA10", "ma10", 2, None),
    (3, "ma", "MA20", "ma20", 2, None), (4, "ma", "MA50", "ma50", 2, None),
    (5, "ma", "MA100", "ma100", 2, None), (6, "ma", "MA200", "ma200", 2, None),
    (7, "osc", "RSI(14)", "rsi14", 1, "rsi"), (8, "osc", "Stoch %K", "stoch_k", 1, None),
    (9, "osc", "Stoch %D", "stoch_d", 1, None), (10, "osc", "MACD", "macd", 2, "macd"),
    (11, "osc", "Signal", "macd_signal", 2, None), (12, "osc", "ATR(14)", "atr14", 2, None),
    (13, "bb", "Upper", "bb_upper", 2, None), (14, "bb", "Middle", "bb_mid", 2, None),
    (15, "bb", "Lower", "bb_lower", 2, None), (16, "52w", "High", "hi52", 2, None),
    (17, "52w", "Low", "lo52", 2, None),
]


def report_indicators(snap: DataFrame, strict_rsi: bool = False) -> DataFrame:
    """17 ``(label, value, status)`` rows per index with F11 / F12 statuses."""
    status = {"rsi": labels.rsi_status("rsi14", strict_rsi), "macd": labels.macd_status("macd_hist"), None: F.lit(None).cast("string")}
    rows = F.array(*[F.struct(F.lit(p).cast("long").alias("pos"), F.lit(g).alias("grp"), F.lit(lbl).alias("label"),
                              fmt_num(f, d).alias("value"), status[st].alias("status")) for p, g, lbl, f, d, st in INDICATOR_ROWS])
    return snap.select("index", F.explode(rows).alias("_r")).select("index", "_r.*")


# ------------------------------------------------------------------- P16-P18
def truthy(x: Column) -> Column:
    """JavaScript truthiness of a number: non-null and non-zero."""
    return x.isNotNull() & (x != 0)


def chart_candles(ohlcv: DataFrame) -> DataFrame:
    """Candles whose close is truthy."""
    return ohlcv.filter(truthy(F.col("close"))).select("index", "pos", "time", "open", "high", "low", "close")


def chart_volume(ohlcv: DataFrame) -> DataFrame:
    """Volume bars with a truthy volume; up colour when close >= open."""
    return ohlcv.filter(truthy(F.col("volume"))).select(
        "index", "pos", "time", F.col("volume").alias("value"),
        F.when(F.col("close") >= F.col("open"), F.lit("up")).otherwise(F.lit("down")).alias("color"))


CHART_LINES = ["ma5", "ma10", "ma20", "ma50", "ma100", "ma200", "bb_upper", "bb_mid", "bb_lower"]


def chart_lines(ohlcv: DataFrame) -> DataFrame:
    """The 6 MA and 3 band lines, long form, truthy points only."""
    long = ohlcv.unpivot(["index", "pos", "time"], CHART_LINES, "line", "value")
    return long.filter(truthy(F.col("value")))


VIEW_DAYS = (30, 90, 180, 365)


def view_range(ohlcv: DataFrame, days: int) -> DataFrame:
    """W13 for the chart zoom buttons: the last ``days`` export rows of each index (by count)."""
    n = F.max("pos").over(Window.partitionBy("index"))     # the export bounds the rows of an index
    return ohlcv.withColumn("_n", n).filter(F.col("pos") > F.col("_n") - F.lit(days)).drop("_n")


def series_json(ohlcv: DataFrame) -> DataFrame:
    """One JSON array of the export rows per index (the embedded chart data)."""
    fields = [c for c in ohlcv.columns if c not in ("index", "symbol", "rn", "pos")]
    return ohlcv.groupBy("index").agg(F.array_sort(F.collect_list(F.struct("pos", *fields))).alias("_o")).select(
        "index", F.size("_o").cast("long").alias("points"), F.to_json(F.transform("_o", lambda x: x.dropFields("pos"))).alias("json"))
