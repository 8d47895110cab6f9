"""Bar views over the test tables (the stand-in for the candle web API).

Each view turns a tick-like table into daily or hourly OHLCV bars with one
``groupBy``: open / close are ``min_by`` / ``max_by`` on a unique order key,
high / low are ``max`` / ``min``.  All five aggregates are partial
(map-side combined), so a symbol that holds a third of all ticks is reduced on
every mapper before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BAR_COLUMNS = ["symbol", "time", "open", "high", "low", "close", "volume"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ohlcv(ticks: DataFrame, symbol: Column, time: Column, price: Column,
          order_key: Column, volume: Column) -> DataFrame:
    """Aggregate ticks into bars ``symbol, time, open, high, low, close, volume``."""
    t = ticks.select(symbol.alias("symbol"), time.alias("time"),
                     price.alias("_px"), order_key.alias("_ok"), volume.alias("_vol"))
    return t.groupBy("symbol", "time").agg(
        F.min_by("_px", "_ok").alias("open"),
        F.max("_px").alias("high"),
        F.min("_px").alias("low"),
        F.max_by("_px", "_ok").alias("close"),
        F.sum("_vol").cast("double").alias("volume"),
    )


def _lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        "l_quantity", "l_extendedprice", "l_shipdate")


def _li_price() -> Column:
    return F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))


def _li_key() -> Column:
    # order, line (one digit) and part (19 digits) side by side: a decimal keeps the aggregate hash-based
    return F.expr("cast(l_orderkey as decimal(18, 0)) * cast(100000000000000000000 as decimal(21, 0))"
                  " + cast(l_linenumber as decimal(1, 0)) * cast(10000000000000000000 as decimal(20, 0))"
                  " + cast(l_partkey as decimal(19, 0))").cast("decimal(38, 0)")


def bars_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per part brand (25 long series)."""
    li = _lineitem_ticks(spark, sf_dir)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    ticks = li.join(part, li.l_partkey == part.p_partkey)
    return ohlcv(ticks, F.col("p_brand"), F.to_date("l_shipdate"), _li_price(), _li_key(),
                 F.col("l_quantity"))


def bars_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier (many medium series)."""
    li = _lineitem_ticks(spark, sf_dir)
    return ohlcv(li, F.col("l_suppkey").cast("string"), F.to_date("l_shipdate"), _li_price(),
                 _li_key(), F.col("l_quantity"))


def bars_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per return flag (the three-index shape)."""
    li = _lineitem_ticks(spark, sf_dir)
    return ohlcv(li, F.col("l_returnflag"), F.to_date("l_shipdate"), _li_price(), _li_key(),
                 F.col("l_quantity"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id",
                                                      "event_type", "value")


def bars_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars per event type; irregular gaps, ``time`` stays a timestamp."""
    ev = _events(spark, sf_dir)
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return ohlcv(ev, F.col("event_type"), hour, F.col("value"), F.col("event_id"), F.lit(1))


def bars_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per user: short series (all below the 50-bar guard)."""
    ev = _events(spark, sf_dir)
    return ohlcv(ev, F.col("user_id").cast("string"), F.to_date("ts"), F.col("value"),
                 F.col("event_id"), F.lit(1))


BAR_VIEWS = {
    "brand": bars_brand,
    "supp": bars_supp,
    "flag": bars_flag,
    "hour": bars_hour,
    "user": bars_user,
}


def bars(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return BAR_VIEWS[view](spark, sf_dir)


def time_text(col: str | Column = "time") -> Column:
    """Bar time as text: ``yyyy-MM-dd`` for dates, ``yyyy-MM-dd HH:mm:ss`` for hours."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


# ------------------------------------------------------------ derived test inputs
def dirty(b: DataFrame) -> DataFrame:
    """Bars with faults by day of month: NaN close (13), infinite high (14), null open (17), NaN volume (18), a second copy (19)."""
    day = F.dayofmonth("time")
    bad = b.select(
        "symbol", "time", F.when(day != 17, F.col("open")).alias("open"),
        F.when(day == 14, F.lit(float("inf"))).otherwise(F.col("high")).alias("high"), "low",
        F.when(day == 13, F.lit(float("nan"))).otherwise(F.col("close")).alias("close"),
        F.when(day == 18, F.lit(float("nan"))).otherwise(F.col("volume")).alias("volume"))
    return bad.unionAll(bad.filter(F.dayofmonth("time") == 19))


def rendered_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``index, raw``: one analysis answer per document, written in six ways by its id.

    Plain, fenced, fenced without a newline, cut short, followed by another
    object, and with loosely typed leaves; the summary is the document's text.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    kind = F.col("doc_id") % 6
    number = F.col("doc_id").cast("string")
    trend = F.element_at(F.array(F.lit("Tăng"), F.lit("Giảm"), F.lit("Đi ngang"), F.col("source")), (F.col("doc_id") % 4 + 1).cast("int"))
    sentiment = F.element_at(F.array(F.lit("Tích cực"), F.lit("Tiêu cực"), F.lit("Trung lập"), F.lit(None).cast("string"), F.col("lang")),
                             (F.col("doc_id") % 5 + 1).cast("int"))
    frames = F.struct(
        F.struct(trend.alias("trend"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("strength"),
                 F.array("lang", "source").alias("signals"), F.col("source").alias("comment")).alias("short_term"),
        F.struct(F.lit("flat").alias("trend"), F.array().cast("array<string>").alias("signals")).alias("long_term"))
    scenarios = F.array(
        F.struct(F.concat(F.lit("Bull "), "source").alias("name"), F.when(kind == 5, F.concat((F.col("doc_id") % 100).cast("string"), F.lit("%")))
                 .otherwise((F.col("doc_id") % 100).cast("string")).alias("probability"), F.col("lang").alias("target")),
        F.struct(F.lit("Kịch bản GIẢM").alias("name"), F.lit(None).cast("string").alias("probability"), F.lit(None).cast("string").alias("target")))
    levels = F.struct(F.when(kind == 5, F.format_number("doc_id", 0)).otherwise(number).alias("immediate_support"),
                      (F.col("doc_id") * 1.5).alias("strong_resistance"), F.lit("n/a").alias("strong_support"))
    common = [F.col("text").alias("summary"), frames.alias("timeframe_analysis"), scenarios.alias("scenarios"), levels.alias("key_levels"),
              sentiment.alias("sentiment"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("recommendation")]
    comment = F.struct(F.concat(F.lit("near "), number).alias("comment"))
    body = F.when(kind == 5, F.to_json(F.struct(*common, F.lit("plain text").alias("support_resistance")))) \
        .otherwise(F.to_json(F.struct(*common, comment.alias("support_resistance"))))
    raw = (F.when(kind == 1, F.concat(F.lit(" ```json\n"), body, F.lit("\n```\n"))).when(kind == 2, F.concat(F.lit("```"), body, F.lit("```")))
           .when(kind == 3, F.expr("substring(_body, 1, length(_body) - 1)")).when(kind == 4, F.concat(body, F.lit(' {"x": 1}'))).otherwise(body))
    return d.withColumn("_body", body).select(number.alias("index"), raw.alias("raw"))


def answered_indexes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``index, ord`` of every document and ``index, error`` of those that count as failed upstream."""
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("index"), F.col("doc_id").alias("ord"))
    return d, d.filter("ord % 7 = 0").select("index", F.lit("no data").alias("error"))
