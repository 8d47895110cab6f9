"""Candle documents (S1-S4): JSON text in, canonical bars out.

A candle source answers with one JSON document per request, in one of three
shapes (S3):

* an envelope ``{"data": [{...}, {...}]}``,
* a bare list ``[{...}, {...}]``,
* a columnar object ``{"t": [...], "c": [...], ...}`` (an object without
  ``data`` is used as it is, and a frame built from it is column-wise).

Documents are rows of a table ``symbol, body`` (one row per symbol and
request), read with ``spark.read.text`` / ``json`` or produced upstream.  The
document is parsed once, into a variant; the three shapes are read off that by
fixed paths, the union of every field synonym, all as text, so no schema inference
runs and numbers written as text survive until ``coerce_numeric`` decides.  Text
that is no JSON has no candles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators import clean
from tickframe.operators.rank import STOCK_SCALE, last_n_bars

# Every field name a candle may use (P1 synonyms), read as text.
CANDLE_FIELDS = ["time", "tradingDate", "t", "d", "date", "Date",
                 "open", "o", "high", "h", "low", "l", "close", "c", "volume", "v"]
_UNIQUE = [f"_f{i}" for i in range(len(CANDLE_FIELDS))]
OUT_FIELDS = [f for f in CANDLE_FIELDS if f != "Date"]

INDEX_HISTORY = 400       # bars requested per index (S1)
STOCK_HISTORY = 10        # bars requested per stock (S2)


def unwrap_envelope(docs: DataFrame, body: str = "body", envelope_only: bool = False) -> DataFrame:
    """S3: one row per candle with the text fields of ``CANDLE``.

    ``envelope_only`` follows the stock source: only ``data`` is looked at and
    a document without it yields no rows.
    """
    keep = [c for c in docs.columns if c != body]
    parsed = docs.select(*keep, F.try_parse_json(F.trim(F.col(body))).alias("_v"))

    def array(path: str, of: str) -> Column:
        return F.try_variant_get("_v", path, f"array<{of}>")

    # paths are case-sensitive, so ``date`` and ``Date`` stay apart; a candle's fields are read as text
    def candle(v: Column) -> Column:
        return F.struct(*[F.try_variant_get(v, f"$.{f}", "string").alias(n) for f, n in zip(CANDLE_FIELDS, _UNIQUE)])

    if envelope_only:
        # a candle's own few fields are read once, as a map, not looked up one by one for each synonym
        rows = parsed.select(*keep, F.explode(array("$.data", "variant")).alias("_c")) \
            .select(*keep, F.try_variant_get("_c", "$", "map<string,string>").alias("_m"))
        get = lambda f: F.try_element_at("_m", F.lit(f))
        return rows.select(*keep, *[(F.coalesce(get(f), get("Date")) if f == "date" else get(f)).alias(f) for f in OUT_FIELDS])
    items = F.transform(array("$.data", "variant"), candle)
    if not envelope_only:
        none = F.array().cast("array<string>")
        zipped = F.arrays_zip(*[F.coalesce(array(f"$.{f}", "string"), none).alias(n) for f, n in zip(CANDLE_FIELDS, _UNIQUE)])
        listed = array("$", "variant")
        items = F.when(listed.isNotNull(), F.transform(listed, candle)) \
            .when(F.try_variant_get("_v", "$.data", "array<variant>").isNotNull(), items) \
            .otherwise(F.when(F.size(zipped) > 0, zipped))
    exploded = parsed.select(*keep, F.explode(items).alias("_c"))
    pos = dict(zip(CANDLE_FIELDS, _UNIQUE))
    fields = []
    for f in OUT_FIELDS:
        c = F.col("_c")[pos[f]]
        if f == "date":
            c = F.coalesce(c, F.col("_c")[pos["Date"]])
        fields.append(c.alias(f))
    return exploded.select(*keep, *fields)


def read_index_bars(docs: DataFrame, count: int | None = None) -> DataFrame:
    """Index candles -> canonical bars, all or the newest ``count`` per symbol."""
    bars = clean.coerce_bars(unwrap_envelope(docs), clean.normalize_date)
    return bars if count is None else last_n_bars(bars, count).drop("rn_desc")


def read_stock_bars(docs: DataFrame, days: int | None = None,
                    scale: float = STOCK_SCALE) -> DataFrame:
    """Stock candles (``t`` epoch seconds or date text, prices in thousands), all or the newest ``days``."""
    raw = unwrap_envelope(docs, envelope_only=True)
    bars = clean.coerce_bars(raw, clean.epoch_or_date, scale=scale)
    return bars if days is None else last_n_bars(bars, days).drop("rn_desc")


def read_candle_files(spark: SparkSession, path: str, symbol_from: str = "file") -> DataFrame:
    """Read one JSON document per file; the symbol is the file's base name."""
    df = spark.read.option("wholetext", "true").text(path)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.json)?$", 1)
    return df.select(name.alias("symbol"), F.col("value").alias("body"))


# ---------------------------------------------------------------- test documents
def _field(name: str):
    return lambda x: x[name]


def render_documents(bars: DataFrame, style: str, price_div: float = 1.0) -> DataFrame:
    """Render bars as candle documents ``symbol, body``, one per symbol and month.

    ``style="index"`` rotates the three S3 shapes by month (envelope with long
    names, bare list with short names and numbers as text, columnar object);
    ``style="stock"`` writes envelopes with unix-second ``t`` and prices
    divided by ``price_div``.  One document holds at most a month of bars,
    so the grouping is bounded.
    """
    month = F.date_format(F.col("time"), "yyyy-MM")
    shape = (F.month(F.col("time")) % 3)
    d = bars.select("symbol", month.alias("_m"), shape.alias("_shape"), "time", "open", "high",
                    "low", "close", "volume")
    if style == "stock":
        epoch = F.unix_date(F.to_date("time")).cast("long") * F.lit(86400)
        # unix seconds where they pass the 1e9 rule (P3), date text before that
        t = F.when(epoch > F.lit(1000000000), epoch.cast("string")) \
             .otherwise(F.date_format("time", "yyyy-MM-dd"))
        rec = F.struct(t.alias("t"),
                       *[(F.col(c) / F.lit(price_div)).alias(k)
                         for c, k in (("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"))],
                       F.col("volume").alias("v"))
        g = d.groupBy("symbol", "_m").agg(F.collect_list(rec).alias("data"))
        return g.select("symbol", F.to_json(F.struct("data")).alias("body"))
    long_rec = F.struct(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss").alias("tradingDate"),
                        "open", "high", "low", "close", "volume")
    short_rec = F.struct(F.date_format("time", "yyyy-MM-dd").alias("d"),
                         *[F.format_string("%s", F.col(c)).alias(k)
                           for c, k in (("open", "o"), ("high", "h"), ("low", "l"),
                                        ("close", "c"), ("volume", "v"))])
    g = d.groupBy("symbol", "_m", "_shape").agg(
        F.collect_list(long_rec).alias("_long"), F.collect_list(short_rec).alias("_short"))
    columnar = F.struct(
        F.transform("_long", lambda x: x["tradingDate"]).alias("time"),
        *[F.transform("_long", _field(c)).alias(c) for c in
          ("open", "high", "low", "close", "volume")])
    body = (F.when(F.col("_shape") == 0, F.to_json(F.struct(F.col("_long").alias("data"))))
             .when(F.col("_shape") == 1, F.to_json(F.col("_short")))
             .otherwise(F.to_json(columnar)))
    return g.select("symbol", body.alias("body"))
