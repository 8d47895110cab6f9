"""Cleaning, coercion, guards and error isolation.

Raw candles arrive with text fields under several names.  The functions here
turn them into the canonical bar schema

    symbol string, time date|timestamp, open, high, low, close, volume double

and split rows that cannot take part (no price, duplicate time, too little
history, nothing received) into an *error table* ``symbol, time, error`` so
one bad symbol never stops the others (P14).  Everything is column
expressions, ``groupBy`` and joins; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_COLUMNS = ["open", "high", "low", "close"]

# Column synonyms of the candle sources, in lookup order.
TIME_SYNONYMS = ["time", "tradingDate", "t", "d"]
TIME_FALLBACKS = ["date", "tradingDate", "Date"]   # date / Date are one column in Spark
FIELD_SYNONYMS = {"open": ["open", "o"], "high": ["high", "h"], "low": ["low", "l"],
                  "close": ["close", "c"], "volume": ["volume", "v"]}

# Date text layouts accepted besides ISO-8601.
DATE_LAYOUTS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss",
                "yyyy/MM/dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyyMMdd"]
EPOCH_THRESHOLD = 1e9     # a time value above this is unix seconds (P3)
EPOCH_LATEST = 4102444800.0   # 2100-01-01: later numbers are no unix seconds (milliseconds, noise)
SMALL_PRICE = 100.0       # a price column whose maximum is below this is rescaled (P7)
SMALL_FACTOR = 1000.0

# Columns of the chart export.
EXPORT_COLUMNS = ["time", "open", "high", "low", "close", "volume", "ma5", "ma10", "ma20", "ma50",
                  "ma100", "ma200", "bb_upper", "bb_mid", "bb_lower", "rsi14", "macd", "macd_signal",
                  "macd_hist", "stoch_k", "stoch_d"]


def _first_present(df: DataFrame, names: list[str]) -> Column | None:
    present = {c.lower(): c for c in df.columns}
    seen, cols = set(), []
    for n in names:
        c = present.get(n.lower()) if n not in df.columns else n
        if c is not None and c.lower() not in seen:
            seen.add(c.lower())
            cols.append(F.col(c))
    if not cols:
        return None
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def rename_synonyms(df: DataFrame) -> DataFrame:
    """Map ``tradingDate/t/d`` -> time and ``o/h/l/c/v`` -> canonical names.

    A missing volume column becomes null (filled with 0 by ``fill_volume``,
    N4); other absent fields become null.
    """
    keep = [c for c in df.columns if c.lower() not in {n.lower() for n in TIME_SYNONYMS + TIME_FALLBACKS}
            and all(c not in v for v in FIELD_SYNONYMS.values())]
    t = _first_present(df, TIME_SYNONYMS + TIME_FALLBACKS)
    cols = [F.col(c) for c in keep]
    cols.append((t if t is not None else F.lit(None).cast("string")).alias("time"))
    for canon, names in FIELD_SYNONYMS.items():
        c = _first_present(df, names)
        cols.append((c if c is not None else F.lit(None).cast("string")).alias(canon))
    return df.select(*cols)


def normalize_date(x: Column) -> Column:
    """Any date or date-time text -> DATE (null when unreadable)."""
    s = F.trim(x.cast("string"))
    parsed = [F.to_date(F.try_to_timestamp(s, F.lit(layout))) for layout in DATE_LAYOUTS]
    return F.coalesce(F.to_date(F.try_to_timestamp(s)), *parsed)


def epoch_day(x: Column) -> Column:
    """Unix seconds -> UTC calendar day, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(x / F.lit(86400.0)).cast("int"))


def epoch_or_date(x: Column) -> Column:
    """Numbers above 1e9 are unix seconds (UTC), anything else is date text.

    The reference looks at the first value of a series only; files have no
    arrival order, so the rule is applied per value.  Numbers that are no
    plausible seconds give null, which ``validate_bars`` reports.
    """
    num = coerce_numeric(x)
    seconds = F.when(num <= F.lit(EPOCH_LATEST), num)
    return F.when(num > F.lit(EPOCH_THRESHOLD), epoch_day(seconds)).otherwise(normalize_date(x))


def finite(x: Column) -> Column:
    """A number as it is; NaN and infinities are null."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def coerce_numeric(x: Column) -> Column:
    """``pd.to_numeric(errors='coerce')`` -> ``try_cast``; text like 'n/a', 'NaN' or 'Infinity' is null."""
    return finite(F.trim(x.cast("string")).try_cast("double"))


def fill_volume(x: Column) -> Column:
    """P5: unreadable or missing volume -> 0."""
    return F.coalesce(coerce_numeric(x), F.lit(0.0))


def coerce_bars(df: DataFrame, time_rule=None, scale: float | None = None) -> DataFrame:
    """P1-P6 in one projection: synonyms, date text, numbers, volume, fixed scale.

    ``time_rule`` maps the synonym-resolved time text to a date
    (default ``normalize_date``; stock candles use ``epoch_or_date``).
    """
    r = rename_synonyms(df)
    t = (time_rule or normalize_date)(F.col("time"))
    prices = [coerce_numeric(F.col(c)) for c in PRICE_COLUMNS]
    if scale is not None:
        prices = [p * F.lit(scale) for p in prices]
    other = [c for c in r.columns if c not in ["time"] + PRICE_COLUMNS + ["volume"]]
    return r.select(*other, t.alias("time"),
                    *[p.alias(c) for p, c in zip(prices, PRICE_COLUMNS)],
                    fill_volume(F.col("volume")).alias("volume"))


def scale_if_small(bars: DataFrame, threshold: float | None = SMALL_PRICE, factor: float = SMALL_FACTOR,
                   key: str = "symbol") -> DataFrame:
    """Per series and per column, prices whose maximum is below 100 are x1000 (``None``: never).

    The maxima come from a partial ``groupBy`` (one row per symbol) joined
    back, so a hot symbol is reduced on the mappers; AQE picks a broadcast
    when the per-symbol table is small at run time.
    """
    if threshold is None:
        return bars
    mx = bars.groupBy(key).agg(*[F.max(finite(F.col(c))).alias(f"_mx_{c}") for c in PRICE_COLUMNS])
    j = bars.join(mx, key)
    cols = [F.when(F.col(f"_mx_{c}") < threshold, F.col(c) * F.lit(factor))
            .otherwise(F.col(c)).alias(c) if c in PRICE_COLUMNS else F.col(c)
            for c in bars.columns]
    return j.select(*cols)


def errors_of(df: DataFrame, message: Column, time: Column | None = None) -> DataFrame:
    """Shape rows of the error table: ``symbol, time, error``."""
    t = time if time is not None else F.lit(None).cast("string")
    return df.select("symbol", t.cast("string").alias("time"), message.alias("error"))


def validate_bars(bars: DataFrame, key: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Split ``(good bars, error rows)``.

    Rejected rows: a null time, a price that is null, NaN or infinite (a bar
    needs all four prices), and every copy of a duplicated ``(symbol, time)``.
    A volume that is no finite number becomes 0 (P5).  Repeated pairs are found by
    partial counts and taken out by a join with the few that there are, so a pair with a
    million copies is counted where it is read and no bar is sorted for it.
    """
    if "volume" in bars.columns:
        bars = bars.withColumn("volume", F.coalesce(finite(F.col("volume").cast("double")), F.lit(0.0)))
    several = bars.filter(F.col("time").isNotNull()).groupBy(F.col(key).alias("_key"), F.col("time").alias("_time")) \
        .agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1").drop("_copies")
    repeated = F.col(key).eqNullSafe(F.col("_key")) & (F.col("time") == F.col("_time"))
    missing = F.lit(False)
    for c in PRICE_COLUMNS:
        missing = missing | finite(F.col(c)).isNull()
    whole = F.col("time").isNotNull() & ~missing
    good = bars.filter(whole).join(several, repeated, "left_anti")
    lacking = bars.filter(~whole)
    bad = errors_of(lacking, F.when(F.col("time").isNull(), F.lit("missing time")).otherwise(F.lit("missing price")), F.col("time"))
    copies = bars.filter(whole).join(several, repeated, "left_semi")
    return good, bad.unionByName(errors_of(copies, F.lit("duplicate time"), F.col("time")))


def require_history(bars: DataFrame, min_bars: int = 50,
                    key: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Series with fewer than ``min_bars`` bars become one error row each."""
    counts = bars.groupBy(key).agg(F.count(F.lit(1)).alias("n_bars"))
    short = counts.filter(F.col("n_bars") < min_bars)
    good = bars.join(counts.filter(F.col("n_bars") >= min_bars).select(key), key, "left_semi")
    msg = F.concat(F.lit("not enough data: only "), F.col("n_bars").cast("string"), F.lit(" rows"))
    return good, errors_of(short, msg)


def require_nonempty(requested: DataFrame, bars: DataFrame, key: str = "symbol") -> DataFrame:
    """Requested symbols without any bar -> error rows (anti join)."""
    missing = requested.select(key).distinct().join(bars.select(key), key, "left_anti")
    return errors_of(missing, F.concat(F.lit("no data for "), F.col(key)))


def short_circuit_error(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows carrying an error skip the next stage; returns (ok, failed)."""
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())


def export_columns(ind: DataFrame, n: int = 365) -> DataFrame:
    """The chart export, last ``n`` bars with 21 named columns.

    Only columns that exist are kept; time is cut to 10 characters; missing
    values are SQL NULL (never NaN).
    """
    tail = ind.filter(F.col("rn") > F.col("n_bars") - F.lit(n))
    cols = [F.col(c) for c in ("index", "symbol", "rn", "pos") if c in ind.columns]
    for c in EXPORT_COLUMNS:
        if c == "time":
            cols.append(F.substring(F.col("time").cast("string"), 1, 10).alias("time"))
        elif c in ind.columns:
            cols.append(F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c))
    return tail.select(*cols)
