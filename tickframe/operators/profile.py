"""The series profile: one mergeable aggregate that guards, rescales and numbers bars.

Per ``(symbol, bucket)`` a row of count and price maxima, combined on the mappers, so
a hot symbol ships a row per bucket and map task.  Prefix sums and totals over the
profile (one row per symbol and bucket) answer what would otherwise be passes and joins
of their own: the row number's offset (``with_row_index``), the number of bars
(P8, A4), the maxima (P7, A2), and which buckets hold the newest ``n`` rows (S4, W13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.clean import PRICE_COLUMNS, SMALL_FACTOR, SMALL_PRICE, errors_of, finite

BUCKET = "MM"


def with_bucket(bars: DataFrame, bucket: str = BUCKET) -> DataFrame:
    return bars.withColumn("_tb", F.trunc(F.to_date("time"), bucket))


def series_profile(bars: DataFrame, columns: list[str] = PRICE_COLUMNS, bucket: str = BUCKET, key: str = "symbol") -> DataFrame:
    """``key, _tb, _cnt, _off`` (rows of earlier buckets), ``_after`` (of later ones), ``n_bars`` and ``_mx_<column>``
    (the series' maximum, non-finite values aside)."""
    counts = with_bucket(bars, bucket).groupBy(key, "_tb").agg(
        F.count(F.lit(1)).alias("_cnt"), *[F.max(finite(F.col(c))).alias(f"_mx_{c}") for c in columns])
    whole = Window.partitionBy(key)
    before = whole.orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    after = whole.orderBy("_tb").rowsBetween(1, Window.unboundedFollowing)
    return counts.select(
        key, "_tb", "_cnt",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.coalesce(F.sum("_cnt").over(after), F.lit(0)).alias("_after"),
        F.sum("_cnt").over(whole).alias("n_bars"),
        *[F.max(f"_mx_{c}").over(whole).alias(f"_mx_{c}") for c in columns])


def checked_series(bars: DataFrame, min_bars: int = 50, threshold: float | None = SMALL_PRICE, factor: float = SMALL_FACTOR,
                   bucket: str = BUCKET, key: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """P8, P7 and the row index in one profile and one join: ``(bars with rn and n_bars, error rows)``.

    Series with fewer than ``min_bars`` bars become one error row each.  Columns whose
    maximum is below ``threshold`` are multiplied by ``factor`` (``None``: never).
    """
    profile = series_profile(bars, PRICE_COLUMNS if threshold is not None else [], bucket, key)
    short = profile.filter((F.col("n_bars") < min_bars) & (F.col("_off") == 0))           # a series' first bucket
    place = F.row_number().over(Window.partitionBy(key, "_tb").orderBy("time"))
    enough = profile.filter(F.col("n_bars") >= min_bars)
    numbered = with_bucket(bars, bucket).withColumn("_place", place).join(enough, [key, "_tb"])

    def price(c: str):
        if threshold is None or c not in PRICE_COLUMNS:
            return F.col(c)
        return F.when(F.col(f"_mx_{c}") < threshold, F.col(c) * F.lit(factor)).otherwise(F.col(c)).alias(c)

    good = numbered.select(*[price(c) for c in bars.columns], (F.col("_off") + F.col("_place")).cast("long").alias("rn"), "n_bars")
    message = F.concat(F.lit("not enough data: only "), F.col("n_bars").cast("string"), F.lit(" rows"))
    return good, errors_of(short, message)


def newest_rows(bars: DataFrame, n: int, bucket: str = BUCKET, key: str = "symbol") -> DataFrame:
    """S4 / W13 for any ``n``: the newest ``n`` bars per series, with ``rn_desc`` (1 = newest).

    Only the buckets that hold them are kept, and a bucket is the largest unit that a task
    sorts, so the tail of a series of any length is cut by many tasks.  Rows without a
    time are the oldest.
    """
    profile = series_profile(bars, [], bucket, key).filter(F.col("_after") < n) \
        .select(F.col(key).alias("_key"), F.col("_tb").alias("_bucket"), "_after")
    place = F.row_number().over(Window.partitionBy(key, "_tb").orderBy(F.col("time").desc()))
    tail = with_bucket(bars, bucket).join(profile, F.col(key).eqNullSafe(F.col("_key")) & F.col("_tb").eqNullSafe(F.col("_bucket")))
    return tail.withColumn("rn_desc", (F.col("_after") + place).cast("long")).filter(F.col("rn_desc") <= n).select(*bars.columns, "rn_desc")
