"""Series layout: a dense row index per symbol and fixed row blocks.

Nothing downstream partitions by ``symbol`` alone.  A symbol may hold a third
of all bars, so the layout spreads every series over bounded units:

1. ``with_row_index`` numbers the bars of each symbol 1..n by time.  The rows
   are counted per ``(symbol, month)`` (partial aggregation), the month counts
   are prefix-summed per symbol (a table of one row per symbol-month), and the
   offset is added to a ``row_number`` taken inside ``(symbol, month)``.  The
   largest task is one symbol-month, never one symbol.
2. ``with_blocks`` cuts each series into blocks of ``BLOCK`` rows.  The last
   ``lookback`` rows before a block are copied into it as *halo* rows, so every
   finite frame (at most ``lookback`` preceding rows) and every recurrence (see
   ``recurrence.py``; the RSI's also takes a carry) can be evaluated inside ``(symbol, blk)``.  Halo rows are
   dropped after the windows ran.  In a long series the copies cost
   ``lookback / BLOCK`` extra rows; a series of one block has none.

All windows of the indicators run on the one ``(symbol, blk)`` shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators.profile import series_profile, with_bucket

BLOCK = 2048          # rows per block
LOOKBACK = 640        # covers the 252-bar high / low; (25/27)^640 < 1e-21 for the recurrences


def with_row_index(bars: DataFrame, bucket: str = "MM", key: str = "symbol") -> DataFrame:
    """Add ``rn`` (1-based position by time within the symbol) and ``n_bars``.

    ``bucket`` is a ``trunc`` unit; the default month keeps the per-task unit
    small for daily or hourly bars.
    """
    offsets = series_profile(bars, [], bucket, key).select(key, "_tb", "_off", "n_bars")
    place = F.row_number().over(Window.partitionBy(key, "_tb").orderBy("time"))
    return (with_bucket(bars, bucket).withColumn("_lrn", place)
            .join(offsets, [key, "_tb"])
            .withColumn("rn", (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_tb", "_lrn", "_off"))


def with_blocks(indexed: DataFrame, lookback: int = LOOKBACK, block: int = BLOCK) -> DataFrame:
    """Assign ``blk`` and replicate halo rows; ``_halo`` marks the copies."""
    own = F.expr(f"(rn - 1) div {block}")
    homes = F.expr(f"sequence((rn - 1) div {block}, least((rn - 1 + {lookback}) div {block}, (n_bars - 1) div {block}))")
    return (indexed.withColumn("_own", own)
            .withColumn("blk", F.explode(homes))
            .withColumn("_halo", F.col("blk") != F.col("_own"))
            .drop("_own"))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_halo")

