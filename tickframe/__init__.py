"""tickframe: technical analysis of OHLCV price bars as Spark DataFrame jobs.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``).  The bar table is long: ``symbol, time, open, high, low, close,
volume`` for any number of symbols, so three series and three million series
run through the same plan.

Sub-packages
------------
sources    readers of bar tables, candle JSON, the market document (S1-S8)
operators  cleaning, the series layout, windows, recurrences, levels, ranking
functions  column-level helpers: rounding, formatting, labels, prompt text
plans      composed jobs (market document, report tables) and the query registry
"""

from tickframe.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
