"""Array helpers as DataFrame expressions (no Python runs on executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda s, x: s + x)


def with_running(df: DataFrame, lengths: str, out: str) -> DataFrame:
    """Column ``out``: for each element of array<long> ``lengths`` the sum of those before it.

    Two levels of about sqrt(n) elements each, so a long array costs n * sqrt(n).
    """
    n = F.size(lengths)
    step = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(n, F.lit(1)) - 1) / F.col("_step")).cast("int")),
                         lambda b: _total(F.slice(lengths, b * F.col("_step") + 1, F.col("_step"))))
    before = F.transform("_blocks", lambda x, b: _total(F.slice("_blocks", F.lit(1), b)))
    places = F.transform(lengths, lambda x, i: F.element_at("_before", F.floor(i / F.col("_step")).cast("int") + 1)
                         + _total(F.slice(lengths, F.floor(i / F.col("_step")).cast("int") * F.col("_step") + 1, i % F.col("_step"))))
    return df.withColumn("_step", step).withColumn("_blocks", blocks).withColumn("_before", before) \
        .withColumn(out, places).drop("_step", "_blocks", "_before")
