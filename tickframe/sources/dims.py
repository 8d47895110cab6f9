"""Constant dimensions of the test tables (S5): index config, universes, sector map.

A job gets its own tables (``plans/job.py``); these serve the registered queries.

The reference keeps three index codes, two symbol lists (the wide one is the
narrow one plus 20 more, one of them repeated) and a sector map as Python
constants.  Here they are small DataFrames with an ordinal column, built from
a rule over the test brands (``Brand#1`` .. ``Brand#25``) so the same rule can
be written in SQL for the oracle.  They are tiny (tens of rows) and fixed in
size, so joins against them are broadcast.

Rules (FIXTURES.md §4):

* ``dim_index``: IX_ALL, IX_TOP, IX_WIDE in that order; each has one index
  series in ``bars_flag`` (A, N, R).
* ``dim_universe``: IX_ALL and IX_TOP hold brands 1-15 (like the two indexes
  that share the large-cap list), IX_WIDE holds brands 1-25 and then brand 7
  again (the duplicated ticker).
* ``dim_sector``: brand n belongs to sector ``n % 8``; remainder 7 has no
  sector; sector 6 has one extra member ``Brand#99`` without bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Index codes with their index series and tab order.
INDEX_ROWS = [("IX_ALL", "A", 1), ("IX_TOP", "N", 2), ("IX_WIDE", "R", 3)]
NARROW_BRANDS = 15
WIDE_BRANDS = 25
REPEATED_BRAND = 7
SECTORS = 7              # sectors 0..6; remainder 7 has none
EXTRA_MEMBER = ("Brand#99", 6)
MOVER_CAP = 30           # the cap that one query passes explicitly (P11)


def values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Constant rows as a local relation: Spark knows its size and may broadcast it."""
    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "\\'") + "'"
    body = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return spark.sql(f"select * from values {body} as t({columns})")


def dim_index(spark: SparkSession) -> DataFrame:
    return values(spark, INDEX_ROWS, "index, ticker, ord")


def dim_universe(spark: SparkSession, dedupe: bool = True) -> DataFrame:
    """Narrow list for two indexes; wide = narrow + 10 more + one repeat.

    With ``dedupe`` the repeated entry keeps its lowest ordinal (N8).
    """
    rows = [(ix, f"Brand#{n}", n) for ix, size in (("IX_ALL", NARROW_BRANDS), ("IX_TOP", NARROW_BRANDS), ("IX_WIDE", WIDE_BRANDS))
            for n in range(1, size + 1)]
    rows.append(("IX_WIDE", f"Brand#{REPEATED_BRAND}", WIDE_BRANDS + 1))
    u = values(spark, rows, "index, symbol, ord")
    return u.groupBy("index", "symbol").agg(F.min("ord").alias("ord")) if dedupe else u


def sector_rows() -> list[tuple[str, int, str]]:
    """``(sector, sector_ord, symbol)`` in map order, from the rule above."""
    rows = [(f"Sector {n % 8}", n % 8, f"Brand#{n}")
            for n in range(1, WIDE_BRANDS + 1) if n % 8 < SECTORS]
    rows.append((f"Sector {EXTRA_MEMBER[1]}", EXTRA_MEMBER[1], EXTRA_MEMBER[0]))
    return sorted(rows, key=lambda r: (r[1], int(r[2].split("#")[1])))


def dim_sector(spark: SparkSession) -> DataFrame:
    """Sector map: ``sector, sector_ord, symbol`` (sector_ord = map order)."""
    return values(spark, sector_rows(), "sector, sector_ord, symbol")


def dim_supplier_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A many-symbol universe from the supplier table, ordered by key."""
    s = spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet").select("s_suppkey")
    return s.select(F.lit("IX_SUPP").alias("index"),
                    F.col("s_suppkey").cast("string").alias("symbol"),
                    F.col("s_suppkey").cast("int").alias("ord"))
