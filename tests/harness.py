"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows after sorting columns by name.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(v)   # NaN is no null
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(row[i]) for i in idx) for row in rel.fetchall()]


def compare(spark_df, con, sql, show=5):
    sc, sr = rows_of_spark(spark_df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    a, b = Counter(sr), Counter(dr)
    if a == b:
        return True, f"{len(sr)} rows match"
    only_s = list((a - b).elements())[:show]
    only_d = list((b - a).elements())[:show]
    n = sum((a - b).values())
    return False, f"{n} rows differ; cols={sc}\n spark-only={only_s}\n duck-only={only_d}"
