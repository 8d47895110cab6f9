"""Every registered query against its DuckDB oracle (the driver's gate) at sf0.01."""

import pytest

from tests.conftest import SF01
from tests.harness import compare, duck
from tickframe.plans.queries import oracle_sql, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF01)
    assert name in oracle_sql(), "a query without SQL"
    ok, msg = compare(df, con, oracle_sql()[name])
    spark.catalog.clearCache()
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) == 25
    assert "fibo_618" in df.columns
