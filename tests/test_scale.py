"""Plans and fixtures of the parts that must hold at scale."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tickframe.operators import clean, profile, rank
from tickframe.operators.indicators import indicators
from tickframe.plans import market, report
from tickframe.sources.fixtures import bars

BAR = "symbol string, time date, open double, high double, low double, close double, volume double"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def series(spark, symbol, closes):
    rows = [(symbol, k, float(c)) for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, k int, close double").select(
        "symbol", F.expr("date_add(date'2000-01-01', k)").alias("time"), F.col("close").alias("open"), (F.col("close") + 1).alias("high"),
        (F.col("close") - 1).alias("low"), "close", F.lit(1.0).alias("volume"))


def test_indicators_read_twice_and_move_to_blocks_once(spark):
    p = plan_of(indicators(bars(spark, SF001, "brand")))
    assert len(re.findall(r"FileScan parquet \[l_", p)) == 2
    # the layout is made once; the narrow block totals are read off the same exchange
    assert p.count("Generate explode") == 1 and re.search(r"ReusedExchange \[symbol#\d+, time#\d+, open", p)


def test_averages_forget_a_huge_price(spark):
    closes = [100 + k % 7 for k in range(700)]
    spiked = closes[:300] + [1e17] + closes[301:]
    columns = ["ma5", "ma10", "ma20", "ma50", "ma100", "ma200"]
    a, b = ({r.rn: r for r in indicators(series(spark, "S", c)).select("rn", *columns).collect()} for c in (closes, spiked))
    for rn in range(1, 701):
        for c in columns:
            p = int(c[2:])
            if rn < p:
                assert b[rn][c] is None
            elif not rn - p < 301 <= rn:
                assert a[rn][c] == b[rn][c] == pytest.approx(sum(closes[rn - p:rn]) / p, abs=1e-9)


@pytest.mark.parametrize("n", [1, 45, 1000, 5000])
def test_tails_by_profile(spark, n):
    b = series(spark, "A", range(2500)).union(series(spark, "B", range(40)))
    got = sorted((r.symbol, r.rn_desc, r.close) for r in profile.newest_rows(b, n).collect())
    assert got == sorted([("A", k + 1, 2499.0 - k) for k in range(min(n, 2500))] + [("B", k + 1, 39.0 - k) for k in range(min(n, 40))])


def test_guard_rescale_and_row_index_share_one_profile(spark):
    b = series(spark, "A", [99.0 - k % 5 for k in range(80)]).union(series(spark, "B", [5.0] * 20)).union(series(spark, "C", [101.0] * 60))
    good, short = profile.checked_series(b, 50)
    rows = {(r.symbol, r.rn): r for r in good.collect()}
    assert {s for s, _ in rows} == {"A", "C"} and rows["A", 1].n_bars == 80
    # one column of A passes 100 with the high of 100, so it alone is not rescaled
    assert rows["A", 1].close == 99000.0 and rows["A", 1].high == 100.0 and rows["C", 60].low == 100.0
    assert [(r.symbol, r.error) for r in short.collect()] == [("B", "not enough data: only 20 rows")]
    p = plan_of(good)
    counted = [line for line in p.splitlines() if re.search(r"HashAggregate\(keys=\[symbol#\d+, _tb#\d+\], functions=\[count", line)]
    assert len(counted) == 1
    plain = clean.scale_if_small(clean.require_history(b, 50)[0])
    assert sorted(map(tuple, good.select(*b.columns).collect())) == sorted(map(tuple, plain.select(*b.columns).collect()))


def test_each_side_of_the_movers_is_limited_before_the_shuffle(spark):
    b = series(spark, "A", [1, 2]).union(series(spark, "B", [2, 1])).union(series(spark, "C", [4, 4])).union(series(spark, "D", [2, 3]))
    universe = spark.createDataFrame([("IX", s, k) for k, s in enumerate("ABCD")], "index string, symbol string, ord int")
    out = rank.top_movers(universe, b, k=2)
    assert sorted((r.side, r.rank, r.symbol) for r in out.collect()) == [("gainer", 1, "A"), ("gainer", 2, "D"), ("loser", 1, "B"), ("loser", 2, "C")]
    p = plan_of(out)
    limits = [line for line in p.splitlines() if "WindowGroupLimit [index#" in line]
    assert sum("Partial" in line for line in limits) == 2 and sum("Final" in line for line in limits) == 2


def test_hot_duplicates_are_counted_not_sorted(spark):
    one = series(spark, "A", range(50))
    hot = spark.range(20_000).select(F.lit("A").alias("symbol"), F.expr("date'2000-01-05'").alias("time"), *[F.lit(7.0).alias(c) for c in ("open", "high", "low", "close")],
                                     F.lit(1.0).alias("volume"))
    odd = spark.createDataFrame([("A", None, 1.0, 1.0, 1.0, 1.0, 1.0), (None, None, 1.0, 1.0, 1.0, 1.0, 1.0)], BAR)
    good, bad = clean.validate_bars(one.union(hot).union(odd))
    assert good.count() == 49 and bad.filter("error = 'duplicate time'").count() == 20_001 and bad.filter("error = 'missing time'").count() == 2
    p = plan_of(good)
    assert "Window" not in p and re.search(r"HashAggregate\(keys=.*partial_count", p)
    twice = spark.createDataFrame([(None, 1.0)] * 2 + [("B", 2.0)], "symbol string, x double").select(
        "symbol", F.expr("date'2000-01-05'").alias("time"), *[F.col("x").alias(c) for c in ("open", "high", "low", "close", "volume")])
    assert [r.symbol for r in clean.validate_bars(twice)[0].collect()] == ["B"]


def test_the_latest_answer_counts(spark):
    indexes = spark.createDataFrame([("A",), ("B",), ("C",)], "index string")
    none = spark.createDataFrame([], "index string, error string")
    rows = [("A", 2, '{"summary": "new"}'), ("A", 1, '{"summary": "old"}'), ("A", None, '{"summary": "undated"}'), ("B", 1, '{"summary": "x"}'), ("B", 1, '{"summary": "y"}')]
    answers = spark.createDataFrame(rows, "index string, at int, raw string")
    got = {r["index"]: r.summary for r in report.analyses(indexes, none, answers, order="at").select("index", "analysis.summary").collect()}
    assert got == {"A": "new", "B": "y", "C": None}
    assert report.analyses(indexes, none, answers).count() == 3


def test_documents_are_replaced_by_index_and_damage_is_reported(spark):
    schema = "index string, ord int, symbols array<string>, error string"
    path = tempfile.mkdtemp(prefix="tf-doc-") + "/doc"
    market.write_document(spark.createDataFrame([("A/1", 1, ["x"], None), ("B", 2, ["y"], None)], schema), path)
    market.write_document(spark.createDataFrame([("B", 2, ["z"], None), ("007", 3, [], "no data")], schema), path)
    t = spark.createDataFrame([], schema).schema

    def read(*which):
        return {r["index"]: (r.ord, r.symbols, r.error) for r in market.read_document(spark, path, t, list(which) or None).collect()}
    assert read() == {"A/1": (1, ["x"], None), "B": (2, ["z"], None), "007": (3, [], "no data")}
    assert read("B") == {"B": (2, ["z"], None)}
    assert "PartitionFilters: [isnotnull(index" in market.read_document(spark, path, t, ["B"])._jdf.queryExecution().toString() \
        or "PartitionFilters: [index" in market.read_document(spark, path, t, ["B"])._jdf.queryExecution().toString()
    with open(f"{path}/index=B/part-damaged.json", "w") as f:
        f.write('{"ord": 2, "symbols": ["z"\n')
    assert sorted((r["index"], r.error) for r in market.read_document(spark, path, t).filter("error is not null").collect()) == [("007", "no data"), ("B", "damaged document")]


def test_queries_of_few_columns_share_the_scans_too(spark):
    from tickframe.plans.queries import queries
    p = plan_of(queries()["indicators_supp"](spark, SF001))
    assert len(re.findall(r"FileScan parquet \[l_", p)) == 2


def test_answers_are_parsed_by_few_expressions(spark):
    from tickframe.functions.text import parse_analysis
    raw = ' \n```json\n{"summary": "s", "key_levels": {"strong_support": "1,5%"}}\n``` \t'
    df = spark.createDataFrame([(raw,), ("[1]",), (None,)], "raw string")
    good, bad, none = (r.p for r in df.select(parse_analysis("raw").alias("p")).collect())
    assert (good.analysis.summary, good.analysis.key_levels.strong_support, good.error) == ("s", 15.0, None)
    assert (bad.analysis, bad.error, bad.raw) == (None, "JSON parse error", "[1]") and none.analysis is None
    # once for a filter and once for the columns, not for every field
    shown = df.select(parse_analysis("raw").alias("p")).filter("coalesce(p.analysis.summary, '') <> ''").select("p.analysis.summary", "p.analysis.sentiment")
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("parseJson") < 10


def test_stock_candles_are_read_as_one_map(spark):
    from tickframe.sources import candles
    docs = spark.createDataFrame([("A", '{"data": [{"t": "2020-01-02", "o": 1, "h": "2", "l": 1.5, "c": {"x": 1}, "Date": "z"}, null, 3]}')], "symbol string, body string")
    raw = candles.unwrap_envelope(docs, envelope_only=True)
    rows = [(r.t, r.o, r.h, r.l, r.c, r.date, r.time) for r in raw.collect()]
    assert rows == [("2020-01-02", "1", "2", "1.5", '{"x":1}', "z", None), *[(None,) * 7] * 2]
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("variant_get") < 4
