"""Ingestion, guards, rankings, answers, report tables and the document (edge fixtures)."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from tickframe.functions import labels
from tickframe.functions.text import parse_analysis
from tickframe.operators import clean, rank
from tickframe.plans import market, report
from tickframe.sources import candles, dims

BARS = "symbol string, time date, open double, high double, low double, close double, volume double"
D0 = dt.date(2020, 1, 1)


def series(spark, spec):
    """spec: {symbol: [close, ...]} -> bars (open = high = low = close)."""
    rows = [(s, D0 + dt.timedelta(days=i), c, c, c, c, 1.0)
            for s, cs in spec.items() for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, BARS)


# ------------------------------------------------------------------ ingestion
def test_dirty_candles(spark):
    docs = spark.createDataFrame([
        ("IX", json.dumps({"data": [
            {"tradingDate": "2024-01-02T00:00:00", "open": "10.5", "high": 11, "low": 9, "close": "n/a"},
            {"tradingDate": "2024-01-03", "open": 10, "high": 12, "low": 9, "close": 11, "volume": None},
            {"tradingDate": "2024/01/04", "o": 11, "h": 12, "l": 10, "c": 12, "v": "7"},
            {"tradingDate": "2024-01-04", "o": 11, "h": 12, "l": 10, "c": 12, "v": 7}]})),
        ("IY", json.dumps([{"Date": "01/05/2024", "o": 1, "h": 2, "l": 1, "c": 2}])),
        ("IZ", json.dumps({"t": ["2024-01-06", "2024-01-07"], "c": [3, 4], "o": [3, 4], "h": [3, 4],
                           "l": [3, 4]})),
    ], "symbol string, body string")
    raw = clean.coerce_bars(candles.unwrap_envelope(docs))
    rows = {(r.symbol, str(r.time)): r for r in raw.collect()}
    assert rows[("IX", "2024-01-02")].open == 10.5 and rows[("IX", "2024-01-02")].close is None
    assert rows[("IX", "2024-01-03")].volume == 0.0            # null volume -> 0 (P5)
    assert rows[("IY", "2024-01-05")].volume == 0.0            # missing volume -> 0 (N4)
    assert ("IZ", "2024-01-07") in rows                         # columnar object (S3)
    good, bad = clean.validate_bars(raw)
    reasons = sorted((r.symbol, r.time, r.error) for r in bad.collect())
    assert ("IX", "2024-01-02", "missing price") in reasons
    assert sum(1 for r in reasons if r[2] == "duplicate time") == 2   # 2024/01/04 and 2024-01-04 (N20)
    assert good.count() == 4


def test_stock_candles_epoch_and_scale(spark):
    docs = spark.createDataFrame([
        ("AAA", json.dumps({"data": [{"t": 1704153600, "o": 1.5, "h": 2, "l": 1, "c": 1.75, "v": 3},
                                     {"t": "2024-01-01", "o": 1, "h": 1, "l": 1, "c": 1}]})),
        ("BBB", json.dumps([{"t": 1704153600, "c": 5}])),        # no envelope: ignored (S2)
    ], "symbol string, body string")
    rows = sorted(candles.read_stock_bars(docs).collect(), key=lambda r: r.time)
    assert [str(r.time) for r in rows] == ["2024-01-01", "2024-01-02"]
    assert rows[1].close == 1750.0 and rows[1].open == 1500.0
    assert {r.symbol for r in rows} == {"AAA"}


def test_candle_bars_are_all_kept_by_default(spark):
    days = [str(D0 + dt.timedelta(days=i)) for i in range(450)]
    docs = spark.createDataFrame([("AAA", json.dumps({"data": [{"t": d, "o": 1, "h": 1, "l": 1, "c": 1} for d in days]}))], "symbol string, body string")
    assert candles.read_index_bars(docs).count() == candles.read_stock_bars(docs).count() == 450
    assert candles.read_index_bars(docs, 400).count() == 400 and candles.read_stock_bars(docs, 10).count() == 10


def test_candle_files(spark):
    d = tempfile.mkdtemp(prefix="tf-candles-")
    with open(os.path.join(d, "VNX.json"), "w") as f:
        json.dump({"data": [{"d": "2024-01-02", "c": 1, "o": 1, "h": 1, "l": 1}]}, f)
    docs = candles.read_candle_files(spark, d)
    assert [r.symbol for r in docs.collect()] == ["VNX"]
    assert candles.read_index_bars(docs).count() == 1


def test_scale_if_small_straddle(spark):
    b = spark.createDataFrame([("S", D0, 99.0, 101.0, 98.0, 99.0, 1.0)], BARS)
    r = clean.scale_if_small(b).first()
    assert (r.open, r.high, r.low, r.close) == (99000.0, 101.0, 98000.0, 99000.0)   # N11


def test_history_guard_and_nonempty(spark):
    b = series(spark, {"A": [1.0] * 49, "B": [1.0] * 50})
    good, bad = clean.require_history(b, 50)
    assert {r.symbol for r in good.select("symbol").distinct().collect()} == {"B"}
    assert [r.error for r in bad.collect()] == ["not enough data: only 49 rows"]
    req = spark.createDataFrame([("A",), ("C",)], "symbol string")
    assert [r.symbol for r in clean.require_nonempty(req, b).collect()] == ["C"]


# ------------------------------------------------------------------ rankings
def universe(spark, syms, index="IX"):
    return spark.createDataFrame([(index, s, i + 1) for i, s in enumerate(syms)],
                                 "index string, symbol string, ord int")


def movers(spark, closes):
    spec = {s: [100.0, c] for s, c in closes.items()}
    m = rank.top_movers(universe(spark, list(closes)), series(spark, spec))
    out = {}
    for r in m.orderBy("side", "rank").collect():
        out.setdefault(r.side, []).append(r.symbol)
    return out


def test_movers_ties_and_overlap(spark):
    m = movers(spark, {"A": 101.0, "B": 102.0, "C": 101.0, "D": 99.0, "E": 99.0})
    assert m["gainer"] == ["B", "A", "C"]          # ties in list order
    assert m["loser"] == ["E", "D", "C"]           # ties in reverse list order; overlap below 6
    m2 = movers(spark, {"A": 101.0, "B": 99.0})
    assert m2["gainer"] == ["A", "B"] and m2["loser"] == ["B", "A"]


def test_movers_cap_and_two_bars(spark):
    syms = [f"S{i:02d}" for i in range(40)]
    spec = {s: [100.0, 100.0 + i] for i, s in enumerate(syms)}
    spec["S00"] = [100.0]                           # one bar: skipped (P10)
    m = rank.top_movers(universe(spark, syms), series(spark, spec)).filter("side = 'gainer'")
    assert [r.symbol for r in m.orderBy("rank").collect()] == ["S39", "S38", "S37"]   # the whole universe
    m = rank.top_movers(universe(spark, syms), series(spark, spec), cap=30).filter("side = 'gainer'")
    assert [r.symbol for r in m.orderBy("rank").collect()] == ["S29", "S28", "S27"]   # an explicit cap (P11)


def test_sector_performance_and_empty_universe(spark):
    sec = spark.createDataFrame([("Up", 0, "A"), ("Up", 0, "B"), ("Down", 1, "C"), ("None", 2, "Z")],
                                "sector string, sector_ord int, symbol string")
    idx = spark.createDataFrame([("IX", "T", 1), ("EMPTY", "T", 2)], "index string, ticker string, ord int")
    uni = universe(spark, ["A", "B", "C"])
    members = rank.sector_members(idx, uni, sec)
    stock = series(spark, {"A": [100.0, 110.0], "B": [100.0, 100.0], "C": [100.0, 90.0]})
    res = {(r["index"], r.sector): r for r in rank.sector_performance(members, stock).collect()}
    assert res[("IX", "Up")].change_pct == 5.0 and res[("IX", "Up")].lead_rank == 1
    assert res[("IX", "Down")].lag_rank == 1
    assert ("IX", "None") not in res                 # no member with bars: omitted
    assert ("EMPTY", "Up") in res                    # empty universe: no filter (J3)


# ------------------------------------------------------------------ answers, labels
GOOD = {"summary": "s", "market_description": "", "support_resistance": {"comment": "near pivot"},
        "timeframe_analysis": {"short_term": {"trend": "Tăng", "strength": "Mạnh", "signals": ["a", "b"],
                                              "comment": "c"},
                               "long_term": {"trend": "x", "strength": "", "signals": []}},
        "scenarios": [{"name": "Kịch bản tăng (Bull)", "probability": 40},
                      {"name": "Kịch bản GIẢM"}, {"name": "Sideways", "probability": 25}],
        "key_levels": {"immediate_resistance": 1250.5, "strong_support": 1100},
        "sentiment": "Tích cực", "recommendation": "hold"}


def test_parse_answers(spark):
    g = json.dumps(GOOD, ensure_ascii=False)
    df = spark.createDataFrame([(1, g), (2, "```json\n" + g + "\n```"), (3, "```" + g), (4, g[:50]),
                                (5, g + " tail"), (6, "x" * 900)], "id int, raw string")
    out = {r.id: r.p for r in df.select("id", parse_analysis("raw").alias("p")).collect()}
    assert out[1].analysis.summary == "s" and out[2].analysis.key_levels.strong_support == 1100.0
    for i in (3, 4, 5, 6):
        assert out[i].analysis is None and out[i].error == "JSON parse error"
    assert out[3].raw.startswith("```") and out[6].raw == "x" * 900      # whole, not cut


def test_labels(spark):
    df = spark.createDataFrame([(None, 75.0, -1.0), (50.0, 25.0, 2.0)], "a double, b double, h double")
    r = df.select(labels.rsi_status("a").alias("d"), labels.rsi_status("a", strict=True).alias("s"),
                  labels.rsi_status("b").alias("b"), labels.macd_status("h").alias("m")).collect()
    assert (r[0].d, r[0].s, r[0].b, r[0].m) == ("oversold", None, "overbought", "negative")   # N6
    assert (r[1].d, r[1].s, r[1].b, r[1].m) == ("neutral", "neutral", "oversold", "positive")


# ------------------------------------------------------------------ document and report
def market_fixture(spark):
    idx = spark.createDataFrame([("IX1", "I1", 1), ("IX2", "I2", 2), ("IX3", "I3", 3)],
                                "index string, ticker string, ord int")
    index_bars = series(spark, {"I1": [1000.0 + (i % 9) for i in range(80)], "I2": [5.0] * 20})
    stock = series(spark, {"A": [100.0, 101.0], "B": [100.0, 99.0], "C": [50.0, 50.0]})
    uni = universe(spark, ["A", "B", "C"], "IX1").unionByName(universe(spark, ["A"], "IX3"))
    sec = spark.createDataFrame([("S1", 0, "A"), ("S2", 1, "B")], "sector string, sector_ord int, symbol string")
    return market.market_tables(index_bars, stock, idx, uni, sec)


def test_document_errors_and_roundtrip(spark):
    m = market_fixture(spark)
    doc = {r["index"]: r for r in m.document().collect()}
    assert doc["IX1"].error is None and len(doc["IX1"].ohlcv) == 80
    assert doc["IX1"].snapshot.close == 1000.0 + (79 % 9)
    assert doc["IX2"].error.startswith("not enough data") and doc["IX2"].snapshot is None
    assert doc["IX3"].error == "no data for I3"
    assert [g.symbol for g in doc["IX1"].movers.top_gainers] == ["A", "C", "B"]
    d = tempfile.mkdtemp(prefix="tf-doc-")
    market.write_document(m.document(), d + "/doc")
    back = market.read_document(spark, d + "/doc", m.document().schema)
    assert back.count() == 3
    one = json.loads("{" + ",".join(r.entry for r in market.document_json(m.document()).collect()) + "}")
    assert set(one) == {"IX1", "IX2", "IX3"} and one["IX2"]["error"].startswith("not enough data")
    errors = report.report_errors(m.indexes, m.errors).orderBy("ord").collect()
    assert [(r["index"], r.error) for r in errors] == [("IX2", "not enough data: only 20 rows"), ("IX3", "no data for I3")]
    assert {r["index"] for r in m.reported(m.indexes).collect()} == {"IX1"}


def test_report_sections_with_analysis(spark):
    m = market_fixture(spark)
    answers = spark.createDataFrame([("IX1", json.dumps(GOOD, ensure_ascii=False)), ("IX2", "{}")],
                                    "index string, raw string")
    da = report.analyses(m.indexes, m.errors, answers)
    summ = report.report_summary(da).collect()
    assert len(summ) == 1 and summ[0].description == "" and summ[0].sentiment == "↑ Tích cực"
    tf = report.report_timeframes(da).orderBy("pos", "signal_pos").collect()
    assert [(r.frame, r.signal) for r in tf] == [("short", "a"), ("short", "b"), ("long", None)]
    assert tf[0].tone == "bull" and tf[0].badge == "Tăng · Mạnh" and tf[2].badge == "x"
    sc = report.report_scenarios(da).orderBy("pos").collect()
    assert [(r.tone, r.probability) for r in sc] == [("bull", 40.0), ("bear", 0.0), ("neutral", 25.0)]
    lv = {r.level: r for r in report.report_levels(m.snapshot, da).filter("index = 'IX1'").collect()}
    assert lv["immediate_resistance"].text == "1,250.50" and lv["strong_resistance"].text == "—"
    assert [r.comment for r in report.report_levels_comment(da).collect()] == ["near pivot"]
    ana = {r["index"]: r for r in da.collect()}
    assert ana["IX2"].error.startswith("not enough data")      # P15: failed upstream, not analysed
    mv = report.report_movers(m.movers, m.sectors, m.reported(m.indexes)).filter("index = 'IX1'").collect()
    assert ("lagging", 0, "no data") not in [(r.list, r.rank, r.name) for r in mv]
    assert len(report.report_indicators(m.snapshot).collect()) == 17
    assert report.view_range(m.ohlcv, 30).count() == 30
    assert report.build_prompt(m.snapshot, m.movers, m.sectors).count() == 1


def test_end_to_end_job(spark):
    from tickframe.plans import job
    from tickframe.sources import fixtures
    from tickframe.sources.fixtures import bars
    from tests.conftest import SF001
    out = tempfile.mkdtemp(prefix="tf-job-")
    answers = spark.createDataFrame([("FIRST", json.dumps(GOOD, ensure_ascii=False)),
                                     ("SECOND", "not json")], "index string, raw string")
    # tables of its own: suppliers as stocks, return flags as index series
    indexes = dims.values(spark, [("FIRST", "A", 1), ("SECOND", "N", 2), ("ABSENT", "Z", 3)], "index, ticker, ord")
    uni = dims.values(spark, [("FIRST", str(k), k) for k in range(1, 9)] + [("SECOND", "3", 1), ("SECOND", "4", 2)], "index, symbol, ord")
    sec = dims.values(spark, [(f"Sector {k % 3}", k % 3, str(k)) for k in range(1, 9)], "sector, sector_ord, symbol")
    stock = fixtures.dirty(bars(spark, SF001, "supp"))
    paths = job.run(spark, bars(spark, SF001, "flag"), stock, indexes, uni, sec, out, answers,
                    settings=market.MarketSettings(export_bars=100, mover_cap=5))
    read = lambda name: spark.read.parquet(paths[name])
    assert read("prompts").count() == 2 and read("report/indicators").count() == 34
    assert read("report/summary").count() == 1 and read("report/series").filter("points = 100").count() == 2
    assert [(r["index"], r.error) for r in read("errors").collect()] == [("ABSENT", "no data for Z")] == [
        (r["index"], r.error) for r in read("report/errors").collect()]
    assert {r.kind for r in read("rejected").collect()} == {"stock"}
    assert {r.symbol for r in read("market/movers").filter("index = 'FIRST'").collect()} <= {"1", "2", "3", "4", "5"}
    errs = {r["index"]: r.error for r in read("analysis").collect()}
    assert errs == {"FIRST": None, "SECOND": "JSON parse error", "ABSENT": "no data for Z"}


def test_missing_document_and_generated_text(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("index", T.StringType()), T.StructField("generated", T.TimestampType())])
    assert market.read_document(spark, tempfile.mkdtemp(prefix="tf-none-") + "/absent", schema).count() == 0
    df = spark.createDataFrame([("IX", dt.datetime(2024, 5, 6, 17, 8, 9))], schema)
    assert df.select(market.generated_text().alias("g")).first().g == "2024-05-06 17:08"


def test_fmt_chg(spark):
    from tickframe.functions.text import fmt_chg
    df = spark.createDataFrame([(1.234,), (-0.5,), (0.0,), (None,)], "v double")
    got = [(r.c.tone, r.c.text) for r in df.select(fmt_chg("v").alias("c")).collect()]
    assert got == [("pos", "+1.23%"), ("neg", "-0.50%"), ("flat", "0.00%"), (None, "—")]


def test_non_finite_prices_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    b = spark.createDataFrame([("S", D0 + dt.timedelta(days=i), 1.0, 2.0, 1.0, c, v) for i, (c, v) in enumerate(
        [(1.5, 1.0), (nan, 1.0), (inf, 1.0), (None, 1.0), (1.5, nan)])], BARS)
    good, bad = clean.validate_bars(b)
    assert sorted(r.volume for r in good.collect()) == [0.0, 1.0]
    assert [r.error for r in bad.collect()] == ["missing price"] * 3
    scaled = {str(r.time): r.close for r in clean.scale_if_small(b).collect()}
    assert scaled["2020-01-01"] == 1500.0                      # a NaN doesn't switch the rescale off
    assert clean.scale_if_small(b, threshold=None) is b


def test_a_faulty_newest_bar_ranks_nobody(spark):
    b = series(spark, {"A": [100.0, 101.0], "B": [100.0, 99.0], "C": [100.0, 103.0]}).unionAll(
        spark.createDataFrame([("C", D0 + dt.timedelta(days=2), None, None, None, None, 1.0)], BARS))
    m = rank.top_movers(universe(spark, ["A", "B", "C"]), b).filter("side = 'loser'").orderBy("rank").collect()
    assert [r.symbol for r in m] == ["B", "A"]                 # unchecked: the null percent is left out
    m = rank.top_movers(universe(spark, ["A", "B", "C"]), clean.validate_bars(b)[0]).filter("side = 'loser'").orderBy("rank").collect()
    assert [r.symbol for r in m] == ["B", "A", "C"]


def test_answers_keep_their_good_parts(spark):
    raw = [(1, '{"scenarios":[{"name":"a","probability":"40%"},{"probability":12.5}],"key_levels":{"immediate_support":"1,250"},'
               '"support_resistance":"plain","summary":"s"}'), (2, '{"summary":"s"} {"x":1}'), (3, '{"a":1}],[{}'), (4, '{"a":1}},{"x":{}'), (5, "[{}]")]
    out = {r.id: r.p for r in spark.createDataFrame(raw, "id int, raw string").select("id", parse_analysis("raw").alias("p")).collect()}
    a = out[1].analysis
    assert [s.probability for s in a.scenarios] == [40.0, 12.5] and a.key_levels.immediate_support == 1250.0
    assert a.support_resistance is None and a.summary == "s" and out[1].error is None
    assert all(out[k].analysis is None and out[k].raw == raw[k - 1][1] for k in (2, 3, 4, 5))


def test_epochs_out_of_range(spark):
    df = spark.createDataFrame([("1704153600",), ("1704153600000",), ("1e20",), ("NaN",), ("2024-01-02",)], "t string")
    got = [str(r.d) for r in df.select(clean.epoch_or_date(F.col("t")).alias("d")).collect()]
    assert got == ["2024-01-02", "None", "None", "None", "2024-01-02"]
