"""Indicators against hand-written sequential definitions and edge fixtures."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tests.harness import compare, duck
from tickframe.operators.indicators import INDICATOR_COLUMNS, indicators
from tickframe.operators.layout import drop_halo, with_blocks, with_row_index
from tickframe.operators.levels import snapshot
from tickframe.operators.recurrence import affine_scan, ema_spec
from tickframe.functions.numeric import rnd
from tickframe.plans import oracle_sql as O
from tickframe.sources.fixtures import bars, time_text

SCHEMA = "symbol string, time date, open double, high double, low double, close double, volume double"
D0 = dt.date(2020, 1, 1)


def make(spark, series, spread=1.0):
    """series: {symbol: [close, ...]} -> bars with high = close + spread, low = close - spread."""
    rows = []
    for sym, closes in series.items():
        for i, c in enumerate(closes):
            rows.append((sym, D0 + dt.timedelta(days=i), c, c + spread, c - spread, c, 100.0 + i))
    return spark.createDataFrame(rows, SCHEMA)


# ------------------------------------------------------------ sequential definitions
def ema(xs, span):
    a, out, y = 2.0 / (span + 1), [], None
    for x in xs:
        y = x if y is None else a * x + (1 - a) * y
        out.append(y)
    return out


def rma(xs, p):
    """Wilder smoothing over the non-null values (None stays None)."""
    valid = [(i, x) for i, x in enumerate(xs) if x is not None]
    out = [None] * len(xs)
    if len(valid) < p:
        return out
    y = sum(x for _, x in valid[:p]) / p
    out[valid[p - 1][0]] = y
    for i, x in valid[p:]:
        y = (y * (p - 1) + x) / p
        out[i] = y
    return out


def rolling(xs, p, fn):
    return [fn(xs[i - p + 1:i + 1]) if i >= p - 1 else None for i in range(len(xs))]


def reference(closes):
    h = [c + 1 for c in closes]
    lo = [c - 1 for c in closes]
    pc = [None] + closes[:-1]
    tr = [max(v for v in (h[i] - lo[i], None if pc[i] is None else abs(h[i] - pc[i]),
                          None if pc[i] is None else abs(lo[i] - pc[i])) if v is not None)
          for i in range(len(closes))]
    delta = [None if p is None else c - p for c, p in zip(closes, pc)]
    gain = [None if d is None else max(d, 0.0) for d in delta]
    loss = [None if d is None else max(-d, 0.0) for d in delta]
    ag, al = rma(gain, 14), rma(loss, 14)
    rsi = [None if g is None or l is None or l == 0 else 100 - 100 / (1 + g / l) for g, l in zip(ag, al)]
    e12, e26 = ema(closes, 12), ema(closes, 26)
    macd = [a - b for a, b in zip(e12, e26)]
    sig = ema(macd, 9)
    mean = lambda w: sum(w) / len(w)
    return {"ma5": rolling(closes, 5, mean), "ma200": rolling(closes, 200, mean),
            "atr14": rma(tr, 14), "rsi14": rsi, "macd": macd, "macd_signal": sig,
            "macd_hist": [m - s for m, s in zip(macd, sig)]}


def closes_of(n, seed):
    return [100.0 + 10 * math.sin(i * 0.37 + seed) + (i % 7) * 0.5 - seed for i in range(n)]


@pytest.mark.parametrize("block", [256, 2048])
def test_matches_sequential_definitions(spark, block):
    """Several blocks (block=256, 700 bars) exercise halos and cross-block carries."""
    series = {"A": closes_of(700, 1), "B": closes_of(30, 2), "C": closes_of(260, 3)}
    got = indicators(make(spark, series), block=block).orderBy("symbol", "rn").collect()
    by_sym = {}
    for r in got:
        by_sym.setdefault(r.symbol, []).append(r)
    for sym, closes in series.items():
        ref = reference(closes)
        rows = by_sym[sym]
        assert [r.rn for r in rows] == list(range(1, len(closes) + 1))
        for col, vals in ref.items():
            for r, v in zip(rows, vals):
                g = r[col]
                if v is None:
                    assert g is None, (sym, col, r.rn, g)
                else:
                    assert g is not None and abs(g - v) <= 1e-9 * max(1.0, abs(v)), (sym, col, r.rn, g, v)


@pytest.mark.parametrize("block", [256, 2048])
def test_rsi_outlasts_flat_and_rising_stretches(spark, block):
    """50 moving bars, then 3 000 flat, rising or falling ones: the averages fade, their ratio doesn't."""
    moving = closes_of(50, 1)
    series = {"F": moving + [moving[-1]] * 3000, "R": moving + [moving[-1] + i for i in range(1, 3001)],
              "D": moving + [moving[-1] - i / 64 for i in range(1, 3001)]}
    rows = indicators(make(spark, series), block=block).select("symbol", "rn", "rsi14").collect()
    got = {(r.symbol, r.rn): r.rsi14 for r in rows}
    for sym, closes in series.items():
        for i, v in enumerate(reference(closes)["rsi14"], 1):
            g = got[sym, i]
            assert (g is None) == (v is None) and (v is None or abs(g - v) <= 1e-9 * max(1.0, abs(v))), (sym, i, g, v)


def test_affine_scan_small_blocks(spark):
    """The scan with tiny blocks and a halo of many blocks equals the recursion."""
    xs = [float((i * 37) % 11) for i in range(1, 58)]
    df = spark.createDataFrame([("s", i + 1, x) for i, x in enumerate(xs)], "symbol string, rn long, x double")
    df = with_blocks(df.withColumn("n_bars", F.lit(len(xs)).cast("long")), 64, 4)
    out = drop_halo(affine_scan(df, [ema_spec("e", "x", 3)], block=4, lookback=64)).orderBy("rn").collect()
    assert [r.rn for r in out] == list(range(1, len(xs) + 1))
    ref = ema(xs, 3)
    assert all(abs(r.e - v) < 1e-9 for r, v in zip(out, ref))


def test_many_blocks_against_oracle(spark):
    """Brand series at sf0.01 (up to 1 700 bars) in 256-row blocks vs the DuckDB recursion."""
    ind = indicators(bars(spark, SF01, "brand"), block=256)
    out = ind.select("symbol", time_text().alias("time"), "rn",
                     *[rnd(c, 4).alias(c) for c in INDICATOR_COLUMNS])
    sql = O.with_recursive(O.indicator_ctes("brand"),
                           "select symbol, cast(time as varchar) as time, rn, "
                           + ", ".join(f"{O.r(c)} as {c}" for c in INDICATOR_COLUMNS) + " from ind")
    ok, msg = compare(out, duck(SF01), sql)
    assert ok, msg


def test_row_index_is_dense_and_shuffle_invariant(spark):
    b = bars(spark, SF01, "hour")
    a = {(r.symbol, str(r.time)): r.rn for r in with_row_index(b).collect()}
    c = {(r.symbol, str(r.time)): r.rn for r in with_row_index(b.repartition(3).sortWithinPartitions(F.rand(7))).collect()}
    assert a == c
    per = {}
    for (s, _), rn in a.items():
        per.setdefault(s, []).append(rn)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per.values())


# ------------------------------------------------------------------ edge fixtures
def last_row(spark, closes, spread=1.0):
    return indicators(make(spark, {"X": closes}, spread)).orderBy(F.col("rn").desc()).first()


def test_flat_series(spark):
    r = last_row(spark, [50.0] * 60, spread=0.0)
    assert r.bb_upper == r.bb_mid == r.bb_lower == 50.0
    assert r.stoch_k is None and r.rsi14 is None


def test_rising_and_falling(spark):
    assert last_row(spark, [10.0 + i for i in range(60)]).rsi14 is None      # loss average 0 (N5)
    rows = indicators(make(spark, {"X": [100.0 - i for i in range(60)]})).orderBy("rn").collect()
    assert rows[13].rsi14 is None and rows[14].rsi14 == 0.0                   # first value at row 14


@pytest.mark.parametrize("n", [1, 2, 13, 14, 15, 49, 50])
def test_short_series_null_prefixes(spark, n):
    rows = indicators(make(spark, {"X": closes_of(n, 0)})).orderBy("rn").collect()
    assert len(rows) == n
    assert all(r.ma20 is None for r in rows[:19])
    assert all(r.atr14 is None for r in rows[:13]) and (n < 14 or rows[13].atr14 is not None)
    assert all(r.rsi14 is None for r in rows[:14])
    assert rows[0].macd == 0.0 and rows[0].macd_signal == 0.0
    s = snapshot(indicators(make(spark, {"X": closes_of(n, 0)}))).first()
    if n == 1:
        assert s.change == 0.0 and s.change_pct == 0.0


def test_zero_previous_close(spark):
    s = snapshot(indicators(make(spark, {"X": [5.0, 0.0, 3.0]}))).first()
    assert s.change == 3.0 and s.change_pct == 0.0


def test_invariants(spark):
    ind = indicators(bars(spark, SF01, "brand"))
    bad = ind.filter(
        (F.col("bb_lower") > F.col("bb_mid") + 1e-9) | (F.col("bb_mid") > F.col("bb_upper") + 1e-9)
        | (F.col("stoch_k") < -1e-9) | (F.col("stoch_k") > 100 + 1e-9)
        | (F.col("rsi14") < -1e-9) | (F.col("rsi14") > 100 + 1e-9)
        | (F.abs(F.col("macd_hist") - (F.col("macd") - F.col("macd_signal"))) > 1e-9)).count()
    assert bad == 0
    snap = snapshot(ind).collect()
    for s in snap:
        assert s.fibo_236 >= s.fibo_382 >= s.fibo_500 >= s.fibo_618 >= s.fibo_786
        assert s.hi52 >= s.lo52
        if s.low <= s.close <= s.high:
            assert s.s3 <= s.s2 <= s.s1 <= s.pivot <= s.r1 <= s.r2 <= s.r3


def test_adding_a_symbol_changes_nothing_else(spark):
    base = {"A": closes_of(300, 1)}
    more = dict(base, B=closes_of(120, 5))
    a = indicators(make(spark, base)).filter("symbol = 'A'").orderBy("rn").collect()
    b = indicators(make(spark, more)).filter("symbol = 'A'").orderBy("rn").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b]


def test_same_answers_at_one_and_many_partitions(spark):
    """SURVEY §5: results do not depend on the number of shuffle partitions."""
    def run():
        ind = indicators(bars(spark, SF01, "hour"))
        return sorted(tuple(r) for r in ind.select("symbol", "rn", *[rnd(c, 6).alias(c) for c in INDICATOR_COLUMNS]).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = run()
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_long_series_is_split_into_bounded_blocks(spark):
    """A hot symbol is spread over (symbol, blk) groups of at most BLOCK + LOOKBACK rows."""
    from tickframe.operators.layout import BLOCK, LOOKBACK
    b = make(spark, {"HOT": closes_of(5000, 1), "COLD": closes_of(40, 2)})
    groups = with_blocks(with_row_index(b)).groupBy("symbol", "blk").count().collect()
    hot = sorted((r.blk, r["count"]) for r in groups if r.symbol == "HOT")
    assert [g for g, _ in hot] == [0, 1, 2]
    assert max(c for _, c in hot) <= BLOCK + LOOKBACK
    assert sum(c for _, c in hot) == 5000 + 2 * LOOKBACK      # halo copies only


def test_indicators_are_one_lazy_plan(spark):
    """Building the plan runs no job, and a filter on the symbol reaches the scan."""
    b = bars(spark, SF01, "supp")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "plan building")
    ind = indicators(b).filter("symbol = '7'")
    plan = ind._jdf.queryExecution().toString()
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "checkpoint" not in plan.lower() and plan.count("Scan ExistingRDD") == 0
    assert "cast(l_suppkey" in plan.split("== Physical Plan ==")[1] and "= 7" in plan.split("== Physical Plan ==")[1]
