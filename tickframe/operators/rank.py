"""Movers and sector rankings.

The reference downloads each stock once per index and per use; here every
symbol's newest two bars are read once (``last_two``) and shared by movers
and sectors of all indexes.

``last_two`` keeps two rows per symbol with ``row_number() <= 2``; Spark plans
that filter as a ``WindowGroupLimit`` on both sides of the shuffle, so a
symbol with a third of all bars ships at most two rows per map task.
Dimension tables are joined without hints: Spark broadcasts them if their size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.functions.numeric import rnd
from tickframe.operators.profile import newest_rows

STOCK_SCALE = 1000.0     # stock candles are quoted in thousands (S2)
TOP_K = 3                # movers and sectors listed on each side
FEW_BARS = 1000          # more bars of a symbol than this are not sorted in one task


def scale_fixed(bars: DataFrame, factor: float = STOCK_SCALE) -> DataFrame:
    """Multiply the four prices by a constant."""
    return bars.select(*[(F.col(c) * F.lit(factor)).alias(c) if c in ("open", "high", "low", "close")
                         else F.col(c) for c in bars.columns])


def last_n_bars(bars: DataFrame, n: int, key: str = "symbol") -> DataFrame:
    """Newest ``n`` bars per symbol, with ``rn_desc`` (1 = newest).

    Few bars are a top-k that Spark limits before the shuffle; many are cut out of the series' profile.
    """
    if n > FEW_BARS:
        return newest_rows(bars, n, key=key)
    w = Window.partitionBy(key).orderBy(F.col("time").desc())
    return bars.withColumn("rn_desc", F.row_number().over(w)).filter(F.col("rn_desc") <= n)


def last_two(bars: DataFrame, key: str = "symbol") -> DataFrame:
    """``symbol, time, close, prev_close, n_last`` (n_last = 1 for one-bar series)."""
    t = last_n_bars(bars.select(key, "time", "close"), 2, key)
    return t.groupBy(key).agg(
        F.max("time").alias("time"),
        F.max_by("close", "time").alias("close"),
        F.min_by("close", "time").alias("_first"),
        F.count(F.lit(1)).alias("n_last"),
    ).select(key, "time", "close",
             F.when(F.col("n_last") == 2, F.col("_first")).alias("prev_close"), "n_last")


def pct_change(close: Column, prev: Column) -> Column:
    """L3 percent form: ``(c - p) / p * 100``, 0 when ``p`` is 0."""
    return F.when(prev == 0, F.lit(0.0)).otherwise(
        (close - prev) / F.nullif(prev, F.lit(0.0)) * F.lit(100.0))


def require_two_bars(last2: DataFrame) -> DataFrame:
    """P10: symbols with fewer than two bars are skipped."""
    return last2.filter(F.col("n_last") >= 2)


def cap_universe(universe: DataFrame, cap: int | None = None) -> DataFrame:
    """Only the first ``cap`` entries of every universe are ranked (``None``: all of them)."""
    return universe if cap is None else universe.filter(F.col("ord") <= cap)


def top_movers(universe: DataFrame, stock_bars: DataFrame, k: int = TOP_K,
               cap: int | None = None, last2: DataFrame | None = None) -> DataFrame:
    """T6 flat: ``index, side, rank, symbol, close, change_pct``.

    Gainers: rounded percent descending, ties in list order.  Losers: the last
    ``k`` of that order reversed = percent ascending, ties in reverse list
    order.  With fewer than ``2k`` symbols the two lists overlap (N9).  Each side is a
    top-k of its own: Spark limits it before the shuffle by index and after it.
    ``last2`` may be a precomputed ``last_two`` table shared with sectors.
    """
    capped = cap_universe(universe, cap)
    if last2 is None:
        last2 = last_two(stock_bars.join(capped.select("symbol").distinct(), "symbol", "left_semi"))
    l2 = require_two_bars(last2)
    res = capped.join(l2, "symbol").select(
        "index", "ord", "symbol", "close",
        rnd(pct_change(F.col("close"), F.col("prev_close")), 2).alias("change_pct")).filter("change_pct is not null")

    def side(name: str, *order: Column) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("index").orderBy(*order))
        return res.withColumn("_place", place).filter(F.col("_place") <= k).select(
            "index", F.lit(name).alias("side"), F.col("_place").cast("long").alias("rank"), "symbol", "close", "change_pct")

    # one window to a select, so that each map task sends at most k rows of an index and side
    return side("gainer", F.col("change_pct").desc(), F.col("ord").asc()) \
        .unionByName(side("loser", F.col("change_pct").asc(), F.col("ord").desc()))


def sector_members(indexes: DataFrame, universe: DataFrame, sectors: DataFrame) -> DataFrame:
    """``index, sector, sector_ord, symbol`` — tickers of the index universe.

    An index with an empty universe keeps every mapped ticker of ``sectors``.
    """
    members = universe.select("index", "symbol").distinct() \
        .join(sectors, "symbol")
    # an index without a universe takes the whole map: its code is added to every row of it
    empty = indexes.select("index").join(universe.select("index"), "index", "left_anti")
    codes = empty.agg(F.collect_list("index")).scalar()
    everyone = sectors.select("*", F.explode(codes).alias("index"))
    columns = ["index", "sector", "sector_ord", "symbol"]
    return members.select(*columns).unionByName(everyone.select(*columns))


def sector_performance(members: DataFrame, stock_bars: DataFrame, k: int = TOP_K,
                       last2: DataFrame | None = None) -> DataFrame:
    """T7 flat: ``index, sector, change_pct, all_rank, lead_rank, lag_rank``.

    A1: the mean of the unrounded member percents, rounded to 2; sectors
    without a member with two bars are omitted.  T4/T5 rank the rounded means
    (ties by sector order; lagging ties by reverse sector order).
    """
    if last2 is None:
        last2 = last_two(stock_bars.join(members.select("symbol").distinct(), "symbol", "left_semi"))
    l2 = require_two_bars(last2).select(
        "symbol", pct_change(F.col("close"), F.col("prev_close")).alias("_pct")).filter("_pct is not null")
    sec = members.join(l2, "symbol").groupBy("index", "sector", "sector_ord") \
        .agg(rnd(F.avg("_pct"), 2).alias("change_pct"))
    w_all = Window.partitionBy("index").orderBy(F.col("change_pct").desc(), F.col("sector_ord").asc())
    w_lag = Window.partitionBy("index").orderBy(F.col("change_pct").asc(), F.col("sector_ord").desc())
    r = sec.select("*", F.row_number().over(w_all).cast("long").alias("all_rank"),
                   F.row_number().over(w_lag).cast("long").alias("_lag"))
    return r.select("index", "sector", "change_pct", "all_rank",
                    F.when(F.col("all_rank") <= k, F.col("all_rank")).alias("lead_rank"),
                    F.when(F.col("_lag") <= k, F.col("_lag")).alias("lag_rank"))


def collect_top_lists(movers: DataFrame, sectors: DataFrame) -> DataFrame:
    """Per index the nested lists of the market document.

    ``top_gainers``, ``top_losers``: arrays of ``{symbol, close, change_pct}``
    in rank order; ``leading``, ``lagging``: arrays of ``{name, change_pct}``;
    ``all``: every sector in descending order (``array<struct>`` keeps the
    order a map would lose).  Each list is bounded (k or #sectors) per index.
    """
    def ordered(df, cond, fields):
        return F.transform(
            F.array_sort(F.collect_list(F.when(cond, F.struct(*fields)))),
            lambda x: x.dropFields("rank"))

    mv = movers.groupBy("index").agg(
        ordered(movers, F.col("side") == "gainer",
                [F.col("rank"), "symbol", "close", "change_pct"]).alias("top_gainers"),
        ordered(movers, F.col("side") == "loser",
                [F.col("rank"), "symbol", "close", "change_pct"]).alias("top_losers"))
    sc = sectors.groupBy("index").agg(
        ordered(sectors, F.col("lead_rank").isNotNull(),
                [F.col("lead_rank").alias("rank"), F.col("sector").alias("name"),
                 "change_pct"]).alias("leading"),
        ordered(sectors, F.col("lag_rank").isNotNull(),
                [F.col("lag_rank").alias("rank"), F.col("sector").alias("name"),
                 "change_pct"]).alias("lagging"),
        ordered(sectors, F.lit(True),
                [F.col("all_rank").alias("rank"), F.col("sector").alias("name"),
                 "change_pct"]).alias("all"))
    return mv.join(sc, "index", "outer")
