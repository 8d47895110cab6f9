"""Series-level scalars (L1-L4): pivots, Fibonacci levels, change, snapshot.

All of them are projections of the newest bar of each symbol (``rn = n_bars``),
which ``indicators`` already carries with ``prev_close``, ``hi52`` and ``lo52``,
so the snapshot is a filter and a ``select``: no extra shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.functions.numeric import rnd
from tickframe.operators.indicators import INDICATOR_COLUMNS

# Fibonacci retracement ratios of the 52-week range.
FIBO_RATIOS = {"fibo_236": 0.236, "fibo_382": 0.382, "fibo_500": 0.5, "fibo_618": 0.618,
               "fibo_786": 0.786}

# Fields of the latest-bar record (L4).
SNAPSHOT_COLUMNS = (
    ["date", "close", "open", "high", "low", "volume", "change", "change_pct"]
    + ["ma5", "ma10", "ma20", "ma50", "ma100", "ma200", "bb_upper", "bb_mid", "bb_lower",
       "rsi14", "macd", "macd_signal", "macd_hist", "stoch_k", "stoch_d", "atr14", "vol_ma20"]
    + ["pivot", "r1", "r2", "r3", "s1", "s2", "s3"]
    + list(FIBO_RATIOS) + ["hi52", "lo52"]
)


def pivot_levels(high: Column, low: Column, close: Column) -> dict[str, Column]:
    """L1: classic floor pivots of one bar (the newest one, as in the reference)."""
    p = (high + low + close) / F.lit(3.0)
    return {
        "pivot": p,
        "r1": F.lit(2.0) * p - low,
        "r2": p + high - low,
        "r3": high + F.lit(2.0) * (p - low),
        "s1": F.lit(2.0) * p - high,
        "s2": p - high + low,
        "s3": low - F.lit(2.0) * (high - p),
    }


def fibonacci_levels(hi52: Column, lo52: Column) -> dict[str, Column]:
    """L2: retracements ``hi - r * (hi - lo)`` plus the range ends."""
    diff = hi52 - lo52
    out = {name: hi52 - F.lit(ratio) * diff for name, ratio in FIBO_RATIOS.items()}
    out.update({"hi52": hi52, "lo52": lo52})
    return out


def change(close: Column, prev_close: Column) -> tuple[Column, Column]:
    """L3: absolute and percent change; a zero previous close gives 0 percent.

    A null previous close stays null (the check on zero comes first only for
    non-null values).
    """
    chg = close - prev_close
    pct = F.when(prev_close == 0, F.lit(0.0)).otherwise(chg / F.nullif(prev_close, F.lit(0.0))
                                                        * F.lit(100.0))
    return chg, pct


def snapshot(ind: DataFrame, keys: tuple[str, ...] = ("symbol",), digits: int = 2) -> DataFrame:
    """L4: the 39-field latest-bar record per symbol, rounded half-up.

    A one-bar series uses its only bar as the previous one (change 0).
    """
    last = ind.filter(F.col("rn") == F.col("n_bars"))
    c, h, lo = F.col("close"), F.col("high"), F.col("low")
    prev_close = F.coalesce(F.col("prev_close"), c)
    chg, pct = change(c, prev_close)
    vals: dict[str, Column] = {
        "date": F.substring(F.col("time").cast("string"), 1, 10),
        "close": c, "open": F.col("open"), "high": h, "low": lo,
        "volume": F.col("volume").cast("long"),
        "change": chg, "change_pct": pct,
    }
    vals.update({name: F.col(name) for name in INDICATOR_COLUMNS})
    vals.update(pivot_levels(h, lo, c))
    vals.update(fibonacci_levels(F.col("hi52"), F.col("lo52")))
    cols = [F.col(k) for k in keys]
    for name in SNAPSHOT_COLUMNS:
        v = vals[name]
        if name not in ("date", "volume"):
            v = rnd(v, digits)
        cols.append(v.alias(name))
    return last.select(*cols)
