"""The 17 per-bar indicator columns (the reference's ``calc_indicators``).

``indicators(bars)`` = layout -> finite frames -> recurrences, as one lazy plan:
nothing runs or is stored while it is built, and filters on the key reach the
scan.  Input bars must be clean (``clean.validate_bars``): unique
``(symbol, time)`` and finite open / high / low / close.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickframe.operators.frames import finite_frames
from tickframe.operators.layout import BLOCK, LOOKBACK, drop_halo, with_blocks, with_row_index
from tickframe.operators.recurrence import wilder_and_macd

# Names of the indicator columns.
INDICATOR_COLUMNS = [
    "ma5", "ma10", "ma20", "ma50", "ma100", "ma200", "vol_ma20", "atr14",
    "bb_mid", "bb_upper", "bb_lower", "rsi14", "macd", "macd_signal", "macd_hist",
    "stoch_k", "stoch_d",
]

#: columns of the bars that the indicators are made from
USED = ("rn", "high", "low", "close", "volume")


def indicators(bars: DataFrame, key: str = "symbol", block: int = BLOCK, lookback: int = LOOKBACK,
               bucket: str = "MM", wanted: list[str] | None = None) -> DataFrame:
    """Bars plus ``rn``, ``n_bars``, ``blk``, ``prev_close``, the 17 indicators, ``hi52`` and ``lo52``.

    The rows move twice: once to be numbered by ``(key, bucket)``, once to
    ``(key, blk)``, where all windows run.  The bar counts per bucket are a
    second, narrow read of key and time.  Bars that carry ``rn`` and ``n_bars``
    already (``profile.checked_series``) are not numbered again.  A caller that will select few
    columns names them in ``wanted``: the others are then laid out for neither reader of the
    layout, so that both still share one exchange.
    """
    idx = bars if {"rn", "n_bars"} <= set(bars.columns) else with_row_index(bars, bucket=bucket, key=key)
    # the filter is what the join of the carries would infer on its side alone; on both, they share the exchange
    blocked = with_blocks(idx, lookback, block).filter(F.col(key).isNotNull() & F.col("blk").isNotNull())
    frames = finite_frames(blocked, key)
    laid_out = [c for c in blocked.columns if wanted is None or c in wanted or c in (key, "blk", "_halo", *USED)]
    out = drop_halo(wilder_and_macd(frames, key, block, lookback, laid_out))
    return out.select(*[f"`{c}`" for c in bars.columns if c not in ("rn", "n_bars")], "rn", "n_bars", "blk", "prev_close", *INDICATOR_COLUMNS, "hi52", "lo52")
