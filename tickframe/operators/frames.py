"""Finite-frame window operators (W1-W11, A3) on the blocked layout.

Rule shared by every rolling statistic (pandas ``rolling(p)``): the value is
null until the frame holds ``p`` non-null rows and null whenever the frame
holds a null.  All frames use one window spec ``(symbol, blk) ORDER BY rn``,
so Spark plans one sort and a few ``Window`` operators on one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

MA_PERIODS = (5, 10, 20, 50, 100, 200)
YEAR_BARS = 252       # 52-week high / low look-back, by row count
#: longer averages add up the sums of shorter frames before them (Spark sums a sliding frame anew for each row);
#: nothing is subtracted, so one huge price is gone when it leaves the frame
DIRECT_FRAME, CHUNK = 20, 10


def finite_frames(blocked: DataFrame, key: str = "symbol") -> DataFrame:
    """All finite-frame columns plus the inputs of the recurrences.

    Adds ma5..ma200, vol_ma20, bb_mid/upper/lower, prev_close, delta, tr,
    gain, loss, lo14, hi14, stoch_k, stoch_d, and ``hi52`` / ``lo52`` on the
    newest bar of each symbol.
    """
    w = f"partition by {key}, blk order by rn"

    def frame(p: int) -> str:
        return f"over ({w} rows between {p - 1} preceding and current row)"

    def guarded(fn: str, x: str, p: int) -> str:
        return f"case when count({x}) {frame(p)} = {p} then {fn}({x}) {frame(p)} end"

    def added(of: str, step: int, n: int) -> str:
        return " + ".join([of, *[f"lag({of}, {k * step}) over ({w})" for k in range(1, n)]])

    a = blocked.selectExpr(
        "*",
        f"{guarded('sum', 'close', CHUNK)} as _chunk",
        f"{guarded('stddev_samp', 'close', 20)} as _std20",
        f"lag(close, 1) over ({w}) as prev_close",
        f"{guarded('min', 'low', 14)} as lo14",
        f"{guarded('max', 'high', 14)} as hi14",
        f"{guarded('avg', 'volume', 20)} as vol_ma20",
        *[f"{guarded('avg', 'close', p)} as ma{p}" for p in MA_PERIODS if p <= DIRECT_FRAME])
    delta = "(close - prev_close)"
    a = a.selectExpr(
        *[f"`{c}`" for c in a.columns if c != "_chunk"],
        f"{added('_chunk', CHUNK, 5)} as _sum50",
        f"{delta} as delta",
        "greatest(high - low, abs(high - prev_close), abs(low - prev_close)) as tr",
        "100D * (close - lo14) / nullif(hi14 - lo14, 0D) as stoch_k",
        f"case when {delta} is not null then greatest({delta}, 0D) end as gain",
        f"case when {delta} is not null then greatest(-{delta}, 0D) end as loss")
    whole = f"over (partition by {key}, blk)"
    return a.selectExpr(
        *[f"`{c}`" for c in a.columns if c not in ("_std20", "_sum50")],
        # 50 rows are five chunks, 100 and 200 rows two and four times 50; a null chunk makes the sum null
        *[f"({added('_sum50', 50, p // 50)}) / {float(p)!r}D as ma{p}" for p in MA_PERIODS if p > DIRECT_FRAME],
        "ma20 as bb_mid",
        "ma20 + 2D * _std20 as bb_upper",
        "ma20 - 2D * _std20 as bb_lower",
        f"{guarded('avg', 'stoch_k', 3)} as stoch_d",
        # the last block plus its halo holds the newest YEAR_BARS rows
        f"case when rn = n_bars then max(case when rn > n_bars - {YEAR_BARS} then high end) {whole} end as hi52",
        f"case when rn = n_bars then min(case when rn > n_bars - {YEAR_BARS} then low end) {whole} end as lo52")
