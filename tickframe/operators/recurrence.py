"""Recursive indicators (R1-R7) inside the blocks of the layout.

EMA and Wilder's RMA are first-order recurrences with a constant factor:

    y_i = q * y_{i-1} + b_i,   so   y_i = sum over k <= i of b_k q^(i-k)

* EMA(span):  a = 2 / (span + 1), q = 1 - a, b_1 = x_1, b_i = a x_i.
* RMA(p):     q = (p - 1) / p, b_i = x_i / p; up to the seed row the terms are
              weighted so that the value there is the plain mean of the first p.

A block carries the ``LOOKBACK`` rows before it, and the sum starts at the
first of them.  What it leaves out is ``q^LOOKBACK`` of the value before, less
than 1e-20 of it for every factor used here: below the rounding of a double where
the value is added to or compared with prices.  The running sum is scaled by
``q^(width - 1 - j)``, and ``check_width`` keeps that inside the double range.

The RSI is a ratio of two such values, and both may fade for thousands of rows
without changing it.  So the averages of gains and losses start at the block's
own rows and take the value at the end of the block before from ``carries``: the
totals of the blocks (one small row per block) folded as far back as they can
still change a double.  The totals are read off the same layout: one exchange into
blocks serves the frames and the totals.  This, too, stays a lazy plan.

The MACD signal is an EMA of a difference of EMAs.  The response of two chained
recurrences is a difference of two geometric ones, so the signal is a linear
combination of both EMAs and one more sum with the signal's own factor.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from tickframe.operators.layout import BLOCK, LOOKBACK


def check_width(q: float, width: int) -> None:
    if not 0.0 < q < 1.0:
        raise ValueError(f"decay factor must be in (0, 1), got {q}")
    if (width - 1) * -math.log(q) > 650.0:
        raise ValueError(f"{width} rows are too many for q={q}: q^-(width-1) would overflow")


def dlit(x: float) -> str:
    """A double literal for SQL text (``repr`` round-trips exactly)."""
    return f"{x!r}D"


def affine_scan(df: DataFrame, specs: list[tuple[str, str, float]], key: str = "symbol",
                block: int = BLOCK, lookback: int = LOOKBACK) -> DataFrame:
    """Add one column per ``(name, b, q)``: ``y = q * y_prev + b`` along ``rn``.

    ``df`` has the rows of ``with_blocks(.., lookback, block)``, halo included;
    ``b`` is a SQL expression.
    """
    width = block + lookback
    for _, _, q in specs:
        check_width(q, width)
    j = f"(rn - 1 - greatest(blk * {block} - {lookback}, 0))"
    run = f"over (partition by {key}, blk order by rn rows between unbounded preceding and current row)"
    return df.selectExpr("*", *[
        f"sum(({b}) * pow({dlit(q)}, {width - 1} - {j})) {run} / pow({dlit(q)}, {width - 1} - {j}) as {n}"
        for n, b, q in specs])


def carry_depth(q: float, block: int) -> int:
    """Number of block totals before a block that can still change a double."""
    return max(1, math.ceil(745.2 / (block * -math.log(q))) + 1)


def carries(df: DataFrame, specs: list[tuple[str, str, float]], key: str = "symbol", block: int = BLOCK,
            laid_out: list[str] | None = None) -> DataFrame:
    """(key, blk, name, ..): the value of each ``(name, b, q)`` at the last row before the block.

    ``laid_out`` are the columns that ``df``'s rows had when they were moved to their blocks.  The totals
    look at all of them, so that both readers of the layout want the same columns and
    share one exchange (and the scans below it); a narrower copy would be read and moved again.
    """
    j = f"(rn - 1 - blk * {block})"
    # the last block of a series is carried nowhere, so that it may be short changes nothing
    total = "named_struct(" + ", ".join(
        f"'{n}', coalesce(sum(({b}) * pow({dlit(q)}, {block - 1} - {j})), 0D)" for n, b, q in specs) + ")"
    if laid_out:
        whole = ", ".join(f"`{c}`" for c in laid_out)
        total = f"case when bit_xor(xxhash64({whole})) is not null then {total} end"      # true for every block
    totals = df.filter("not _halo").groupBy(key, "blk").agg(F.expr(f"{total} as _t"))
    depth = max(carry_depth(q, block) for _, _, q in specs)
    before = f"collect_list(_t) over (partition by {key} order by blk rows between {depth} preceding and 1 preceding)"
    return totals.selectExpr(key, "blk", f"{before} as _before").selectExpr(
        key, "blk", *[f"aggregate(_before, 0D, (y, t) -> y * {dlit(q ** block)} + t.{n}) as {n}" for n, _, q in specs])


def carried_scan(df: DataFrame, specs: list[tuple[str, str, float]], key: str = "symbol", block: int = BLOCK,
                 laid_out: list[str] | None = None) -> DataFrame:
    """``affine_scan`` without a halo: the values keep their relative precision however far they fade."""
    for _, _, q in specs:
        check_width(q, block)
    j = f"(rn - 1 - blk * {block})"
    run = f"over (partition by {key}, blk order by rn rows between unbounded preceding and current row)"
    own = df.selectExpr("*", *[
        f"sum(case when not _halo then ({b}) * pow({dlit(q)}, {block - 1} - {j}) end) {run} as _own{n}" for n, b, q in specs])
    carry = carries(df, [(f"_carry{n}", b, q) for n, b, q in specs], key, block, laid_out)
    return own.join(carry, [key, "blk"], "left").selectExpr(*[f"`{c}`" for c in df.columns], *[
        f"_own{n} / pow({dlit(q)}, {block - 1} - {j}) + _carry{n} * pow({dlit(q)}, {j} + 1) as {n}" for n, _, q in specs])


def ema_spec(name: str, x: str, span: int) -> tuple[str, str, float]:
    """R2: ``ewm(span, adjust=False).mean()``: y_1 = x_1, no null prefix."""
    a = 2.0 / (span + 1.0)
    return name, f"case when rn = 1 then {x} else {dlit(a)} * {x} end", 1.0 - a


def rma_spec(name: str, x: str, p: int, first_rn: int) -> tuple[str, str, float]:
    """Wilder smoothing; its value at ``first_rn`` is the mean of the p values up to there."""
    q = (p - 1.0) / p
    return name, f"{x} / {dlit(float(p))} * case when rn < {first_rn} then pow({dlit(q)}, rn - {first_rn}) else 1D end", q


def wilder_and_macd(frames: DataFrame, key: str = "symbol", block: int = BLOCK, lookback: int = LOOKBACK,
                    laid_out: list[str] | None = None) -> DataFrame:
    """R1-R7 on the output of ``finite_frames`` (halo rows included; ``laid_out``: see ``carries``).

    atr14 from rn 14, rsi14 from rn 15 (null when the loss average is 0),
    macd / macd_signal / macd_hist from rn 1.
    """
    fast, slow = ema_spec("_ema12", "close", 12), ema_spec("_ema26", "close", 26)
    a, r = 0.2, 0.8                                       # the signal's EMA of span 9
    of_fast, of_slow = a / (fast[2] - r), a / (slow[2] - r)
    mixed = ("_mixed", f"{dlit(of_fast)} * ({fast[1]}) - {dlit(of_slow)} * ({slow[1]})", r)
    s = affine_scan(frames, [
        fast, slow, mixed,
        rma_spec("_atr", "tr", 14, 14),
    ], key, block, lookback)
    s = carried_scan(s, [rma_spec("_avg_gain", "gain", 14, 15), rma_spec("_avg_loss", "loss", 14, 15)], key, block, laid_out)
    signal = f"({dlit(of_fast * fast[2])} * _ema12 - {dlit(of_slow * slow[2])} * _ema26 - {dlit(r)} * _mixed)"
    return s.selectExpr(
        *[f"`{c}`" for c in frames.columns],
        "_ema12 - _ema26 as macd",
        f"{signal} as macd_signal",
        f"_ema12 - _ema26 - {signal} as macd_hist",
        "case when rn >= 14 then _atr end as atr14",
        "case when rn >= 15 then 100D - 100D / (1D + _avg_gain / nullif(_avg_loss, 0D)) end as rsi14")
