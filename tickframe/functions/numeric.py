"""Numeric helpers shared by every operator (F1, F2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NOISE_PLACES = 10


def rnd(x: str | Column, d: int = 2) -> Column:
    """Round half-up to ``d`` places, stable across engines.

    Ten places come first: that absorbs the noise of a sum (values that are an
    exact decimal midpoint, as a 200-bar mean of 2-decimal prices often is, round
    the same way however the sum was accumulated) and moves no value that differs
    from a midpoint by more than 5e-11.
    """
    c = F.col(x) if isinstance(x, str) else x
    return F.round(F.round(c, NOISE_PLACES), d)
