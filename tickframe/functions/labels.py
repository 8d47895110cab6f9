"""Report labels and classes.

Codes that come from the analysis answer (trend, strength, sentiment) keep the
reference's Vietnamese values, because answers are matched against them; the
labels this library emits itself are plain English codes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report labels (Vietnamese strings kept as data, as in the reference).
TREND_TONE = [("Tăng", "bull"), ("Giảm", "bear"), ("Đi ngang", "neutral")]
SENTIMENT_ICON = [("Tích cực", "↑", "pos"), ("Tiêu cực", "↓", "neg"), ("Trung lập", "→", "flat")]
# Thresholds of the RSI status.
RSI_OVERBOUGHT = 70.0
RSI_OVERSOLD = 30.0
# Answer vocabulary used by the scenario classes (F15) and defaults.
BULL_WORDS = ("Bull", "tăng")
BEAR_WORDS = ("Bear", "giảm")
NEUTRAL_SENTIMENT = "Trung lập"


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def rsi_status(rsi: str | Column, strict: bool = False) -> Column:
    """overbought above 70, oversold below 30, else neutral.

    As in the reference a missing RSI counts as 0, i.e. ``oversold`` (N6);
    ``strict=True`` returns null for a missing RSI instead.
    """
    r = _c(rsi)
    v = r if strict else F.coalesce(r, F.lit(0.0))
    out = (F.when(v > RSI_OVERBOUGHT, F.lit("overbought"))
            .when(v < RSI_OVERSOLD, F.lit("oversold"))
            .otherwise(F.lit("neutral")))
    return F.when(r.isNotNull(), out) if strict else out


def macd_status(hist: str | Column) -> Column:
    """positive when the histogram is above 0 (missing counts as 0)."""
    return F.when(F.coalesce(_c(hist), F.lit(0.0)) > 0, F.lit("positive")).otherwise(F.lit("negative"))


def _lookup(pairs, key: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    return m[key]


def trend_badge(trend: str | Column, strength: str | Column) -> Column:
    """``struct<tone, text>``: tone by trend (default neutral), ``trend · strength``."""
    t, s = _c(trend), _c(strength)
    tone = F.coalesce(_lookup(TREND_TONE, t), F.lit("neutral"))
    text = F.when(F.coalesce(s, F.lit("")) != "", F.concat(F.coalesce(t, F.lit("")), F.lit(" · "), s)) \
        .otherwise(F.coalesce(t, F.lit("")))
    return F.struct(tone.alias("tone"), text.alias("text"))


def sentiment_icon(sentiment: str | Column) -> Column:
    """``struct<tone, text>``: arrow and tone of a sentiment, defaults ``—`` / flat."""
    s = _c(sentiment)
    icon = F.coalesce(_lookup([(k, i) for k, i, _ in SENTIMENT_ICON], s), F.lit("—"))
    tone = F.coalesce(_lookup([(k, c) for k, _, c in SENTIMENT_ICON], s), F.lit("flat"))
    return F.struct(tone.alias("tone"), F.concat_ws(" ", icon, F.coalesce(s, F.lit(""))).alias("text"))


def scenario_class(name: str | Column) -> Column:
    """bull if the name has ``Bull`` or (lower-cased) the word for up; then bear."""
    n = F.coalesce(_c(name), F.lit(""))
    low = F.lower(n)
    bull = n.contains(BULL_WORDS[0]) | low.contains(BULL_WORDS[1])
    bear = n.contains(BEAR_WORDS[0]) | low.contains(BEAR_WORDS[1])
    return F.when(bull, F.lit("bull")).when(bear, F.lit("bear")).otherwise(F.lit("neutral"))


def hero_direction(change_pct: str | Column) -> Column:
    """F16: ``struct<up, tone, sign>``: up when ``(pct or 0) >= 0``; zero gets ``+``."""
    up = F.coalesce(_c(change_pct), F.lit(0.0)) >= 0
    return F.struct(up.alias("up"),
                    F.when(up, F.lit("up")).otherwise(F.lit("down")).alias("tone"),
                    F.when(up, F.lit("+")).otherwise(F.lit("")).alias("sign"))
