"""Streaks, extremes, scores and labels as expressions over metric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numbers import clamp, floor2, only_finite, ratio, sign
from .regress import max_last_n, min_last_n, newest
from .series import PRICED, SPANS

# Style labels of the report, in rule order.
STYLES = {
    "hazardous": "危険物",
    "plain_high_vol": "只のハイボラ危険株",
    "unstatistical": "統計拒否",
    "aggressive_trend": "攻撃的順張り",
    "market_mirror": "市場の写像",
    "defensive": "ディフェンシブ耐久",
    "asymmetric_alpha": "非対称アルファ",
    "none": "該当なし",
}


def _or_zero(name: str) -> Column:
    return F.coalesce(only_finite(F.col(name)), F.lit(0.0))


def _one_to_ten(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(1)), F.lit(10)).cast("int")


def step_aggregates() -> dict[str, Column]:
    """Change of the newest bar against the one before; needs ``prev_close`` and ``prev_volume``."""
    out = {}
    for c in PRICED:
        out[f"{c}_change"] = newest(f"{c} - prev_{c}")
        out[f"{c}_change_pct"] = newest(f"(try_divide({c}, prev_{c}) - 1.0D) * 100.0D")
    return out


def streak_aggregate() -> Column:
    """Signed number of newest bars that moved the same way, 0 after an unchanged close.

    A rise lasts until the newest bar that did not rise, a fall until the newest that did not
    fall; with no such bar it covers every change of the slice. Needs ``prev_close``.
    """
    move, changes = "signum(close - prev_close)", "max(n) - 1"
    up = f"coalesce(min(if({move} <= 0, rd, NULL)) - 1, {changes})"
    down = f"coalesce(min(if({move} >= 0, rd, NULL)) - 1, {changes})"
    now = f"max(if(rd = 1, {move}, NULL))"
    return F.expr(f"int(CASE WHEN {now} > 0 THEN {up} WHEN {now} < 0 THEN -({down}) WHEN {now} = 0 THEN 0 END)")


def extreme_aggregates() -> dict[str, Column]:
    """Rise above the low and fall from the high of the newest N closes, floored to two decimals."""
    now, out = newest("close"), {}
    for n in SPANS[:3]:
        out[f"rise_{n}"] = floor2((F.try_divide(now, min_last_n("close", n)) - 1.0) * 100.0)
    for n in SPANS[:3]:
        out[f"fall_{n}"] = floor2((F.try_divide(now, max_last_n("close", n)) - 1.0) * 100.0)
    return out


def breakout_aggregates() -> dict[str, Column]:
    """Newest close above the highest, or below the lowest, close of bars 15 to 60."""
    now, long_enough = newest("close"), F.max("n") >= 61
    high, low = (F.expr(f"{f}(if(rd BETWEEN 15 AND 60, close, NULL))") for f in ("max", "min"))

    def score(gap: Column) -> Column:
        return F.when(gap < 0.3, F.lit(10)).otherwise(F.greatest(F.lit(1), 10 - F.floor(gap / 0.3))).cast("int")

    up = F.when(long_enough & (now > high) & (high > 0), score(F.try_divide(now - high, high) * 100.0))
    down = F.when(long_enough & (now < low) & (low > 0), score(F.try_divide(low - now, low) * 100.0))
    return {"breakout_up": F.coalesce(up, F.lit(0)), "breakout_down": F.coalesce(down, F.lit(0))}


def gap_retrace_aggregate() -> Column:
    """Gap-up fully given back: the oldest 8 % jump among the newest 14 bars decides."""
    now = newest("close")
    jump = "rd <= 14 AND prev_close > 0 AND try_divide(close, prev_close) - 1.0D >= 0.08D"
    base = F.expr(f"max_by(prev_close, if({jump}, rd, NULL))")
    score = _one_to_ten(F.floor(F.try_divide(base - now, base) * 100.0 / 0.5) + 1)
    return F.coalesce(F.when((F.max("n") >= 15) & (now < base), score), F.lit(0))


def low_vol_score() -> Column:
    """Quiet range while volume rises."""
    v10, v45 = _or_zero("range_std_10"), _or_zero("range_std_45")
    s_close = _or_zero("close_sma_slope_10")
    s10, s45 = _or_zero("volume_sma_slope_10"), _or_zero("volume_sma_slope_45")
    m10, m45 = _or_zero("volume_sma_10"), _or_zero("volume_sma_45")
    met = (v10 < v45) & (s_close > 0) & (s10 > 0) & (s10 > s45) & (m10 > m45) & (m45 > 0)
    growth = F.try_divide(m10, m45)
    return F.coalesce(F.when(met & (growth > 1.0), _one_to_ten(F.floor((growth - 1.0) / 0.2) + 1)), F.lit(0))


def composite_score() -> Column:
    """Weighted trend, volume, support, breakout and oscillator on a scale of 0 to 10."""
    trend = (
        0.5 * sign(F.col("close_slope_10")) + 0.3 * sign(F.col("close_slope_22")) + 0.2 * sign(F.col("close_slope_45"))
    )
    volume = 0.5 * sign(F.col("volume_slope_10"))
    macd_share = F.when(F.col("close") > 0, F.try_divide(only_finite(F.col("macd")), F.col("close")))
    oscillator = F.coalesce(
        clamp((only_finite(F.col("rsi_14")) - 50.0) / 20.0, -1.0, 1.0) * 0.7, F.lit(0.0)
    ) + 0.3 * F.tanh(80.0 * F.coalesce(macd_share, F.lit(0.0)))
    raw = (
        0.35 * trend
        + 0.10 * volume
        + 0.20 * F.col("low_vol_score") / 10.0
        + 0.15 * F.col("breakout_up") / 10.0
        + 0.10 * oscillator
        - 0.20 * F.col("breakout_down") / 10.0
        - 0.15 * F.col("gap_retrace") / 10.0
    )
    # The inner rounding lifts sums such as 2.4999999999999996 to the half they stand for.
    return F.when(F.col("bars") >= 30, F.round(F.round(clamp(5.0 + 5.0 * raw, 0.0, 10.0), 14)).cast("int"))


def style_label(labels: dict[str, str] | None = None) -> Column:
    """Seven ordered rules over the market statistics; anything missing gives the last label."""
    labels = labels or STYLES
    beta, corr, rel, resid = (F.col(c) for c in ("beta", "corr", "rel_vol", "resid_vol"))
    b_up, b_down = F.col("beta_up"), F.col("beta_down")
    up, down = F.col("up_capture") * 100.0, F.col("down_capture") * 100.0

    far = (F.abs(up - 100) > 30) & (F.abs(down - 100) > 30)
    scattered = far & ((F.abs(up - down) > 60) | ((up - 100) * (down - 100) < 0))
    near_market = beta.between(0.8, 1.2) & (corr >= 0.8) & rel.between(0.8, 1.2)
    chasing = (beta > 1.2) & (b_up > beta) & (up > 120) & (corr >= 0.6)

    rules = {
        "hazardous": (beta > 1.3) & (corr < 0.5) & (resid >= 0.05) & (down > 130),
        "plain_high_vol": chasing & (down > 120),
        "unstatistical": (corr < 0.5) & (resid >= 0.03) & beta.between(0.5, 1.5) & scattered,
        "aggressive_trend": chasing,
        "market_mirror": near_market & up.between(90, 110) & down.between(90, 110),
        "defensive": (beta < 0.8) & (down < 80) & (b_down < 0.7) & (corr <= 0.6),
        "asymmetric_alpha": near_market & up.between(95, 115) & (down < 95),
    }
    known = beta.isNotNull()
    for c in (corr, rel, resid, b_up, b_down, up, down):
        known = known & c.isNotNull()
    label = F.when(~known, F.lit(labels["none"]))
    for name, rule in rules.items():
        label = label.when(rule, F.lit(labels[name]))
    return label.otherwise(F.lit(labels["none"]))


def range_instability(span: int) -> Column:
    return ratio(F.col(f"range_std_{span}"), F.col(f"close_sma_{span}"))


def perfect_order() -> Column:
    """1 when the 10, 22, 45 and 90 bar averages all rise, -1 when all fall, 0 otherwise."""
    slopes = [only_finite(F.col(f"close_sma_slope_{s}")) for s in SPANS[1:]]
    low, high = F.least(*slopes), F.greatest(*slopes)
    known = slopes[0].isNotNull()
    for s in slopes[1:]:
        known = known & s.isNotNull()
    return F.when(known, F.when(high < 0, -1).when(low > 0, 1).otherwise(0))


def margin_days(margin_long: Column, volume_sma_10: Column) -> Column:
    """Days of average volume it takes to unwind margin buying, which is counted in thousands."""
    return F.when(volume_sma_10 > 0, margin_long * 1000.0 / volume_sma_10)
