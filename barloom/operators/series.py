"""Per-bar series on a slice from ``slice_positions``: averages, range volatility, deviation, RSI, MACD.

Every window below is partitioned by code over a slice of at most 200 bars, so a window
partition is bounded no matter how the raw rows are skewed. Expressions are SQL text: a report has
hundreds of them, and text is parsed in the JVM instead of being assembled call by call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = (5, 10, 22, 45, 90)
PRICED = ("close", "volume")

ASC = "PARTITION BY code ORDER BY i"
DESC = "PARTITION BY code ORDER BY i DESC"
WHOLE = f"{ASC} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
SO_FAR = f"{ASC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _last_rows(span: int) -> str:
    return f"{ASC} ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW"


def sma(x: str, span: int) -> Column:
    """Moving average, defined once ``span`` bars are there."""
    return F.expr(f"if(i >= {span - 1}, avg({x}) OVER ({_last_rows(span)}), NULL)")


def rolling_std(x: str, span: int) -> Column:
    """Rolling population standard deviation."""
    return F.expr(f"if(i >= {span - 1}, stddev_pop({x}) OVER ({_last_rows(span)}), NULL)")


def deviation(x: str, average: str) -> Column:
    """x / average - 1, undefined while the average is missing or zero."""
    return F.expr(f"try_divide({x}, {average}) - 1.0D")


def smoothed(x: str, alpha: float, seed_from: int, seed_to: int) -> str:
    """SQL text of the exponential smoothing e_i = alpha x_i + (1 - alpha) e_(i-1), seeded with a plain mean.

    Written without recursion: e_i = q^k (seed + sum of alpha x_j q^-k_j), with q = 1 - alpha and
    k the number of bars since the seed. Safe in double precision for slices of 200 bars, the
    only input it is meant for.
    """
    q = 1.0 - alpha
    seed = f"avg(if(i BETWEEN {seed_from} AND {seed_to}, {x}, NULL)) OVER ({WHOLE})"
    total = f"sum(if(i > {seed_to}, {alpha!r}D * {x} * pow({q!r}D, {seed_to} - i), NULL)) OVER ({SO_FAR})"
    return f"if(i >= {seed_to}, pow({q!r}D, i - {seed_to}) * ({seed} + coalesce({total}, 0.0D)), NULL)"


def ema(x: str, period: int) -> str:
    return smoothed(x, 2.0 / (period + 1.0), 0, period - 1)


def with_steps(bars: DataFrame) -> DataFrame:
    """Close and volume of the bar before."""
    return bars.withColumns({f"prev_{c}": F.expr(f"lag({c}) OVER ({ASC})") for c in PRICED})


def with_sma(bars: DataFrame) -> DataFrame:
    return bars.withColumns({f"{c}_sma_{s}": sma(c, s) for c in PRICED for s in SPANS})


def with_range_std(bars: DataFrame) -> DataFrame:
    """``range`` (high - low) and its rolling deviation."""
    spread = "high - low"
    return bars.withColumns({"range": F.expr(spread), **{f"range_std_{s}": rolling_std(spread, s) for s in SPANS}})


def with_deviation(bars: DataFrame) -> DataFrame:
    """Needs the columns of ``with_sma``."""
    return bars.withColumns({f"{c}_dev_{s}": deviation(c, f"{c}_sma_{s}") for c in PRICED for s in SPANS})


def with_rsi(bars: DataFrame, period: int = 14) -> DataFrame:
    """Relative strength index; needs ``prev_close``. 100 when there was no loss."""
    gain = smoothed("greatest(close - prev_close, 0.0D)", 1.0 / period, 1, period)
    loss = smoothed("greatest(prev_close - close, 0.0D)", 1.0 / period, 1, period)
    rsi = "if(_loss = 0.0D, 100.0D, 100.0D - 100.0D / (1.0D + try_divide(_gain, _loss)))"
    staged = bars.withColumns({"_gain": F.expr(gain), "_loss": F.expr(loss)})
    return staged.withColumn(f"rsi_{period}", F.expr(rsi)).drop("_gain", "_loss")


def with_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Difference of two exponential averages, defined for slices of at least slow + signal + 2 bars."""
    line = f"if(n >= {slow + signal + 2}, {ema('close', fast)} - {ema('close', slow)}, NULL)"
    return bars.withColumn("macd", F.expr(line))


def with_macd_signal(bars: DataFrame, signal: int = 9) -> DataFrame:
    """Smoothed MACD line; needs ``macd``. The undefined head of the line enters the seed as 0.

    An undefined value repeats the signal before it, so k counts defined values only.
    """
    alpha = 2.0 / (signal + 1.0)
    q = f"{1.0 - alpha!r}D"
    counted = f"if(i >= {signal}, macd, NULL)"
    staged = bars.withColumns(
        {
            "_k": F.expr(f"count({counted}) OVER ({SO_FAR})"),
            "_seed": F.expr(f"avg(if(i < {signal}, coalesce(macd, 0.0D), NULL)) OVER ({WHOLE})"),
            "_known": F.expr(f"count(macd) OVER ({WHOLE}) > 0"),
        }
    )
    total = f"coalesce(sum({alpha!r}D * {counted} * pow({q}, -_k)) OVER ({SO_FAR}), 0.0D)"
    value = f"if(_known AND i >= {signal - 1}, pow({q}, _k) * (_seed + {total}), NULL)"
    return staged.withColumn("macd_signal", F.expr(value)).drop("_k", "_seed", "_known")


def with_defined_rank(bars: DataFrame, cols: list[str]) -> DataFrame:
    """``dr_<col>``: rank among the defined values of a column, 1 = newest."""
    ranks = {f"dr_{c}": F.expr(f"if({c} IS NOT NULL, count({c}) OVER ({DESC}), NULL)") for c in cols}
    return bars.withColumns(ranks)
