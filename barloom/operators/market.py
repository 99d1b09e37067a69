"""Stock against market index: aligned returns and the statistics over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bars import MIN_BARS, SLICE_BARS, slice_positions
from .series import ASC, DESC

ALIGNED_BARS = 91
MIN_PAIRS = 30
INDEX_CODE = "0010"


def index_series(bars: DataFrame, code: str = INDEX_CODE) -> DataFrame:
    """(m_i, m_date, m_close, m_prev, m_n) of the index code: never more than 200 rows.

    Empty when the index has too few bars to be used. The sorted limit keeps 200 rows per task, so
    the index's history is never gathered in one place.
    """
    own = bars.filter(F.col("code") == code).select("code", "asof_date", "close")
    index = slice_positions(own.orderBy(F.desc("asof_date")).limit(SLICE_BARS), SLICE_BARS)
    return (
        index.withColumn("m_prev", F.expr(f"lag(close) OVER ({ASC})"))
        .filter(F.col("n") >= MIN_BARS)
        .select(
            F.col("i").alias("m_i"),
            F.col("asof_date").alias("m_date"),
            F.col("close").alias("m_close"),
            "m_prev",
            F.col("n").alias("m_n"),
        )
    )


def daily_mean_index(bars: DataFrame, code: str = INDEX_CODE) -> DataFrame:
    """An index built from the table itself: the mean close of each day."""
    return bars.groupBy("asof_date").agg(F.avg("close").alias("close")).select(F.lit(code).alias("code"), "*")


def with_index_returns(sliced: DataFrame, index: DataFrame | None, align: str = "position") -> DataFrame:
    """Add ``stock_return`` and ``market_return``, NULL outside the newest 90 aligned pairs.

    ``align="position"`` pairs bar k of one series with bar k of the other, counted from the oldest
    bar of each slice; when the lengths differ the window ends at the shorter length. This is how
    the report has always been computed. ``align="date"`` pairs equal dates.

    The index holds at most 200 rows by construction, which is what makes the broadcast safe.
    """
    if index is None:
        missing = F.lit(None).cast("double")
        return sliced.withColumns({"stock_return": missing, "market_return": missing})
    if align == "position":
        return _by_position(sliced, index)
    if align == "date":
        return _by_date(sliced, index)
    raise ValueError(f"unknown alignment {align!r}")


def _by_position(sliced: DataFrame, index: DataFrame) -> DataFrame:
    joined = sliced.join(F.broadcast(index), sliced["i"] == index["m_i"], "left")
    if "prev_close" not in sliced.columns:
        joined = joined.withColumn("prev_close", F.expr(f"lag(close) OVER ({ASC})"))
    shorter = F.least("n", "m_n")
    used = (shorter >= ALIGNED_BARS) & (F.col("i") < shorter) & (F.col("i") > shorter - ALIGNED_BARS)
    return _pair(joined, used, F.col("prev_close"), F.col("m_prev"))


def _by_date(sliced: DataFrame, index: DataFrame) -> DataFrame:
    joined = sliced.join(F.broadcast(index), sliced["asof_date"] == index["m_date"], "left")
    both = F.col("m_close").isNotNull()
    earlier = f"{ASC} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    joined = joined.withColumns(
        {
            "_close": F.expr(f"last(if(m_close IS NOT NULL, close, NULL), true) OVER ({earlier})"),
            "_index": F.expr(f"last(m_close, true) OVER ({earlier})"),
            "_rank": F.expr(f"count(m_close) OVER ({DESC})"),
            "_shared": F.expr("count(m_close) OVER (PARTITION BY code)"),
        }
    )
    used = both & (F.col("_shared") >= ALIGNED_BARS) & (F.col("_rank") < ALIGNED_BARS)
    return _pair(joined, used, F.col("_close"), F.col("_index")).drop("_close", "_index", "_rank", "_shared")


def _pair(joined: DataFrame, used: Column, prev_close: Column, prev_index: Column) -> DataFrame:
    stock = F.try_divide(F.col("close"), prev_close) - 1.0
    market = F.try_divide(F.col("m_close"), prev_index) - 1.0
    valid = used & stock.isNotNull() & market.isNotNull()
    return joined.withColumns(
        {"stock_return": F.when(valid, stock), "market_return": F.when(valid, market)}
    ).drop("m_i", "m_date", "m_close", "m_prev", "m_n")


def market_aggregates() -> dict[str, Column]:
    """The eight statistics as aggregates over ``stock_return`` and ``market_return``."""
    y, x = "stock_return", "market_return"
    slope = f"coalesce(regr_slope({y}, {x}), 0.0D)"

    def beta(side: str) -> str:
        fit = f"regr_slope(if({x} {side} 0, {y}, NULL), if({x} {side} 0, {x}, NULL))"
        return f"if(count_if({x} {side} 0) >= 5, coalesce({fit}, 0.0D), NULL)"

    def capture(side: str) -> str:
        return f"try_divide(avg(if({x} {side} 0, {y}, NULL)), avg(if({x} {side} 0, {x}, NULL)))"

    squares = f"greatest(regr_syy({y}, {x}) - {slope} * regr_sxy({y}, {x}), 0.0D)"
    stats = {
        "beta": slope,
        "corr": f"coalesce(nanvl(corr({y}, {x}), 0.0D), 0.0D)",
        "rel_vol": f"stddev_samp({y}) / greatest(1e-12D, stddev_samp({x}))",
        "resid_vol": f"sqrt({squares} / greatest(1, count({x}) - 2))",
        "beta_up": beta(">"),
        "beta_down": beta("<"),
        "up_capture": capture(">"),
        "down_capture": capture("<"),
    }
    return {name: F.expr(f"if(count({x}) >= {MIN_PAIRS}, {stat}, NULL)") for name, stat in stats.items()}
