"""Price bars: null repair and newest-N slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_BARS = 200
MIN_BARS = 101


def repair_nulls(bars: DataFrame) -> DataFrame:
    """Missing open, high and low take the close, missing volume counts as 0, a missing close as 0.0."""
    close = F.coalesce("close", F.lit(0.0))
    fixed = {c: F.coalesce(c, close) for c in ("open", "high", "low")}
    return bars.withColumns({**fixed, "close": close, "volume": F.coalesce("volume", F.lit(0.0))})


def newest_n(bars: DataFrame, n: int, key: str = "code", order: str = "asof_date") -> DataFrame:
    """The newest ``n`` rows per key with their rank ``rd`` (1 = newest).

    The rank filter becomes a window group limit, so every task cuts its part to ``n`` rows
    per key *before* the shuffle: a key that holds a third of the table sends n rows per task.
    """
    newest_first = Window.partitionBy(key).orderBy(F.desc(order))
    return bars.withColumn("rd", F.row_number().over(newest_first)).filter(F.col("rd") <= n)


def newest_many(rows: DataFrame, n: int, key: str, day: str, order: list[str]) -> DataFrame:
    """The newest ``n`` rows per key with their rank ``rd``, for an ``n`` of thousands, where the group limit of ``newest_n`` no longer applies.

    A histogram of (key, month), summed in every task before its shuffle, tells how many rows of the key are newer than each month. Months that begin
    beyond ``n`` are dropped with their rows; in the others a row's rank is its rank in the month plus that number. So no window and no task
    holds more than one month of a key, and rows of older months are not ranked at all.

    ``order``: columns by which rows of one day are told apart, the greatest first. Rows without a day are the oldest.
    """
    month = F.coalesce(F.year(day) * 12 + F.month(day), F.lit(-1))
    counts = rows.groupBy(key, month.alias("_month")).agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy(key).orderBy(F.desc("_month")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0))).filter(F.col("_newer") < n).drop("_n")
    inside = Window.partitionBy(key, "_month").orderBy(F.desc_nulls_last(day), *[F.desc_nulls_last(c) for c in order])
    ranked = rows.withColumn("_month", month).join(counts, [key, "_month"]).withColumn("rd", F.col("_newer") + F.row_number().over(inside))
    return ranked.filter(F.col("rd") <= n).select(*rows.columns, "rd")


def slice_positions(bars: DataFrame, n: int = SLICE_BARS) -> DataFrame:
    """Newest ``n`` bars per code with bar count ``n`` and ascending position ``i`` from 0."""
    whole = Window.partitionBy("code")
    cut = newest_n(bars, n).withColumn("n", F.count(F.lit(1)).over(whole).cast("int"))
    return cut.withColumn("i", F.col("n") - F.col("rd"))


def latest_dates(bars: DataFrame) -> DataFrame:
    """Newest date per code; blank codes dropped."""
    return bars.filter(F.trim("code") != "").groupBy("code").agg(F.max("asof_date").alias("latest"))
