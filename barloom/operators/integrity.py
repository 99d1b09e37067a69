"""Suspicious drops in stored bars: probable splits that were loaded without adjustment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DROP_PCT = 35.0
PRICE_FLOOR = 200.0


def _is_drop(prev: Column, close: Column, pct: float, floor: float) -> Column:
    drop = F.abs(F.try_divide(close - prev, prev)) * 100.0
    return (prev != 0.0) & (drop >= pct) & (close > floor) & (close < prev)


def suspicious_drops(bars: DataFrame, pct: float = DROP_PCT, floor: float = PRICE_FLOOR) -> DataFrame:
    """The newest suspicious drop per code, with the date of the code's second-newest bar.

    One pass: bars are paired inside a calendar year, so that no task holds the whole history of a code; every year is
    reduced to one row with its newest hit, first bar and last two days on the same partitioning, and only these rows meet
    per code, where the first bar of a year is compared with the last one before it.
    The repair statement is text for review and is never run. It names the second-newest date,
    which is where the report has always pointed; the date of the hit itself is ``asof_date``.
    """
    inside = Window.partitionBy("code", "year").orderBy("asof_date")
    pairs = bars.select("code", F.year("asof_date").alias("year"), "asof_date", "close").withColumns(
        {"prev_date": F.lag("asof_date").over(inside), "prev_close": F.lag("close").over(inside)}
    )
    hit = _is_drop(F.col("prev_close"), F.col("close"), pct, floor)
    years = pairs.withColumn("hit_date", F.when(hit, F.col("asof_date"))).groupBy("code", "year").agg(
        F.max("hit_date").alias("hit_date"),
        *[F.max_by(c, "hit_date").alias(f"hit_{c}") for c in ("close", "prev_date", "prev_close")],
        F.min("asof_date").alias("first_date"), F.min_by("close", "asof_date").alias("first_close"),
        F.max("asof_date").alias("last_date"), F.max_by("close", "asof_date").alias("last_close"),
        F.max_by("prev_date", "asof_date").alias("second_date"),
    )
    stitch = Window.partitionBy("code").orderBy("year")
    years = years.withColumns({c: F.lag(f"last_{c}").over(stitch).alias(c) for c in ("date", "close")})
    # A hit inside the year is newer than one at its first bar.
    edge = F.col("hit_date").isNull() & _is_drop(F.col("close"), F.col("first_close"), pct, floor)
    years = years.select(
        "code", "year", F.coalesce("second_date", "date").alias("second_date"),
        F.when(edge, F.col("first_date")).otherwise(F.col("hit_date")).alias("asof_date"),
        F.when(edge, F.col("first_close")).otherwise(F.col("hit_close")).alias("hit_close"),
        F.when(edge, F.col("date")).otherwise(F.col("hit_prev_date")).alias("prev_date"),
        F.when(edge, F.col("close")).otherwise(F.col("hit_prev_close")).alias("prev_close"),
    )
    per_code = years.groupBy("code").agg(
        *[F.max_by(c, "asof_date").alias(n) for c, n in (("hit_close", "close"), ("prev_date", "prev_date"), ("prev_close", "prev_close"))],
        F.max_by("second_date", "year").alias("repair_date"),
        F.max("asof_date").alias("asof_date"),
    )
    drop = F.abs(F.try_divide(F.col("close") - F.col("prev_close"), F.col("prev_close"))) * 100.0
    per_code = per_code.select("code", "asof_date", "close", "prev_date", "prev_close", drop.alias("drop_pct"), "repair_date")
    return per_code.filter(F.col("asof_date").isNotNull()).withColumn(
        "repair",
        F.format_string(
            "update prices_eod set close = 0 where code = '%s' and asof_date = '%s';",
            "code",
            F.date_format("repair_date", "yyyy-MM-dd"),
        ),
    )
