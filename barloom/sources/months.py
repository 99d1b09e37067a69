"""Month summaries beside the price store: what a snapshot needs of months that no period cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.snapshot import month_state
from . import store


def refresh(spark: SparkSession, path: str, prices: str, months: list[int] | None = None) -> None:
    """Summarise months of the store anew and swap them in; all months without ``months``.

    Summaries are made from the store and not from the new bars, so a corrected or removed bar leaves no trace in a high or low, and a
    refresh that runs twice changes nothing. A load costs a read of the months it touched.
    """
    bars = store.read(spark, prices)
    wanted = bars if months is None else bars.filter(F.col("ym").isin(months))
    rows = month_state(wanted).repartition("ym")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(path)


def months_of(bars: DataFrame) -> list[int]:
    """The months of some bars: one number per month, on the driver."""
    return sorted(r[0] for r in bars.select((F.year("asof_date") * 100 + F.month("asof_date")).cast("int")).distinct().collect())


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
