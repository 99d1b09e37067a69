"""Sources that may fail, one by one: what can be loaded is, what cannot is reported."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

REPORT = "source string, loaded long, rejected long, error string"


@dataclass
class Loaded:
    """``rows``: the usable rows of a source, None if it failed. ``rejected``: the others, with ``reason``."""

    name: str
    rows: DataFrame | None
    rejected: DataFrame | None
    n_loaded: int
    n_rejected: int
    error: str | None


def _name_of(error: Exception) -> str:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return condition or type(error).__name__


def load(spark: SparkSession, name: str, make: Callable[[], DataFrame], reason: Column) -> Loaded:
    """Run one source. ``reason`` is NULL for usable rows and else says why a row is not.

    One pass writes both kinds side by side into the shared folder and counts them on the way. A source that Spark cannot read,
    when planned or while it runs, leaves its error and no rows; other exceptions are faults of the program and go on.
    """
    path, counts = shared_dir(spark, f"source-{name}"), Observation(name)
    bad = F.col("reason").isNotNull()
    try:
        rows = make().withColumn("reason", reason)
        watched = rows.withColumn("bad", bad).observe(counts, F.count_if(~bad).alias("loaded"), F.count_if(bad).alias("rejected"))
        watched.write.partitionBy("bad").parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        return Loaded(name, None, None, 0, 0, _name_of(error))
    n = counts.get
    kept = spark.read.schema(rows.withColumn("bad", bad).schema).parquet(path) if n["loaded"] + n["rejected"] else rows.withColumn("bad", bad).limit(0)
    return Loaded(name, kept.filter("NOT bad").drop("bad", "reason"), kept.filter("bad").drop("bad"), n["loaded"], n["rejected"], None)


def report(spark: SparkSession, loaded: list[Loaded]) -> DataFrame:
    """One row per source: rows loaded and rejected, and the error of a source that failed."""
    return spark.createDataFrame([(x.name, x.n_loaded, x.n_rejected, x.error) for x in loaded], REPORT)
