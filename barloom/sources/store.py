"""The price table on plain Parquet: month and code-bucket partitions, rewritten only where touched.

A daily load rewrites the newest month. Replacing one code rewrites its bucket in the months it
has bars in, a ``1 / buckets`` share of the table, instead of the whole of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.load import KEY, merge_bars
from ..schemas import BARS
from ..session import materialised

BUCKETS = 16
PARTS = ["ym", "bucket"]
COLUMNS = BARS.fieldNames()
_META = "buckets int, columns string"


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("code"), F.lit(buckets)).cast("int"))


def _placed(df: DataFrame, buckets: int) -> DataFrame:
    month = (F.year("asof_date") * 100 + F.month("asof_date")).cast("int")
    return _bucketed(df.withColumn("ym", month), buckets)


def _values(df: DataFrame, column: str) -> list[int]:
    """Partition values on the driver: never more than the table has months or buckets."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _write(df: DataFrame, path: str) -> None:
    """``rebalance`` lets AQE split partitions that got too big and merge tiny ones: neither a hot
    code nor many small months decide the file sizes."""
    (
        df.hint("rebalance", *PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTS)
        .parquet(path)
    )


def create(bars: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A new store. The bucket count is kept with it, later writes follow it."""
    spark = bars.sparkSession
    _write(_placed(bars.select(*COLUMNS), buckets), path)
    spark.createDataFrame([(buckets, ",".join(COLUMNS))], _META).coalesce(1).write.mode("overwrite").parquet(f"{path}/_meta")


def buckets_of(spark: SparkSession, path: str) -> int:
    """The bucket count a store was created with; a store of other columns is refused."""
    meta = spark.read.schema(_META).parquet(f"{path}/_meta").first()
    if meta is None or meta["columns"] != ",".join(COLUMNS):
        raise ValueError(f"{path} is not a store of {COLUMNS}")
    return meta["buckets"]


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Bars of the store. A filter on ``ym`` prunes whole months."""
    return _stored(spark, path).filter(F.col("code") != "").select(*COLUMNS, "ym")


def upsert(
    spark: SparkSession, path: str, rows: DataFrame, replaced: DataFrame | None = None, buckets: int | None = None
) -> None:
    """Write unique (code, day) ``rows``; bars of ``replaced`` codes go first.

    The store's own bucket count is used; another one given as ``buckets`` is refused. One write job: new files
    are staged and swapped in, folder by folder, when all of them are complete, so a lost executor only
    repeats its tasks. The swap itself is not atomic: after a driver lost in the middle of it the staged
    files of a folder may still have to be moved, or the load run again from its feeds. Every touched partition also gets one row with a blank code, which
    ``read`` skips: without it a partition left empty by a replacement would keep its old files.
    """
    own = buckets_of(spark, path)
    if buckets not in (None, own):
        raise ValueError(f"{path} has {own} buckets, not {buckets}")
    buckets, stored = own, _stored(spark, path)
    fresh = _placed(rows.select(*COLUMNS), buckets)
    touched = fresh.select(*PARTS)
    if replaced is not None:
        homes = _values(_bucketed(replaced, buckets), "bucket")
        gone = stored.filter(F.col("bucket").isin(homes)).join(replaced.select("code"), "code", "left_semi")
        touched = touched.union(gone.select(*PARTS))
    touched = materialised(touched.distinct(), "touched")
    # Literal partition values prune the file listing; the broadcast table has one row per partition.
    near = F.col("ym").isin(_values(touched, "ym")) & F.col("bucket").isin(_values(touched, "bucket"))
    current = stored.filter(near & (F.col("code") != "")).join(F.broadcast(touched), PARTS, "left_semi")
    current = current.select(*COLUMNS, *PARTS)
    markers = touched.select(
        F.lit("").alias("code"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in BARS.fields[1:]],
        *PARTS,
    )
    _write(merge_bars(current, fresh, replaced).unionByName(markers), path)


def apply_load(spark: SparkSession, path: str, status: DataFrame, rows: DataFrame) -> None:
    """Write the result of ``plan_load``. The day's rows are used for the touched partitions, the keys
    to overwrite and the rows themselves, so they are computed once, into the shared folder."""
    replaced = status.filter(F.col("action") == "REPLACE").select("code")
    upsert(spark, path, materialised(rows, "load-rows"), materialised(replaced, "load-replaced"))


__all__ = ["BUCKETS", "KEY", "apply_load", "buckets_of", "create", "read", "upsert"]
