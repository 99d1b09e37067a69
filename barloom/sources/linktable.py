"""The table of known links: plain Parquet in buckets by a hash of the link.

A batch reads the buckets that its links fall into, and of those the link column alone. Every batch adds one file to each bucket it has
new links for; a bucket with ``FILES`` of them is rewritten as one, so the number of files stays within buckets times ``FILES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import new_only
from ..session import materialised
from .tables import read_if_there

#: Fixed for the life of a table, because links are looked up by it.
BUCKETS = 16
#: Files of a bucket that are merged into one.
FILES = 8
_NOTE = "copy string, buckets array<int>"


def bucket_of(url: str, buckets: int):
    return F.pmod(F.xxhash64(F.trim(url)), F.lit(buckets)).cast("int")


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows with their bucket; None before the first batch."""
    return read_if_there(spark, f"{path}/rows")


def unseen(rows: DataFrame, table: DataFrame | None, touched: list[int]) -> DataFrame:
    """Rows (one per link, with ``bucket``) whose link the table does not have; only the touched buckets are listed and read."""
    if table is None:
        return rows
    known = table.filter(F.col("bucket").isin(touched)).select("url")
    return new_only(rows.withColumn("url", F.trim("url")), known, "url")


def add(spark: SparkSession, path: str, rows: DataFrame, buckets: int = BUCKETS) -> None:
    """Append the rows (one per link) whose links are new. Adding the same rows again changes nothing. One writer at a time."""
    finish_merge(spark, path)
    fresh = materialised(rows.withColumn("bucket", bucket_of("url", buckets)), "news-batch")
    touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())  # at most ``buckets`` numbers
    if touched:
        new = unseen(fresh, read(spark, path), touched).select(*fresh.columns)
        new.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/rows")
        merge_small(spark, path)


def crowded(table: DataFrame, most: int = FILES) -> list[int]:
    """Buckets with at least ``most`` files, from the listing alone."""
    files: dict[int, int] = {}
    for name in table.inputFiles():
        bucket = int(name.split("/bucket=")[1].split("/")[0])
        files[bucket] = files.get(bucket, 0) + 1
    return sorted(b for b, n in files.items() if n >= most)


def merge_small(spark: SparkSession, path: str, most: int = FILES) -> None:
    """Rewrite crowded buckets as one file each.

    Their rows are copied to the shared folder and the copy noted first: a swap that is cut off in the middle is done again from the copy
    when the next batch begins.
    """
    table = read(spark, path)
    full = crowded(table, most) if table is not None else []
    if not full:
        return
    copy = table.filter(F.col("bucket").isin(full))
    kept = materialised(copy, "news-merge")
    note = spark.createDataFrame([(kept.inputFiles()[0].rsplit("/", 1)[0], full)], _NOTE)
    note.coalesce(1).write.mode("overwrite").parquet(f"{path}/_merge")
    finish_merge(spark, path)


def finish_merge(spark: SparkSession, path: str) -> None:
    """Swap in the noted copy, if there is one, and drop the note."""
    note = read_if_there(spark, f"{path}/_merge", _NOTE)
    found = note.first() if note is not None else None
    if found is None:
        return
    rows = spark.read.parquet(found["copy"])
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/rows")
    spark.createDataFrame([], _NOTE).coalesce(1).write.mode("overwrite").parquet(f"{path}/_merge")
