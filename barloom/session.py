"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "barloom", partitions: int | None = None) -> SparkSession:
    """A local session; on a cluster the caller brings their own."""
    n = str(partitions or (os.cpu_count() or 8 if cores == "*" else int(cores)))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.adaptive.enabled", "true")
        # Small local data: keep all cores busy instead of merging partitions up to 1 MB.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BARLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a temporary folder is used and set,
    so a cluster never falls back to a folder that only one machine sees.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="barloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back: used several times, computed once.

    Unlike a cache it survives lost executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
