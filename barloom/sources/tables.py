"""Readers: price tables, spreadsheet exports and stored pages. Connections are caller options."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BARS, RAW_BARS

BOM = "\ufeff"


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A Parquet table, or None while nothing has been written to ``path``."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return table if schema is None else spark.read.schema(schema).parquet(path)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars from Parquet with the canonical schema; no inference, so filters and columns push down."""
    return spark.read.schema(BARS).parquet(path)


def read_bars_jdbc(spark: SparkSession, splits: int = 32, **options: str) -> DataFrame:
    """Bars from a database table. All of url, dbtable, user and so on come from the caller.

    The read is split by day, given ``lowerBound`` and ``upperBound`` dates, so no single task
    and no single code holds the table.
    """
    if {"lowerBound", "upperBound"} <= options.keys():
        options = {"partitionColumn": "asof_date", "numPartitions": str(splits), **options}
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*[F.col(f.name).cast(f.dataType) for f in BARS.fields])


def read_raw_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars as text, to be checked by ``validate_rows``."""
    return spark.read.schema(RAW_BARS).options(header=True, escape='"').csv(path)


def read_sheet(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A spreadsheet export: header names trimmed and freed from a byte-order mark, rows numbered.

    ``row_idx`` follows the order of the file; blank lines are skipped by the reader, doubled quotes are one. A missing
    required column fails here, before anything runs.
    """
    raw = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    df = raw.toDF(*[c.removeprefix(BOM).strip() for c in raw.columns])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.withColumn("row_idx", F.monotonically_increasing_id())


def first_column(sheet: DataFrame) -> DataFrame:
    """The first column as ``code``, in sheet order."""
    name = next(c for c in sheet.columns if c != "row_idx")
    return sheet.select(F.col(name).alias("code"), "row_idx")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored page files, one row per file."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
