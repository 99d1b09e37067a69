"""News and bar streams. All end by themselves when the available input is used up (``availableNow``)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import load
from ..operators.bars import newest_n
from ..operators.news import MAX_AGE_DAYS, first_of_links, fresh_enough, with_ids
from ..sources import linktable, store
from ..sources.tables import read_if_there


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; the schema is given, never inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _unusable() -> Column:
    return F.col("ts").isNull() | (F.coalesce(F.trim("url"), F.lit("")) == "")


def rejected(news: DataFrame, reason: str = "unreadable time or blank link") -> DataFrame:
    """Rows a source delivered in unusable form, for an error table; the good rows go on."""
    return news.filter(_unusable()).withColumn("reason", F.lit(reason))


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


# ---- links in keyed state

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _too_old(run_ts: dt.datetime, days: int) -> Column:
    return F.col("ts") < F.lit(run_ts - dt.timedelta(days=days))


def unseen_links(news: DataFrame, run_ts: dt.datetime, days: int = MAX_AGE_DAYS) -> DataFrame:
    """(url, seen) of every link that no earlier row of the stream had: keyed state with a time to live, no table is read.

    The event time of the state is the clock of the run, not the article's: no order of files makes a row late, and a link is forgotten
    once ``days`` have passed since the run that saw it first. From then on its own rows, which are older than that run, are beyond the
    age limit and belong to ``late_rows``, so nothing comes twice. The state lives in RocksDB on the executors' disks and in the checkpoint.
    """
    rows = news.filter(~_unusable() & ~_too_old(run_ts, days))
    seen = rows.select(F.trim("url").alias("url"), F.lit(run_ts).cast("timestamp").alias("seen"))
    return seen.withWatermark("seen", f"{days} days").dropDuplicatesWithinWatermark(["url"])


def late_rows(news: DataFrame, run_ts: dt.datetime, days: int = MAX_AGE_DAYS) -> DataFrame:
    """Rows beyond the age limit, whole."""
    return news.filter(~_unusable() & _too_old(run_ts, days))


def links_to_table(
    news: DataFrame, path: str, late_path: str, checkpoint: str, run_ts: dt.datetime, days: int = MAX_AGE_DAYS
) -> tuple[StreamingQuery, StreamingQuery]:
    """Every link once into ``path``, every row beyond the age limit into ``late_path``: together all usable rows' links.

    Both are exactly-once file sinks of their own checkpoints below ``checkpoint``, to be kept from run to run; ``run_ts`` must not go back.
    """
    spark = news.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return tuple(
            rows.writeStream.format("parquet").option("path", to).option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True).start()
            for name, rows, to in (("links", unseen_links(news, run_ts, days), path), ("late", late_rows(news, run_ts, days), late_path))
        )
    finally:
        spark.conf.set(STATE_STORE, before)


# ---- news in a bucketed table


def news_to_table(
    news: DataFrame, path: str, checkpoint: str, order: list[str], run_ts: Column | None = None, buckets: int = linktable.BUCKETS
) -> StreamingQuery:
    """Add the unseen links of every batch to a table in buckets by link (``sources.linktable``).

    Of the rows of one link the first in ``order`` wins within a batch; across batches the first *batch* wins, as an article once shown
    stays as it was. A batch that runs again after a failure finds its own links known, whole or in part, and adds what is missing.
    With ``run_ts`` rows over the age limit are left out.
    """
    young = news if run_ts is None else fresh_enough(news, run_ts)

    def each(batch: DataFrame, number: int) -> None:
        linktable.add(batch.sparkSession, path, with_ids(first_of_links(batch.filter(~_unusable()), order)), buckets)

    return _start(young, checkpoint, each)


# ---- the daily load


def stage_bars(bars: DataFrame, checkpoint: str) -> StreamingQuery:
    """Keep the rows of every batch until the run is complete; a repeated batch replaces its own."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{checkpoint}/rows/batch={number}")

    return _start(bars, f"{checkpoint}/stream", each)


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch whose rows a run has loaded; -1 before the first."""
    done = read_if_there(spark, f"{checkpoint}/done", "batch long")
    return -1 if done is None else done.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]


def bars_to_store(
    bars: DataFrame, codes: DataFrame, path: str, checkpoint: str, run_date: Column, full: DataFrame | None = None
) -> DataFrame:
    """Run the daily load over everything that has come in, however it is cut into files; returns the status per code.

    What a code needs (nothing, newer days, all of it) and whether its days are unique can only be told from all of its rows. So a run

    1. freezes what the store knew before it: the newest bars per code, from which the last stored day and the split check follow;
    2. stages the stream, batch by batch;
    3. plans the load on all staged rows against the frozen bars, and writes once.

    ``seq`` is the reading order of the rows, ``full`` the feed for full and replacing loads. A run that was cut off anywhere goes on with
    its frozen bars and all rows that no run has loaded, so it ends as if it had not been; writing the same bars again changes nothing.
    """
    spark = bars.sparkSession
    done = _committed(spark, checkpoint)
    frozen = f"{checkpoint}/before/after={done}"
    if read_if_there(spark, frozen, load.FROZEN) is None:
        newest_n(store.read(spark, path), load.SPLIT_BARS).select("code", "asof_date", "close").write.mode("overwrite").parquet(frozen)
    stage_bars(bars, checkpoint).awaitTermination()
    staged = read_if_there(spark, f"{checkpoint}/rows", bars.schema.add("batch", "long"))
    if staged is None:
        staged = spark.createDataFrame([], bars.schema.add("batch", "long"))
    fresh = staged.filter(F.col("batch") > done)
    status, rows = load.plan_load(codes, spark.read.schema(load.FROZEN).parquet(frozen), fresh.drop("batch"), full, run_date)
    store.apply_load(spark, path, status, rows)
    last = fresh.agg(F.max("batch")).first()[0]
    if last is not None:
        spark.createDataFrame([(last,)], "batch long").coalesce(1).write.mode("append").parquet(f"{checkpoint}/done")
    return status


def upserts_to_store(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Last-wins upsert of every batch, without load decisions."""

    def each(batch: DataFrame, number: int) -> None:
        store.upsert(batch.sparkSession, path, load.last_wins(batch, load.KEY, ["seq"]))

    return _start(bars, checkpoint, each)
