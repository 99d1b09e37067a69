"""Rolling news: dedupe, age, ids, and the streaming jobs over the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import news as N
from ..session import materialised, shared_dir
from ..sources import adapters, linktable, sinks, store
from ..streaming import jobs
from .common import SQL_BARS_BRAND, rounded

RUN_TS = "2024-01-28 12:00:00"
# Rank of the sources, first wins.
SOURCES = ("purchase", "signup", "click", "view", "error")

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    ]
)


def _as_news(events):
    """Events as articles: one link per user and day, source by type. A few have no time or no link."""
    k = F.col("event_id")
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("event_type"))
    link = F.concat(F.lit("https://n.example/"), F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyyMMdd"))
    return events.select(
        "event_id", F.when(k % 101 != 0, F.col("ts").cast("timestamp")).alias("ts"), F.col("event_type").alias("source"),
        F.col("props").alias("title"), F.when(k % 103 == 0, " ").otherwise(link).alias("url"), rank.cast("int").alias("source_rank"),
    )


def _rows(spark, d):
    return _as_news(adapters.table(spark, d, "events"))


def _history(rows):
    """Links of every seventh user count as known."""
    user = F.regexp_extract("url", r"example/(\d+)/", 1).try_cast("int")
    return rows.filter(user % 7 == 0).select("url")


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _dedupe(spark, d):
    rows = _rows(spark, d).filter("trim(url) <> '' AND ts IS NOT NULL")
    return N.merge_news(rows, _history(rows), ["source_rank", "event_id"]).select("url", "event_id", "source")


def _age(spark, d):
    return N.fresh_enough(_rows(spark, d), _run_ts()).select("event_id")


def _age_some(spark, d):
    return N.fresh_enough(_rows(spark, d), _run_ts(), only=F.col("source").isin("view", "error")).select("event_id")


def _ids(spark, d):
    return N.with_ids(_rows(spark, d).filter("ts IS NOT NULL")).select("event_id", "id", "read")


def _sorted(spark, d):
    rows = N.with_ids(_rows(spark, d)).filter("ts IS NOT NULL")
    return sinks.newest_first(rows).select("event_id", "id")


def _rejected(spark, d):
    return jobs.rejected(_rows(spark, d)).select("event_id", "reason")


def _event_files(spark, d):
    """All events as files that arrive out of order: the newest days, then the oldest, then the rest. A user's day is in one file,
    because across batches the first batch wins, not the first source."""
    events = adapters.table(spark, d, "events").select(*EVENTS.fieldNames())
    path, day = shared_dir(spark, "event-files"), F.dayofmonth("ts")
    for part in (F.coalesce(day > 20, F.lit(True)), day <= 10, (day > 10) & (day <= 20)):
        events.filter(part).repartition(2, "user_id", F.to_date("ts")).write.mode("append").parquet(path)
    return jobs.file_stream(spark, path, EVENTS, files_per_batch=2)


def _table_stream(spark, d):
    """The news table written by two runs of the stream job: the second, with a checkpoint of its own, adds nothing twice."""
    events, path = _as_news(_event_files(spark, d)), shared_dir(spark, "news")
    for _ in range(2):
        jobs.news_to_table(events, path, shared_dir(spark, "news-ckpt"), ["source_rank", "event_id"]).awaitTermination()
    return linktable.read(spark, path).select("url", "event_id", "source")


def _recent_stream(spark, d):
    """The same with the age limit of the rolling table."""
    path = shared_dir(spark, "news")
    order = ["source_rank", "event_id"]
    jobs.news_to_table(_as_news(_event_files(spark, d)), path, shared_dir(spark, "news-ckpt"), order, _run_ts()).awaitTermination()
    return linktable.read(spark, path).select("url", "event_id", "source")


def _link_stream(spark, d):
    """Links once and rows beyond the age limit apart, from files of all events cut at random, the same links in several files."""
    path, late, ckpt, files = (shared_dir(spark, n) for n in ("links", "late", "links-ckpt", "event-files"))
    events = adapters.table(spark, d, "events").select(*EVENTS.fieldNames())
    for k in (2, 0, 1):
        events.filter(F.pmod("event_id", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(files)
    stream = _as_news(jobs.file_stream(spark, files, EVENTS, files_per_batch=1))
    for query in jobs.links_to_table(stream, path, late, ckpt, dt.datetime.fromisoformat(RUN_TS)):
        query.awaitTermination()
    once = spark.read.parquet(path).select("url", F.lit(False).alias("late"))
    return once.union(spark.read.parquet(late).select("url", F.lit(True)).distinct())


def _bars_stream(spark, d):
    """Brand bars arriving in three parts, the middle one last, upserted batch by batch into a store that starts with old bars."""
    bars = materialised(adapters.bars_brand(spark, d), "bars")
    old = bars.filter("year(asof_date) < 1996").withColumn("close", F.col("close") * 0)
    path, incoming = shared_dir(spark, "prices"), shared_dir(spark, "incoming")
    store.create(old, path, buckets=2)
    for k, part in enumerate(("month(asof_date) <= 4", "month(asof_date) > 8", "month(asof_date) BETWEEN 5 AND 8")):
        bars.filter(part).withColumn("seq", F.lit(k)).repartition("code").write.mode("append").parquet(incoming)
    schema = bars.withColumn("seq", F.lit(0)).schema
    jobs.upserts_to_store(jobs.file_stream(spark, incoming, schema), path, shared_dir(spark, "bars-ckpt")).awaitTermination()
    return rounded(store.read(spark, path).drop("ym"))


QUERIES = {
    "news_dedupe": _dedupe,
    "news_age": _age,
    "news_age_some_sources": _age_some,
    "news_id": _ids,
    "news_sorted": _sorted,
    "news_rejected": _rejected,
    "news_table_stream": _table_stream,
    "news_recent_stream": _recent_stream,
    "news_stream": _link_stream,
    "bars_stream": _bars_stream,
}

_NEWS = f"""n AS (SELECT event_id, CASE WHEN event_id % 101 <> 0 THEN date_trunc('microsecond', ts) END AS ts, event_type AS source, props AS title, user_id,
  CASE WHEN event_id % 103 = 0 THEN ' ' ELSE 'https://n.example/' || user_id || '/' || strftime(ts, '%Y%m%d') END AS url,
  list_position([{', '.join(repr(s) for s in SOURCES)}], event_type) AS source_rank FROM events)"""
_FIRST = """f AS (SELECT url, event_id, source, user_id, row_number() OVER (PARTITION BY url ORDER BY source_rank, event_id) AS k
  FROM n WHERE trim(url) <> '' AND ts IS NOT NULL)"""

ORACLES = {
    "news_dedupe": f"WITH {_NEWS}, {_FIRST} SELECT url, event_id, source FROM f WHERE k = 1 AND user_id % 7 <> 0",
    "news_age": f"WITH {_NEWS} SELECT event_id FROM n WHERE ts >= TIMESTAMP '{RUN_TS}' - INTERVAL 8 DAY",
    "news_age_some_sources": f"WITH {_NEWS} SELECT event_id FROM n WHERE ts >= TIMESTAMP '{RUN_TS}' - INTERVAL 8 DAY OR source NOT IN ('view', 'error')",
    "news_id": f"WITH {_NEWS} SELECT event_id, substr(sha256(strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || title), 1, 16) AS id, '' AS read FROM n WHERE ts IS NOT NULL",
    "news_sorted": f"WITH {_NEWS} SELECT event_id, substr(sha256(strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || title), 1, 16) AS id FROM n WHERE ts IS NOT NULL ORDER BY ts DESC, id",
    "news_rejected": f"WITH {_NEWS} SELECT event_id, 'unreadable time or blank link' AS reason FROM n WHERE ts IS NULL OR trim(url) = ''",
    "news_table_stream": f"WITH {_NEWS}, {_FIRST} SELECT url, event_id, source FROM f WHERE k = 1",
    "news_recent_stream": f"""WITH {_NEWS}, f AS (SELECT url, event_id, source, row_number() OVER (PARTITION BY url ORDER BY source_rank, event_id) AS k
  FROM n WHERE trim(url) <> '' AND ts >= TIMESTAMP '{RUN_TS}' - INTERVAL 8 DAY) SELECT url, event_id, source FROM f WHERE k = 1""",
    "news_stream": f"""WITH {_NEWS} SELECT DISTINCT url, ts < TIMESTAMP '{RUN_TS}' - INTERVAL 8 DAY AS late FROM n
  WHERE ts IS NOT NULL AND trim(url) <> ''""",
    "bars_stream": f"WITH {SQL_BARS_BRAND} SELECT code, asof_date, "
    + ", ".join(f"floor({c} * 1000000.0 + 0.5003) / 1000000.0 AS {c}" for c in ("open", "high", "low", "close", "volume")) + " FROM bars_brand",
}
