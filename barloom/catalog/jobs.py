"""Whole jobs from pages to reports, and what the writers wrote read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import announcements as A
from ..session import shared_dir
from ..sources import adapters, sinks, tables
from .extraction import NEWS_RULES, SITE, disclosure_pages, earnings_pages, holding_pages, news_blocks, paged_news

RUN_TS = "2024-01-28 12:00:00"
NOTICE_DAY, EARNINGS_DAY, HOLDING_DAY = "2001-06-15", "2024-01-20", "2002-01-05"
KEYWORDS = ("買い 増し", "会社1")


def _newest_first(day: str, key: str, late: int) -> str:
    """Reading position, newest day first; every ``late``-th row stands a day too early, where it ends the scan of the day before."""
    return f"(datediff(DATE'2030-01-01', {day}) - IF({key} % {late} = 0, 1, 0)) * 10000000000 + {key}"


def _disclosures(spark, d):
    orders = adapters.table(spark, d, "orders").filter("o_orderpriority <> '5-LOW'")
    watch = orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("code"))
    pages = disclosure_pages(spark, d, _newest_first("o_orderdate", "o_orderkey", 7))
    return A.disclosures(pages, F.lit(NOTICE_DAY).cast("date"), watch).select("code", "company", "kind", "title", "title_url", "day")


def _earnings_rows(spark, d):
    return A.earnings(earnings_pages(spark, d, _newest_first("ts", "event_id", 97)), F.lit(EARNINGS_DAY).cast("date"))


def _earnings(spark, d):
    return _earnings_rows(spark, d).drop(*A.PLACE)


def _earnings_counts(spark, d):
    return A.L.keyword_counts(_earnings_rows(spark, d)).select("label", "count")


def _holdings(spark, d):
    day = "make_date(2002, 1, cast(c_custkey % 9 + 1 AS int))"
    pages = holding_pages(spark, d, _newest_first(day, "c_custkey", 97))
    return A.holdings(pages, F.lit(HOLDING_DAY).cast("date"), SITE, KEYWORDS).select("date", "category", "reporter", "target", "code", "url", "title")


def _news_pages(spark, d):
    """Every event appears in one source; the links of a user's day are equal in all sources."""
    events = adapters.table(spark, d, "events")
    blocks = news_blocks(lambda _: F.concat(F.lit("n/"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "dd")))
    return {name: paged_news(events.filter(F.col("event_id") % 4 == k), b) for k, (name, b) in enumerate(blocks.items())}


def _news_sources():
    styles = ("iso", "run", "inferred", "inferred")
    return tuple(A.NewsSource(r, s, limited=s != "run") for r, s in zip(NEWS_RULES, styles))


def _known(spark, d):
    return adapters.table(spark, d, "events").filter("user_id % 7 = 0").select(
        F.concat(F.lit(f"{SITE}/n/"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "dd")).alias("url")
    )


def _shown(rows):
    return rows.select("source", "title", "url", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "id", "read")


def _news(spark, d):
    return _shown(A.rolling_news(_news_pages(spark, d), _news_sources(), F.lit(RUN_TS).cast("timestamp"), _known(spark, d)))


def _failing(spark, d):
    """The news job with stored pages per source; those of ``items`` are no Parquet files, and every tenth page of ``notes`` prints no date."""
    stored = {}
    for name, pages in _news_pages(spark, d).items():
        path = shared_dir(spark, f"pages-{name}")
        if name == "items":
            pages.select("html").write.text(path)
        else:
            unread = (F.lit(name) == "notes") & (F.col("page_id") % 10 == 0)
            html = F.when(unread, F.regexp_replace("html", r"\d{4}/\d\d/\d\d \d\d:\d\d", "soon")).otherwise(F.col("html"))
            pages.withColumn("html", html).write.parquet(path)
        stored[name] = lambda path=path, schema=pages.schema: spark.read.schema(schema).parquet(path)
    return A.rolling_news_guarded(stored, _news_sources(), F.lit(RUN_TS).cast("timestamp"), _known(spark, d))


def _news_failing(spark, d):
    return _shown(_failing(spark, d)[0])


def _news_report(spark, d):
    """What the sources gave: rows loaded and rejected, and whether one could not be read."""
    return _failing(spark, d)[1].select("source", "loaded", "rejected", F.col("error").isNotNull().alias("failed"))


def _sheet_codes(spark, d):
    """The first column of a spreadsheet with a byte-order mark."""
    path = shared_dir(spark, "sheet")
    parts = adapters.table(spark, d, "part").select("p_partkey", "p_name")
    sinks.write_csv(parts, path, {"p_partkey": "コード", "p_name": "銘柄名"}, bom=True)
    return tables.first_column(tables.read_sheet(spark, path, ("コード",))).select("code")


def _sheet_columns(spark, d):
    """Columns picked by header from a report with quotes and missing cells."""
    path = shared_dir(spark, "report")
    events = adapters.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
        F.concat(F.lit('"'), F.col("props"), F.lit('", '), F.col("event_type")).alias("note"),
    )
    sinks.write_csv(events, path, {"event_id": "番号", "event_type": " 種類 ", "note": "メモ"})
    sheet = tables.read_sheet(spark, path, ("番号", "種類", "メモ"))
    return sheet.select(F.col("番号").cast("bigint").alias("event_id"), F.col("種類").alias("event_type"), F.col("メモ").alias("note"))


QUERIES = {
    "job_disclosures": _disclosures,
    "job_earnings": _earnings,
    "job_earnings_counts": _earnings_counts,
    "job_holdings": _holdings,
    "job_news": _news,
    "job_news_failing": _news_failing,
    "job_news_report": _news_report,
    "sheet_codes": _sheet_codes,
    "sheet_columns": _sheet_columns,
}


def _place_sql(day: str, key: str, late: int) -> str:
    return f"(DATE '2030-01-01' - {day} - CASE WHEN {key} % {late} = 0 THEN 1 ELSE 0 END) * 10000000000 + {key}"


_EARNINGS_SQL = f"""e AS (SELECT *, CAST(ts AS DATE) AS day, {_place_sql('CAST(ts AS DATE)', 'event_id', 97)} AS pos FROM events WHERE event_id % 9 <> 0),
s AS (SELECT min(pos) AS stop FROM e WHERE day < DATE '{EARNINGS_DAY}'),
g AS (SELECT *, CASE event_id % 4 WHEN 0 THEN '最高益' WHEN 1 THEN '上方修正' WHEN 2 THEN '減益' ELSE 'ー' END AS class
  FROM e, s WHERE day = DATE '{EARNINGS_DAY}' AND (stop IS NULL OR pos < stop))"""

ORACLES = {
    "job_disclosures": f"""WITH o AS (SELECT *, CAST('20' || strftime(o_orderdate, '%y-%m-%d') AS DATE) AS day, {_place_sql('CAST(o_orderdate AS DATE)', 'o_orderkey', 7)} AS pos FROM orders),
s AS (SELECT min(pos) AS stop FROM o WHERE day < DATE '{NOTICE_DAY}')
SELECT 'O' || o_orderkey AS code, 'Firm & ' || o_custkey AS company, o_orderpriority AS kind, 'Notice <' || o_orderkey || '>' AS title,
  '/pdf/' || o_orderkey AS title_url, day FROM o, s
WHERE day = DATE '{NOTICE_DAY}' AND (stop IS NULL OR pos < stop) AND o_orderpriority <> '5-LOW'""",
    "job_earnings": f"""WITH {_EARNINGS_SQL} SELECT strftime(ts, '%m/%d') AS date, strftime(ts, '%H:%M') AS time, CAST(user_id AS VARCHAR) AS code, event_type AS company,
  ['最高益を更新', '業績を上方修正', '今期は減益', '配当を維持'][event_id % 4 + 1] || ' & ' || event_id AS body, class FROM g""",
    "job_earnings_counts": f"WITH {_EARNINGS_SQL} SELECT CASE WHEN class = 'ー' THEN 'その他' ELSE class END AS label, count(*) AS count FROM g GROUP BY class",
    "job_holdings": f"""WITH c AS (SELECT *, c_custkey AS k, DATE '2002-01-01' + CAST(c_custkey % 9 AS INTEGER) AS day FROM customer),
p AS (SELECT *, {_place_sql('day', 'k', 97)} AS pos FROM c), s AS (SELECT min(pos) AS stop FROM p WHERE day < DATE '{HOLDING_DAY}')
SELECT strftime(day, '%Y-%m-%d') AS date, CASE k % 3 WHEN 0 THEN '買い増し' WHEN 1 THEN '保有減少' ELSE '増' END AS category, c_name AS reporter,
  CASE WHEN k % 5 = 0 THEN '' ELSE '会社' || k END AS target, CASE WHEN k % 5 = 0 THEN 'Corp' ELSE lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS code,
  'https://site.example/r/' || k AS url, c_name || 'が' || CASE WHEN k % 5 = 0 THEN 'Corp' || lpad(CAST(k AS VARCHAR), 4, '0')
    ELSE '会社' || k || '＜' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || '＞' END
    || '株式の変更報告書を提出' || CASE k % 3 WHEN 0 THEN '（買い増し）' WHEN 1 THEN '（保有減少）' ELSE '' END AS title
FROM p, s WHERE day = DATE '{HOLDING_DAY}' AND (stop IS NULL OR pos < stop) AND (k % 3 = 0 OR (k % 5 <> 0 AND CAST(k AS VARCHAR) LIKE '1%'))""",
    "job_news": f"""WITH n AS (SELECT event_id, user_id, event_id % 4 AS k, ['A ', 'B & ', 'C ', 'D '][event_id % 4 + 1] || event_id AS title,
  ['cards', 'heads', 'items', 'notes'][event_id % 4 + 1] AS source, '{SITE}/n/' || user_id || '-' || strftime(ts, '%d') AS url,
  CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) + INTERVAL 9 HOUR WHEN 1 THEN TIMESTAMP '{RUN_TS}' ELSE date_trunc('minute', ts) END AS t FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY k, event_id) AS r FROM n WHERE k = 1 OR t >= TIMESTAMP '{RUN_TS}' - INTERVAL 8 DAY)
SELECT source, title, url, strftime(t, '%Y-%m-%d %H:%M:%S') AS ts, substr(sha256(strftime(t, '%Y-%m-%d %H:%M:%S') || '|' || title), 1, 16) AS id, '' AS read
FROM f WHERE r = 1 AND user_id % 7 <> 0""",
    "job_news_failing": f"""WITH n AS (SELECT event_id, user_id, event_id % 4 AS k, ['A ', 'B & ', 'C ', 'D '][event_id % 4 + 1] || event_id AS title,
  ['cards', 'heads', 'items', 'notes'][event_id % 4 + 1] AS source, '{SITE}/n/' || user_id || '-' || strftime(ts, '%d') AS url,
  CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) + INTERVAL 9 HOUR WHEN 1 THEN TIMESTAMP '{RUN_TS}' ELSE date_trunc('minute', ts) END AS t FROM events
  WHERE event_id % 4 <> 2 AND NOT (event_id % 4 = 3 AND event_id // 50 % 10 = 0)),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY k, event_id) AS r FROM n WHERE k = 1 OR t >= TIMESTAMP '{RUN_TS}' - INTERVAL 8 DAY)
SELECT source, title, url, strftime(t, '%Y-%m-%d %H:%M:%S') AS ts, substr(sha256(strftime(t, '%Y-%m-%d %H:%M:%S') || '|' || title), 1, 16) AS id, '' AS read
FROM f WHERE r = 1 AND user_id % 7 <> 0""",
    "job_news_report": """SELECT s AS source, CASE WHEN k = 2 THEN 0 ELSE (SELECT count(*) FROM events WHERE event_id % 4 = k AND NOT (k = 3 AND event_id // 50 % 10 = 0)) END AS loaded,
  CASE WHEN k = 3 THEN (SELECT count(*) FROM events WHERE event_id % 4 = 3 AND event_id // 50 % 10 = 0) ELSE 0 END AS rejected, k = 2 AS failed
FROM (VALUES ('cards', 0), ('heads', 1), ('items', 2), ('notes', 3)) v(s, k)""",
    "sheet_codes": "SELECT CAST(p_partkey AS VARCHAR) AS code FROM part",
    "sheet_columns": """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type, '"' || props || '", ' || event_type AS note FROM events""",
}
