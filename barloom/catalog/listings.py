"""Snapshot lists, target-day selection, classification and keyword jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text, titles
from ..operators import keywords as K
from ..operators import listings as L
from ..plans import snapshot as S
from ..session import materialised, shared_dir
from ..sources import adapters, months, store
from .common import SQL_BARS_SUPPLIER, r6, rounded

# A day on which every full list of the snapshot has codes.
DAY = "1995-02-13"
WORDS = ("license", "error", "ouvi", "sch", "tion", "eau", "ing")
WATCH = ("click", "SIGNUP", "none")


def _snapshot(spark, d):
    nations = adapters.table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("market"))
    suppliers = adapters.table(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    names = suppliers.select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"), "market")
    return rounded(S.snapshot(adapters.bars_supplier(spark, d), F.lit(DAY), names=names).drop("sort"))


#: Days of the job over several days: all days of DAY's week and of the weeks before.
DAYS = [dt.date.fromisoformat(DAY) - dt.timedelta(days=k) for k in range(20)]


def _several_days(spark, d):
    """Snapshots of twenty days in one job, from the price store and its month summaries, both kept up to date load by load: the days before
    first, with one code at wrong prices, then the days themselves in three loads with the corrections."""
    bars = materialised(adapters.bars_supplier(spark, d), "bars")
    prices, summaries = shared_dir(spark, "prices"), shared_dir(spark, "months")
    first, last = min(DAYS), max(DAYS)
    wrong = F.col("code") == "1"
    old = bars.filter((F.col("asof_date") < F.lit(first))).withColumn("close", F.when(wrong, F.col("close") * 9).otherwise(F.col("close")))
    store.create(old, prices, buckets=2)
    months.refresh(spark, summaries, prices)
    fresh = bars.filter(F.col("asof_date") <= F.lit(last)).filter((F.col("asof_date") >= F.lit(first)) | wrong)
    for k in (2, 0, 1):
        load = materialised(fresh.filter(F.pmod(F.dayofmonth("asof_date"), F.lit(3)) == k), "load")
        store.upsert(spark, prices, load)
        months.refresh(spark, summaries, prices, months.months_of(load))
    lists = S.snapshots(store.read(spark, prices), months.read(spark, summaries), DAYS)
    return rounded(lists.drop("sort"))


def _counts(spark, d):
    return S.snapshot_counts(adapters.bars_supplier(spark, d), F.lit(DAY))


def _listing(spark, d):
    """Events as five listings, newest first; every 97th row is dated a day late."""
    e = adapters.table(spark, d, "events")
    late = F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    return e.select(
        F.col("event_type").alias("listing"), "event_id", "user_id", "props",
        F.date_sub(F.col("ts").cast("date"), late).alias("day"),
        (-F.col("event_id")).alias("pos"),
    )


def _target(spark, d):
    rows = _listing(spark, d)
    target = rows.agg(F.date_sub(F.max("day"), 1)).scalar()
    return L.target_day(rows, F.col("day"), target, ["pos"], ["listing"]).select("listing", "event_id", "day")


def _target_one(spark, d):
    """One listing of everything, started only when its own newest day is the run date."""
    rows = _listing(spark, d)
    newest = rows.agg(F.max("day")).scalar()
    got = L.target_day(rows, F.col("day"), newest, ["pos"])
    return L.gated(got, newest, F.to_date(F.lit("2024-01-30"))).select("listing", "event_id", "day")


def _watch(spark, d):
    return L.watched(_listing(spark, d), list(WATCH), "listing").select("event_id", "listing")


def _watch_table(spark, d):
    codes = adapters.table(spark, d, "nation").select(F.lower(F.concat(F.lit("brand#"), F.col("n_nationkey"))).alias("code"))
    return L.watched(adapters.table(spark, d, "part"), codes, "p_brand").select("p_partkey", "p_brand")


def _documents(spark, d):
    return adapters.table(spark, d, "documents")


def _classed(spark, d):
    return _documents(spark, d).select("doc_id", titles.first_keyword(F.col("text"), WORDS).alias("class"))


def _keyword_counts(spark, d):
    return L.keyword_counts(_classed(spark, d), keywords=WORDS)


_HIT_WORDS = ("license", "l i c e n s e d", "open  source", "")


def _hits(spark, d):
    """Documents that mention a keyword, one per (source, length) link."""
    docs = _documents(spark, d).select(
        "doc_id", F.col("text").alias("title"),
        F.when(F.col("doc_id") % 10 == 3, "").otherwise(F.concat_ws("/", "source", (F.col("n_chars") % 50).cast("string"))).alias("url"),
    )
    return docs


def _keyword_hits(spark, d):
    return L.keyword_hits(_hits(spark, d), _HIT_WORDS, ["doc_id"]).select("url", "doc_id")


def _keyword_table(spark, d):
    """Documents and the first of thousands of keywords they contain: words of at least nine characters of the conversations, by first use."""
    turns = adapters.table(spark, d, "conversations")
    words = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("rank"), F.explode(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("keyword"))
    listed = words.filter(F.length("keyword") >= 9).groupBy("keyword").agg(F.min("rank").alias("rank"))
    docs = adapters.table(spark, d, "documents").select("doc_id", "text")
    return K.first_listed(docs, listed, "text").select("doc_id", "keyword", "keyword_rank")


def _title_split(spark, d):
    split = titles.company_and_body(F.col("text"))
    return _documents(spark, d).select(
        "doc_id", F.md5(split["company"]).alias("company"), F.length(split["company"]).alias("n_company"),
        F.md5(split["body"]).alias("body"), F.length(split["body"]).alias("n_body"),
    )


def _union_two(spark, d):
    """Day and week gainers as two labelled lists of different width."""
    m = S.day_metrics(adapters.bars_supplier(spark, d), F.lit(DAY))
    up = L.top_in_order(m.filter("diff_pct IS NOT NULL").withColumn("g", F.lit(1)), L.TOP_NIGHT, ["g"], [F.desc("diff_pct"), F.col("code")])
    base = L.top_in_order(m.filter("base_7d IS NOT NULL").withColumn("g", F.lit(1)), L.TOP_NIGHT, ["g"], [F.desc("base_7d"), F.col("code")])
    return rounded(L.labelled_union({"up": up.select("code", "rank", "price", "diff_pct"), "base": base.select("code", "rank", "base_7d")}))


def _links(spark, d):
    p = adapters.table(spark, d, "pages")
    title = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    return p.select("page_id", text.hyperlink_cell(F.when(F.col("page_id") % 4 != 0, F.col("url")), F.when(F.col("page_id") % 3 == 0, "").otherwise(title), F.concat(F.lit('say "'), F.col("url"), F.lit('"'))).alias("cell"))


QUERIES = {
    "snapshot_lists": _snapshot,
    "snapshot_counts": _counts,
    "snapshot_days": _several_days,
    "target_day_scan": _target,
    "target_day_single": _target_one,
    "watch_list": _watch,
    "watch_list_table": _watch_table,
    "keyword_class": _classed,
    "keyword_counts": _keyword_counts,
    "keyword_hits": _keyword_hits,
    "keyword_table": _keyword_table,
    "title_split": _title_split,
    "labelled_union": _union_two,
    "hyperlink_cells": _links,
}

_METRICS = f"""
m0 AS (
  SELECT code, max(close) FILTER (asof_date = DATE '{DAY}') AS price, max(volume) FILTER (asof_date = DATE '{DAY}') AS volume,
    arg_max(close, asof_date) FILTER (asof_date < DATE '{DAY}') AS prev,
    max(close) FILTER (asof_date < DATE '{DAY}' AND asof_date >= DATE '{DAY}' - 364) AS high_52w,
    min(close) FILTER (asof_date < DATE '{DAY}' AND asof_date >= DATE '{DAY}' - 364) AS low_52w,
    max(close) FILTER (asof_date < DATE '{DAY}' AND asof_date >= date_trunc('year', DATE '{DAY}')) AS high_ytd,
    min(close) FILTER (asof_date < DATE '{DAY}' AND asof_date >= date_trunc('year', DATE '{DAY}')) AS low_ytd,
    arg_max(close, asof_date) FILTER (asof_date < date_trunc('week', DATE '{DAY}')) AS base_week,
    arg_max(close, asof_date) FILTER (asof_date < date_trunc('month', DATE '{DAY}')) AS base_month,
    arg_max(close, asof_date) FILTER (asof_date < date_trunc('year', DATE '{DAY}')) AS base_year,
    arg_max(close, asof_date) FILTER (asof_date <= DATE '{DAY}' - 7) AS base_7d,
    arg_max(close, asof_date) FILTER (asof_date <= DATE '{DAY}' - INTERVAL 1 MONTH) AS base_1m,
    arg_max(close, asof_date) FILTER (asof_date <= DATE '{DAY}' - INTERVAL 1 YEAR) AS base_1y
  FROM src GROUP BY code),
m AS (SELECT *, price - prev AS diff, (price / nullif(prev, 0) - 1) * 100 AS diff_pct FROM m0 WHERE price IS NOT NULL)"""


def _top_sql(k: int, name: str, order: str, condition: str, diff: str = "diff", pct: str = "diff_pct", amount: str = "CAST(NULL AS DOUBLE)") -> str:
    return (
        f"SELECT {k} AS list_rank, '{name}' AS list, CAST(row_number() OVER (ORDER BY {order}, code) AS INTEGER) AS rank, code, price, "
        f"{diff} AS diff, {pct} AS diff_pct, {amount} AS amount FROM m WHERE {condition}"
    )


def _full_sql(k: int, name: str, condition: str) -> str:
    return f"SELECT {k}, '{name}', CAST(NULL AS INTEGER), code, price, diff, diff_pct, CAST(NULL AS DOUBLE) FROM m WHERE {condition}"


def _change_sql(k: int, name: str, base: str, falling: str) -> str:
    change = f"(price - {base}) / nullif({base}, 0) * 100"
    return _top_sql(k, name, f"price / nullif({base}, 0) {falling}", f"{base} <> 0", f"price - {base}", change, base)


# The expected lists, written from the report and not from the rules under test.
_ENTRIES = " UNION ALL ".join(
    [
        _top_sql(1, "売買代金", "price * volume DESC", "true", amount="price * volume"),
        _top_sql(2, "出来高", "volume DESC", "price >= 100", amount="volume"),
        _top_sql(3, "今日の株価上昇率", "diff_pct DESC", "diff_pct IS NOT NULL"),
        _top_sql(4, "今日の株価下落率", "diff_pct", "diff_pct IS NOT NULL"),
        _full_sql(5, "本日、52週高値更新", "price > high_52w"),
        _full_sql(6, "本日、52週安値更新", "price < low_52w"),
        _full_sql(7, "本日、年初来高値更新", "price > high_ytd"),
        _full_sql(8, "本日、年初来安値更新", "price < low_ytd"),
        _change_sql(9, "今週の株価上昇率", "base_week", "DESC"),
        _change_sql(10, "今月の株価上昇率", "base_month", "DESC"),
        _change_sql(11, "今年の株価上昇率", "base_year", "DESC"),
        _change_sql(12, "過去1週間の株価上昇率", "base_7d", "DESC"),
        _change_sql(13, "過去1ヵ月の株価上昇率", "base_1m", "DESC"),
        _change_sql(14, "過去1年の株価上昇率", "base_1y", "DESC"),
        _change_sql(15, "今週の株価下落率", "base_week", "ASC"),
        _change_sql(16, "今月の株価下落率", "base_month", "ASC"),
        _change_sql(17, "今年の株価下落率", "base_year", "ASC"),
        _change_sql(18, "過去1週間の株価下落率", "base_7d", "ASC"),
        _change_sql(19, "過去1ヵ月の株価下落率", "base_1m", "ASC"),
        _change_sql(20, "過去1年の株価下落率", "base_1y", "ASC"),
    ]
)


def _one_day_sql(day: str) -> str:
    """The single run of one day."""
    return f"""SELECT DATE '{day}' AS t, list_rank, list, rank, code, {r6('price', 'price')}, {r6('diff', 'diff')}, {r6('diff_pct', 'diff_pct')}, {r6('amount', 'amount')}
FROM (WITH {_METRICS.replace(DAY, day)} SELECT * FROM ({_ENTRIES}) WHERE rank IS NULL OR rank <= 20)"""


# Separators of company and body, in the order in which they are tried.
_SEPARATORS = ("、", "：", ":", "／", "/", " - ", "-")

_LISTING = """listing AS (SELECT event_type AS listing, event_id, user_id, props,
  CAST(ts AS DATE) - CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS day, -event_id AS pos FROM events)"""

ORACLES = {
    "snapshot_lists": f"""WITH {SQL_BARS_SUPPLIER}, src AS (SELECT * FROM bars_supplier), {_METRICS}, e AS ({_ENTRIES}),
names AS (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name, n_name AS market FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
SELECT list_rank, list, rank, code, name, market, {r6('price', 'price')}, {r6('diff', 'diff')}, {r6('diff_pct', 'diff_pct')}, {r6('amount', 'amount')}
FROM e LEFT JOIN names USING (code) WHERE rank IS NULL OR rank <= 20""",
    "snapshot_counts": f"""WITH {SQL_BARS_SUPPLIER}, src AS (SELECT * FROM bars_supplier), {_METRICS}
SELECT 5 AS list_rank, '本日、52週高値更新' AS list, count(*) FILTER (price > high_52w) AS codes FROM m
UNION ALL SELECT 6, '本日、52週安値更新', count(*) FILTER (price < low_52w) FROM m
UNION ALL SELECT 7, '本日、年初来高値更新', count(*) FILTER (price > high_ytd) FROM m
UNION ALL SELECT 8, '本日、年初来安値更新', count(*) FILTER (price < low_ytd) FROM m""",
    "snapshot_days": f"""WITH {SQL_BARS_SUPPLIER}, src AS MATERIALIZED (SELECT * FROM bars_supplier)
{" UNION ALL ".join(_one_day_sql(str(day)) for day in DAYS)}""",
    "target_day_scan": f"""WITH {_LISTING}, t AS (SELECT max(day) - 1 AS target FROM listing),
stops AS (SELECT listing, min(pos) AS stop FROM listing, t WHERE day < target GROUP BY listing)
SELECT l.listing, event_id, day FROM listing l JOIN t ON day = target LEFT JOIN stops s ON s.listing = l.listing WHERE stop IS NULL OR pos < stop""",
    "target_day_single": f"""WITH {_LISTING}, t AS (SELECT max(day) AS target FROM listing),
stops AS (SELECT min(pos) AS stop FROM listing, t WHERE day < target)
SELECT listing, event_id, day FROM listing, t, stops WHERE day = target AND target = DATE '2024-01-30' AND (stop IS NULL OR pos < stop)""",
    "watch_list": "SELECT event_id, event_type AS listing FROM events WHERE upper(event_type) IN ('CLICK', 'SIGNUP', 'NONE')",
    "watch_list_table": """SELECT p_partkey, p_brand FROM part
WHERE upper(p_brand) IN (SELECT upper('brand#' || n_nationkey) FROM nation)""",
    "keyword_class": "SELECT doc_id, CASE " + " ".join(f"WHEN contains(text, '{w}') THEN '{w}'" for w in WORDS) + " ELSE 'ー' END AS class FROM documents",
    "keyword_counts": "WITH c AS (SELECT CASE " + " ".join(f"WHEN contains(text, '{w}') THEN {k}" for k, w in enumerate(WORDS, 1))
    + f" ELSE {len(WORDS) + 1} END AS position FROM documents) SELECT CAST(position AS INTEGER) AS position, "
    + f"[{', '.join(repr(w) for w in (*WORDS, 'その他'))}][position] AS label, count(*) AS count FROM c GROUP BY position",
    "title_split": "WITH s AS (SELECT doc_id, text, CASE "
    + " ".join(f"WHEN contains(text, '{s}') THEN '{s}'" for s in _SEPARATORS)
    + """ END AS sep FROM documents),
p AS (SELECT doc_id, CASE WHEN sep IS NULL THEN '' ELSE trim(substr(text, 1, instr(text, sep) - 1), chr(32) || chr(9) || chr(10) || chr(13) || chr(11)) END AS company,
  CASE WHEN sep IS NULL THEN text ELSE trim(substr(text, instr(text, sep) + length(sep)), chr(32) || chr(9) || chr(10) || chr(13) || chr(11)) END AS body FROM s)
SELECT doc_id, md5(company) AS company, CAST(length(company) AS INTEGER) AS n_company, md5(body) AS body, CAST(length(body) AS INTEGER) AS n_body FROM p""",
    "labelled_union": f"""WITH {SQL_BARS_SUPPLIER}, src AS (SELECT * FROM bars_supplier), {_METRICS},
u AS (SELECT 'up' AS list, 1 AS list_rank, code, CAST(row_number() OVER (ORDER BY diff_pct DESC, code) AS INTEGER) AS rank, price, diff_pct, CAST(NULL AS DOUBLE) AS base_7d FROM m WHERE diff_pct IS NOT NULL
  UNION ALL SELECT 'base', 2, code, CAST(row_number() OVER (ORDER BY base_7d DESC, code) AS INTEGER), NULL, NULL, base_7d FROM m WHERE base_7d IS NOT NULL)
SELECT list, list_rank, code, rank, {r6('price', 'price')}, {r6('diff_pct', 'diff_pct')}, {r6('base_7d', 'base_7d')} FROM u WHERE rank <= 30""",
    "hyperlink_cells": """WITH p AS (SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN url END AS u, url,
  CASE WHEN page_id % 3 = 0 THEN '' ELSE regexp_extract(html, '<h1>([^<]*)</h1>', 1) END AS t FROM pages),
q AS (SELECT page_id, u, CASE WHEN t = '' THEN 'say "' || url || '"' ELSE t END AS t FROM p)
SELECT page_id, CASE WHEN u IS NULL THEN t ELSE '=HYPERLINK("' || replace(u, '"', '""') || '","' || replace(t, '"', '""') || '")' END AS cell FROM q""",
    "keyword_table": """WITH k AS (SELECT keyword, min(conv_id * 1000 + turn) AS rank FROM (
    SELECT conv_id, turn, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS keyword FROM conversations) WHERE length(keyword) >= 9 GROUP BY keyword),
b AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\s\\x0B\\x{85}\\pZ]+', '', 'g') AS bare FROM documents),
h AS (SELECT doc_id, min({'rank': rank, 'keyword': keyword}) AS best FROM b JOIN k ON contains(bare, keyword) GROUP BY doc_id)
SELECT d.doc_id, best.keyword AS keyword, best.rank AS keyword_rank FROM documents d LEFT JOIN h ON h.doc_id = d.doc_id""",
    "keyword_hits": """WITH h AS (SELECT doc_id, source || '/' || (n_chars % 50) AS url,
  regexp_replace(text, '[\\s\\x0B\\x{85}\\pZ]+', '', 'g') AS bare FROM documents WHERE doc_id % 10 <> 3)
SELECT url, min(doc_id) AS doc_id FROM h
WHERE contains(bare, 'license') OR contains(bare, 'opensource') OR contains(bare, 'licensed') GROUP BY url""",
}
