"""Load decisions, split detection, last-wins upsert, duplicate days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import load
from ..operators.bars import latest_dates, newest_n
from ..session import materialised, shared_dir
from ..sources import adapters, sinks, store, tables
from ..streaming import jobs
from .common import SQL_BARS_BRAND, rounded

TODAY = "2002-01-04"


def _shifted(spark, d):
    """Brand bars moved so that every code's newest bar falls on the run date; ``s`` picks the case. Both are written once, being
    read as the store and as two feeds."""
    bars = materialised(adapters.bars_brand(spark, d), "bars")
    moved = bars.join(latest_dates(bars), "code").withColumns(
        {
            "asof_date": F.date_add("asof_date", F.datediff(F.to_date(F.lit(TODAY)), "latest")),
            "s": F.regexp_extract("code", r"(\d+)", 1).cast("int") % 7,
        }
    )
    return materialised(moved.drop("latest"), "moved-bars")


def _stored(moved):
    today = F.to_date(F.lit(TODAY))
    keep = (F.col("s") != 0) & ((F.col("asof_date") < today) | F.col("s").isin(1, 2))
    return moved.filter(keep).select(
        "code",
        F.when(F.col("s") == 2, F.date_add("asof_date", 1)).otherwise(F.col("asof_date")).alias("asof_date"),
        "open", "high", "low",
        F.when(F.col("s") == 3, F.col("close") * 2).otherwise(F.col("close")).alias("close"),
        "volume",
    )


def _daily(moved, doubled: bool = False):
    """Every bar in reading order, newest first; with ``doubled`` the newest day of case 5 comes twice."""
    rows = moved.withColumn("seq", F.datediff(F.to_date(F.lit(TODAY)), "asof_date"))
    if doubled:
        again = rows.filter((F.col("s") == 5) & (F.col("seq") == 0)).withColumn("seq", F.lit(1_000_000))
        rows = rows.unionByName(again)
    return rows.select("code", "asof_date", "open", "high", "low", "close", "volume", "seq")


def _full(moved):
    """The second feed, read for full and replacing loads; its volumes tell it from the daily one."""
    return _daily(moved).withColumn("volume", F.col("volume") + 1)


def _codes(spark, d):
    return adapters.table(spark, d, "part").select(F.col("p_brand").alias("code")).distinct()


def _actions(spark, d):
    moved = _shifted(spark, d)
    return load.load_actions(_codes(spark, d), _stored(moved), _daily(moved), F.lit(TODAY))


def _split(spark, d):
    moved = _shifted(spark, d)
    return load.split_codes(_stored(moved), _daily(moved))


def _dup(spark, d):
    return load.duplicate_dates(_daily(_shifted(spark, d), doubled=True))


def _plan(spark, d, cap=None):
    moved = _shifted(spark, d)
    return moved, *load.plan_load(_codes(spark, d), _stored(moved), _daily(moved, True), _full(moved), F.lit(TODAY), cap)


def _status(spark, d):
    _, status, _ = _plan(spark, d)
    return status.withColumn("result", load.status_text())


def _capped(spark, d):
    """The same with loads that reach back 280 rows, as the report's page walk did."""
    _, status, _ = _plan(spark, d, 280)
    return status.select("code", "action", "latest", "n_rows")


def _counts(spark, d):
    return load.status_counts(_status(spark, d))


def _merged(spark, d):
    moved, status, rows = _plan(spark, d)
    rows = materialised(rows, "load-rows")  # keys and rows of the merge, as the store does it
    return rounded(load.merge_bars(_stored(moved), rows, status.filter("action = 'REPLACE'")))


def _store(spark, d):
    """The same through the partitioned store: create it, plan against it, load, read back."""
    moved = _shifted(spark, d)
    path = shared_dir(spark, "prices")
    store.create(_stored(moved), path, buckets=2)
    status, rows = load.plan_load(
        _codes(spark, d), store.read(spark, path), _daily(moved, True), _full(moved), F.lit(TODAY)
    )
    store.apply_load(spark, path, status, rows)
    return rounded(store.read(spark, path).drop("ym"))


def _load_stream(spark, d):
    """The load as a stream: every code is cut over all three files of the daily feed, the newest days in the last but one."""
    moved = _shifted(spark, d)
    path, incoming = shared_dir(spark, "prices"), shared_dir(spark, "incoming")
    store.create(_stored(moved), path, buckets=2)
    daily = _daily(moved, True)
    for k in (2, 0, 1):
        daily.filter(F.pmod("seq", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(incoming)
    stream = jobs.file_stream(spark, incoming, daily.schema, files_per_batch=1)
    jobs.bars_to_store(stream, _codes(spark, d), path, shared_dir(spark, "load-ckpt"), F.lit(TODAY), _full(moved))
    return rounded(store.read(spark, path).drop("ym"))


def _last_wins(spark, d):
    """Every trade as a candidate bar of its brand and day; the one read last wins."""
    trades = adapters.table(spark, d, "lineitem").join(
        adapters.table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    )
    cents = [F.floor(F.col(c) * 100 + 0.5).cast("long") for c in ("l_extendedprice", "l_quantity")]
    rows = trades.select(
        F.col("p_brand").alias("code"), F.col("l_shipdate").cast("date").alias("asof_date"),
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", adapters.line_position(cents[0] * 1_000_000 + cents[1]).alias("seq"),
    )
    return load.last_wins(rows, load.KEY, ["seq"]).drop("seq")


def _validate(spark, d):
    """Order rows as text, some with malformed codes, days or numbers."""
    o = adapters.table(spark, d, "orders")
    raw = o.select(
        F.when(F.col("o_orderkey") % 7 == 0, "bad code!").otherwise(F.col("o_orderkey").cast("string")).alias("code"),
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(F.col("o_orderkey") % 11 == 0, "2001-13-01")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("asof_date"),
        F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise(F.format_string("%.2f", "o_totalprice")).alias("open"),
        F.lit("").alias("high"),
        F.lit(None).cast("string").alias("low"),
        F.format_string("%.2f", "o_totalprice").alias("close"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".75")).alias("volume"),
    )
    return load.validate_rows(raw)


def _raw_file(spark, d):
    """Orders as bars in a text file with a header, some of them malformed, read back and checked."""
    o, path = adapters.table(spark, d, "orders"), shared_dir(spark, "raw-bars")
    k = F.col("o_orderkey")
    raw = o.select(
        F.when(k % 7 == 0, "bad, code").otherwise((k % 100_000_000).cast("string")).alias("code"),
        F.when(k % 5 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("asof_date"),
        F.when(k % 3 == 0, '"-"').otherwise(F.format_string("%.2f", "o_totalprice")).alias("open"),
        F.when(k % 2 == 0, F.format_string("%.2f", "o_totalprice")).alias("high"), F.lit(None).cast("string").alias("low"),
        F.format_string("%.2f", "o_totalprice").alias("close"), F.concat(F.col("o_custkey").cast("string"), F.lit(".75")).alias("volume"),
    )
    sinks.write_csv(raw, path)
    return load.validate_rows(tables.read_raw_bars(spark, path))


QUERIES = {
    "load_actions": _actions,
    "split_detect": _split,
    "dup_dates": _dup,
    "load_status": _status,
    "load_capped": _capped,
    "load_counts": _counts,
    "upsert_last_wins": _last_wins,
    "load_merged": _merged,
    "store_upsert": _store,
    "load_stream": _load_stream,
    "row_validation": _validate,
    "raw_bars_file": _raw_file,
}

_SQL = f"""WITH {SQL_BARS_BRAND},
moved AS (
  SELECT code, asof_date + CAST(date_diff('day', max(asof_date) OVER (PARTITION BY code), DATE '{TODAY}') AS INTEGER) AS asof_date,
         open, high, low, close, volume, CAST(regexp_extract(code, '(\\d+)', 1) AS INTEGER) % 7 AS s
  FROM bars_brand),
stored AS (
  SELECT code, CASE WHEN s = 2 THEN asof_date + 1 ELSE asof_date END AS asof_date, open, high, low,
         CASE WHEN s = 3 THEN close * 2 ELSE close END AS close, volume
  FROM moved WHERE s <> 0 AND (asof_date < DATE '{TODAY}' OR s IN (1, 2))),
plain AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) - 1 AS seq FROM moved),
incoming AS (SELECT * FROM plain UNION ALL SELECT * FROM plain WHERE s = 5 AND seq = 0),
again AS (SELECT * REPLACE (volume + 1 AS volume) FROM plain),
latest AS (SELECT code, max(asof_date) AS latest FROM stored GROUP BY code),
last5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) AS rd FROM stored) WHERE rd <= 5),
split AS (SELECT l.code FROM last5 l JOIN plain p ON p.code = l.code AND p.asof_date = l.asof_date
          GROUP BY l.code HAVING bool_or(l.close <> p.close)),
actions AS (
  SELECT c.code, latest, CASE WHEN latest IS NULL THEN 'FULL' WHEN latest < DATE '{TODAY}' THEN
           CASE WHEN c.code IN (SELECT code FROM split) THEN 'REPLACE' ELSE 'DIFF' END
         WHEN latest = DATE '{TODAY}' THEN 'SKIP' ELSE 'ERROR' END AS action
  FROM (SELECT DISTINCT p_brand AS code FROM part) c LEFT JOIN latest l ON l.code = c.code),
chosen AS (
  SELECT i.*, action FROM incoming i JOIN actions a ON a.code = i.code
  WHERE action = 'DIFF' AND asof_date > latest AND asof_date <= DATE '{TODAY}'
  UNION ALL SELECT f.*, action FROM again f JOIN actions a ON a.code = f.code WHERE action IN ('FULL', 'REPLACE')),
doubled AS (SELECT DISTINCT code FROM (SELECT code FROM chosen GROUP BY code, asof_date HAVING count(*) > 1)),
status AS (
  SELECT a.code, CASE WHEN d.code IS NOT NULL THEN 'ERROR' ELSE action END AS action,
         CASE WHEN d.code IS NOT NULL THEN latest ELSE coalesce((SELECT max(asof_date) FROM chosen c WHERE c.code = a.code), latest) END AS latest,
         CASE WHEN d.code IS NOT NULL THEN 0 ELSE (SELECT count(*) FROM chosen c WHERE c.code = a.code) END AS n_rows,
         d.code IS NOT NULL AS failed
  FROM actions a LEFT JOIN doubled d ON d.code = a.code),
fresh AS (SELECT code, asof_date, open, high, low, close, volume FROM chosen WHERE code NOT IN (SELECT code FROM doubled)),
merged AS (
  SELECT * FROM stored s WHERE code NOT IN (SELECT code FROM status WHERE action = 'REPLACE')
    AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.code = s.code AND f.asof_date = s.asof_date)
  UNION ALL SELECT * FROM fresh)"""

_STATUS = """SELECT *, CASE WHEN failed THEN 'エラー：株探読み込みに失敗' WHEN action = 'FULL' THEN '全件取得＆DB更新：' || n_rows || '件'
  WHEN action = 'REPLACE' THEN '全件洗替：' || n_rows || '件' WHEN action = 'DIFF' THEN '差分取得＆DB更新：' || n_rows || '件'
  WHEN action = 'SKIP' THEN '処理なし' ELSE 'エラー：DBに未来日が保存されている' END AS result FROM status"""


def _bars_out(source: str) -> str:
    from .common import r6

    cols = ", ".join(r6(c, c) for c in ("open", "high", "low", "close", "volume"))
    return f"{_SQL} SELECT code, asof_date, {cols} FROM {source}"


ORACLES = {
    "load_actions": f"{_SQL} SELECT code, latest, action FROM actions",
    "split_detect": f"{_SQL} SELECT code, true AS split FROM split",
    "dup_dates": f"{_SQL} SELECT code, asof_date, count(*) AS copies FROM incoming GROUP BY code, asof_date HAVING count(*) > 1",
    "load_status": f"{_SQL} {_STATUS}",
    "load_capped": f"""{_SQL} SELECT code, action, latest, CASE WHEN action IN ('FULL', 'REPLACE') THEN least(n_rows, 280) ELSE n_rows END AS n_rows
FROM status""",
    "load_counts": f"""{_SQL} SELECT a AS action, (SELECT count(*) FROM status WHERE action = a) AS codes
FROM (VALUES ('FULL'), ('REPLACE'), ('DIFF'), ('SKIP'), ('ERROR')) v(a)""",
    "load_merged": _bars_out("merged"),
    "store_upsert": _bars_out("merged"),
    "load_stream": _bars_out("merged"),
    "upsert_last_wins": """SELECT code, asof_date, l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT p_brand AS code, CAST(l_shipdate AS DATE) AS asof_date, l_orderkey, l_linenumber, l_extendedprice, l_quantity,
         row_number() OVER (PARTITION BY p_brand, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE k = 1""",
    "raw_bars_file": """SELECT CAST(o_orderkey % 100000000 AS VARCHAR) AS code, CAST(o_orderdate AS DATE) AS asof_date,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS open, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS high, CAST(NULL AS DOUBLE) AS low,
  o_totalprice AS close, CAST(o_custkey AS DOUBLE) AS volume FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0""",
    "row_validation": """SELECT CAST(o_orderkey AS VARCHAR) AS code, CAST(o_orderdate AS DATE) AS asof_date,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS open, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low,
  o_totalprice AS close, CAST(o_custkey AS DOUBLE) AS volume
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0""",
}
