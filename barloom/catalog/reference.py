"""Code masters, market filter, base-info join, number normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..operators import reference as R
from ..sources import adapters


def _master(spark, d):
    """Parts as a code master: two rows per code, every 90th code blank."""
    p = adapters.table(spark, d, "part")
    code = F.when(F.col("p_partkey") % 90 == 89, F.lit(" ")).otherwise(F.concat(F.lit(" C"), F.floor(F.col("p_partkey") / 2).cast("string"), F.lit(" ")))
    classes = F.array(*[F.lit(m) for m in (*R.TARGET_MARKETS, "REIT")])
    return p.select(
        F.col("p_partkey").alias("row_idx"), code.alias("code"), F.col("p_name").alias("name"),
        F.element_at(classes, (F.col("p_size") % 4 + 1).cast("int")).alias("market_class"), "p_brand",
    )


def _until_blank(spark, d):
    return R.until_blank(_master(spark, d)).select("row_idx", F.trim("code").alias("code"))


def _distinct(spark, d):
    return R.distinct_in_order(R.without_blanks(_master(spark, d)))


def _market(spark, d):
    tagged = R.tag_market(R.without_blanks(_master(spark, d)))
    return tagged.select("row_idx", "result")


def _result_counts(spark, d):
    return R.result_counts(R.tag_market(R.without_blanks(_master(spark, d))))


def _wide_master(spark, d):
    sheet = _master(spark, d).select("code", F.lit("x").alias("更新日"), "name", "p_brand", "row_idx")
    return R.wide_master(sheet, code="code")


def _base_join(spark, d):
    """Suppliers with nation and region as carried columns; unknown nations stay in the list."""
    s = adapters.table(spark, d, "supplier")
    n, r = adapters.table(spark, d, "nation"), adapters.table(spark, d, "region")
    base = n.filter("n_nationkey % 6 <> 1").join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    return s.join(base, s["s_nationkey"] == base["n_nationkey"], "left").select("s_suppkey", "n_name", "r_name")


def _texts(spark, d):
    """Account balances written the way price pages write numbers."""
    c = adapters.table(spark, d, "customer")
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    money = F.format_number(bal, 2)
    text = (
        F.when(k % 8 == 0, "－").when(k % 8 == 1, F.concat(money, F.lit(" 円"))).when(k % 8 == 2, F.concat(F.lit("　"), money, F.lit("%")))
        .when(k % 8 == 3, "").when(k % 8 == 4, F.concat(money, F.lit("株"))).when(k % 8 == 5, "n/a").otherwise(money)
    )
    return c.select("c_custkey", text.alias("s"), k.alias("k"), bal.alias("bal"))


def _numbers(spark, d):
    t = _texts(spark, d)
    s, k = F.col("s"), F.col("k")
    wide = F.translate(F.format_number(k, 0), "0123456789", numbers.WIDE_DIGITS)
    cap = F.when(k % 2 == 0, F.concat((k % 5).cast("string"), F.lit("兆"), F.format_number(k, 0), F.lit("億円"))).otherwise(F.concat(F.format_number(k, 0), F.lit("億円")))
    return t.select(
        "c_custkey", numbers.float_or_null(s).alias("float_or_null"), numbers.number_without_units(s).alias("without_units"),
        numbers.lenient_int(s).alias("lenient_int"), numbers.one_decimal(s).alias("one_decimal"),
        numbers.ascii_digits(wide).alias("ascii_digits"), numbers.market_cap(cap).alias("market_cap"),
        numbers.plain_number(F.col("bal")).alias("plain"), numbers.plain_number(F.floor("bal").cast("double")).alias("plain_whole"),
        numbers.per_display(s).alias("per"), numbers.margin_ratio_display(F.lit("3.25倍"), (k % 3).cast("string"), F.lit("1,000")).alias("margin_ratio"),
    )


def _dates(spark, d):
    o = adapters.table(spark, d, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = (
        F.when(k % 5 == 0, F.date_format(day, "yyyy-M-d")).when(k % 5 == 1, F.date_format(day, "yyyy/MM/dd")).when(k % 5 == 2, F.date_format(day, "yy/M/d"))
        .when(k % 5 == 3, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T20:00:00Z"))).otherwise("2001-13-41")
    )
    run = F.lit("2002-01-04 12:00:30").cast("timestamp_ntz")
    short = F.concat(F.date_format(day, "MM/dd"), F.lit(" 08:15"))
    return o.select(
        "o_orderkey", dates.any_date(text).alias("any_date"),
        dates.date_inside(F.concat(F.lit("due "), F.date_format(day, "yyyy/MM/dd"), F.lit(" at noon"))).alias("inside"),
        F.date_format(dates.inferred_time(short, run), "yyyy-MM-dd HH:mm:ss").alias("inferred"),
        F.date_format(dates.day_at_run_clock(F.date_format(day, "yyyy/MM/dd"), run), "yyyy-MM-dd HH:mm:ss").alias("at_clock"),
        dates.date_key(F.date_format(day, "yyyy/MM/dd")).alias("key"),
        dates.compare_days(text, F.lit("1997-06-15")).alias("cmp"), dates.compare_days(text, F.lit("1997-06-15"), True).alias("cmp_lenient"),
    )


QUERIES = {
    "code_master": _until_blank,
    "code_distinct": _distinct,
    "market_filter": _market,
    "result_counts": _result_counts,
    "wide_master": _wide_master,
    "base_join": _base_join,
    "num_normalise": _numbers,
    "date_normalise": _dates,
}

_MASTER = """m AS (SELECT p_partkey AS row_idx, CASE WHEN p_partkey % 90 = 89 THEN '' ELSE 'C' || (p_partkey // 2) END AS code, p_name AS name,
  CASE p_size % 4 WHEN 0 THEN 'プライム（内国株式）' WHEN 1 THEN 'スタンダード（内国株式）' WHEN 2 THEN 'グロース（内国株式）' ELSE 'REIT' END AS market_class, p_brand FROM part)"""
_TAG = "CASE WHEN market_class = 'REIT' THEN 'スキップ（市場対象外）' END"
_MONEY = "format('{:,.2f}', c_acctbal)"

ORACLES = {
    "code_master": f"WITH {_MASTER} SELECT row_idx, code FROM m WHERE row_idx < (SELECT min(row_idx) FROM m WHERE code = '')",
    "code_distinct": f"WITH {_MASTER} SELECT code, min(row_idx) AS row_idx FROM m WHERE code <> '' GROUP BY code",
    "market_filter": f"WITH {_MASTER} SELECT row_idx, {_TAG} AS result FROM m WHERE code <> ''",
    "result_counts": f"WITH {_MASTER} SELECT {_TAG} AS result, count(*) AS codes FROM m WHERE code <> '' GROUP BY 1",
    "wide_master": f"WITH {_MASTER} SELECT code, arg_max(name, row_idx) AS name, arg_max(p_brand, row_idx) AS p_brand FROM m WHERE code <> '' GROUP BY code",
    "base_join": """SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey % 6 <> 1) ON s_nationkey = n_nationkey""",
    "num_normalise": f"""WITH t AS (SELECT c_custkey AS k, c_acctbal AS bal, c_custkey % 8 AS c FROM customer)
SELECT k AS c_custkey, CASE WHEN c IN (6, 7) THEN bal END AS float_or_null,
  CASE WHEN c = 3 THEN NULL WHEN c IN (0, 5) THEN 0.0 ELSE bal END AS without_units,
  CASE WHEN c IN (0, 3, 5) THEN 0 ELSE CAST(trunc(bal) AS BIGINT) END AS lenient_int,
  CASE WHEN c = 3 THEN NULL WHEN c IN (0, 5) THEN 0.0 ELSE CAST(round(CAST(bal AS DECIMAL(18, 2)), 1) AS DOUBLE) END AS one_decimal,
  CAST(k AS VARCHAR) AS ascii_digits, CASE WHEN k % 2 = 0 THEN (k % 5) * 10000.0 + k ELSE CAST(k AS DOUBLE) END AS market_cap,
  rtrim(rtrim(format('{{:.6f}}', bal), '0'), '.') AS plain, CAST(CAST(floor(bal) AS BIGINT) AS VARCHAR) AS plain_whole,
  CASE WHEN c = 0 THEN 'ー' WHEN c = 3 THEN NULL WHEN c = 5 THEN '0'
       ELSE rtrim(rtrim(format('{{:.6f}}', CAST(round(CAST(bal AS DECIMAL(18, 2)), 1) AS DOUBLE)), '0'), '.') END AS per,
  CASE WHEN k % 3 = 0 THEN 'ー' ELSE '3.3' END AS margin_ratio FROM t""",
    "date_normalise": """WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 5 AS c, make_timestamp(2002, month(o_orderdate), day(o_orderdate), 8, 15, 0) AS g
  FROM orders WHERE NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29)
  UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), o_orderkey % 5, NULL FROM orders WHERE month(o_orderdate) = 2 AND day(o_orderdate) = 29)
SELECT o_orderkey, CASE WHEN c < 2 THEN d WHEN c = 2 THEN CAST('20' || strftime(d, '%y-%m-%d') AS DATE) WHEN c = 3 THEN d + 1 END AS any_date, d AS inside,
  strftime(CASE WHEN g > TIMESTAMP '2002-01-04 12:00:30' THEN g - INTERVAL 1 YEAR ELSE g END, '%Y-%m-%d %H:%M:%S') AS inferred,
  strftime(d, '%Y-%m-%d') || ' 12:00:30' AS at_clock, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS key,
  CASE WHEN c = 0 AND strftime(d, '%Y-%-m-%-d') = strftime(d, '%Y-%m-%d') THEN CAST(sign(d - DATE '1997-06-15') AS INTEGER) END AS cmp,
  CASE WHEN c = 0 AND strftime(d, '%Y-%-m-%-d') = strftime(d, '%Y-%m-%d') THEN CAST(sign(d - DATE '1997-06-15') AS INTEGER) ELSE 0 END AS cmp_lenient
FROM t""",
}
