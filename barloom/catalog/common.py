"""Inputs shared by the registered queries, in DataFrame form and in SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import market
from ..sources import adapters

INDEX_CODE = market.INDEX_CODE


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that two engines that add in a different order agree.

    The bias keeps exact halves, which division by 8 or 32 produces often, on one side.
    """
    scale = 10.0**digits
    cut = {c: F.expr(f"floor(`{c}` * {scale}D + 0.5003D) / {scale}D") for c, t in df.dtypes if t == "double"}
    return df.select(*[cut[c].alias(c) if c in cut else F.col(c) for c in df.columns])


def bars_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long histories (brands) and short ones (segment and nation), with missing values by rule."""
    both = adapters.bars_brand(spark, sf_dir).unionByName(adapters.bars_short(spark, sf_dir))
    return both.withColumns(
        {
            "open": F.when(F.dayofmonth("asof_date") % 7 != 0, F.col("open")),
            "volume": F.when(F.month("asof_date") % 3 != 1, F.col("volume")),
        }
    )


def index_of(bars: DataFrame) -> DataFrame:
    return market.index_series(market.daily_mean_index(bars))


def codes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code of ``bars_mixed`` from its master tables."""
    brands = adapters.table(spark, sf_dir, "part").select(F.col("p_brand").alias("code"))
    segments = adapters.table(spark, sf_dir, "customer").select(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("code")
    )
    return brands.unionByName(segments).distinct()


def base_info_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margin balance as page text and a listing class per brand."""
    part = adapters.table(spark, sf_dir, "part")
    grouped = part.groupBy(F.col("p_brand").alias("code")).agg(
        F.sum("p_size").alias("size"), F.min("p_type").alias("listing_class")
    )
    dash = F.col("size") % 5 == 0
    return grouped.select(
        "code", "listing_class", F.when(dash, "-").otherwise(F.format_number("size", 0)).alias("margin_long")
    )


_TRADE_ORDER = "l_orderkey, l_linenumber, price"

SQL_BARS_BRAND = f"""
bars_brand AS (
  SELECT code, asof_date, first(price ORDER BY {_TRADE_ORDER}) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY {_TRADE_ORDER}) AS close, sum(l_quantity) AS volume
  FROM (SELECT p_brand AS code, CAST(l_shipdate AS DATE) AS asof_date, l_extendedprice / l_quantity AS price, lineitem.*
        FROM lineitem JOIN part ON l_partkey = p_partkey)
  GROUP BY code, asof_date)"""

SQL_BARS_SUPPLIER = f"""
bars_supplier AS (
  SELECT code, asof_date, first(price ORDER BY {_TRADE_ORDER}) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY {_TRADE_ORDER}) AS close, sum(l_quantity) AS volume
  FROM (SELECT CAST(l_suppkey AS VARCHAR) AS code, CAST(l_shipdate AS DATE) AS asof_date,
               l_extendedprice / l_quantity AS price, lineitem.* FROM lineitem)
  GROUP BY code, asof_date)"""

SQL_BARS_SHORT = """
bars_short AS (
  SELECT code, asof_date, first(price ORDER BY o_orderkey) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM (SELECT c_mktsegment || '-' || c_nationkey AS code, CAST(o_orderdate AS DATE) AS asof_date,
               o_totalprice / 100.0 AS price, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey)
  GROUP BY code, asof_date)"""

SQL_BARS_MIXED = f"""{SQL_BARS_BRAND},{SQL_BARS_SHORT},
bars AS (
  SELECT code, asof_date, CASE WHEN day(asof_date) % 7 <> 0 THEN open END AS open, high, low, close,
         CASE WHEN month(asof_date) % 3 <> 1 THEN volume END AS volume
  FROM (SELECT * FROM bars_brand UNION ALL SELECT * FROM bars_short))"""

SQL_CODES = """
codes AS (SELECT p_brand AS code FROM part UNION SELECT c_mktsegment || '-' || c_nationkey FROM customer)"""

SQL_BASE = """
base_raw AS (SELECT p_brand AS code, sum(p_size) AS size, min(p_type) AS listing_class FROM part GROUP BY p_brand),
base AS (SELECT code, listing_class, size, CASE WHEN size % 5 = 0 THEN '-' ELSE format('{:,}', CAST(size AS BIGINT)) END AS margin_long
         FROM base_raw)"""


def r6(expr: str, name: str, digits: int = 6) -> str:
    """``rounded`` in SQL."""
    scale = 10**digits
    return f"floor(({expr}) * {scale}.0 + 0.5003) / {scale}.0 AS {name}"
