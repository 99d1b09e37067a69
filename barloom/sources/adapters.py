"""Daily bars out of trade and order tables.

Open and close come from the first and last trade by order, line and price, so the result does
not depend on how the rows are split over tasks. Everything is one hash aggregation with
map-side combine: a security that holds a third of all trades shrinks to one row per
day in every task before the shuffle, and (code, day) spreads it over the cluster.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def position(high: Column, low: Column) -> Column:
    """Two whole numbers, not negative, as one number that sorts by the first and then by the second.

    A hash aggregation updates it in place; a struct as order key would have all rows sorted before the shuffle.
    """
    return high.cast("decimal(19,0)") * F.lit(Decimal(10**19)) + low.cast("decimal(19,0)")


def line_position(low: Column) -> Column:
    """Position of a trade by order and line (fewer than 1,024 lines an order), then by ``low``."""
    return position(F.shiftleft(F.col("l_orderkey").cast("long"), 10) + F.col("l_linenumber"), low)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _daily(trades: DataFrame) -> DataFrame:
    """(code, asof_date, price, volume, seq) to bars."""
    return trades.groupBy("code", "asof_date").agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.sum("volume").alias("volume"),
    )


def _trades(items: DataFrame, code: str) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return items.select(
        F.col(code).cast("string").alias("code"),
        F.col("l_shipdate").cast("date").alias("asof_date"),
        price.alias("price"),
        F.col("l_quantity").alias("volume"),
        # Prices of whole cents over whole quantities below a thousand differ by more than 1e-7.
        line_position(F.floor(price * 1e7)).alias("seq"),
    )


def bars_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per product brand."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    items = table(spark, sf_dir, "lineitem")
    return _daily(_trades(items.join(part, items["l_partkey"] == part["p_partkey"]), "p_brand"))


def bars_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per supplier: many codes, mostly one trade a day."""
    return _daily(_trades(table(spark, sf_dir, "lineitem"), "l_suppkey"))


def bars_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per market segment and nation from orders; many codes stay below the minimum length."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = table(spark, sf_dir, "orders")
    return _daily(
        orders.join(cust, orders["o_custkey"] == cust["c_custkey"]).select(
            F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("code"),
            F.col("o_orderdate").cast("date").alias("asof_date"),
            (F.col("o_totalprice") / 100.0).alias("price"),
            F.lit(1.0).alias("volume"),
            F.col("o_orderkey").alias("seq"),
        )
    )
