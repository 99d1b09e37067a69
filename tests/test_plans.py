"""The physical plans are the ones meant for large tables."""

import os
import re

import pytest
from oracle import DATA
from pyspark.sql import functions as F

from barloom import catalog
from barloom.operators import bars as B
from barloom.operators import dedupe, load, market
from barloom.plans import analysis
from barloom.sources import tables

SF = os.path.join(DATA, "sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "bars")
    catalog.queries()["bars_daily"](spark, SF).write.parquet(path)
    return tables.read_bars(spark, path)


def test_slices_are_cut_before_the_shuffle(stored):
    text = plan(B.newest_n(stored, 200))
    exchange = text.index("Exchange hashpartitioning(code")
    assert text.count("WindowGroupLimit") == 2 and text.rindex("WindowGroupLimit") > exchange


def test_metrics_shuffle_once(stored):
    text = plan(analysis.metrics(stored, None))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_only_the_bounded_index_is_broadcast_by_hint(stored):
    text = plan(analysis.metrics(stored, market.index_series(stored)))
    assert text.count("BroadcastExchange") == 1 and "WindowGroupLimit" in text
    assert "TakeOrderedAndProject(limit=200" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, stored):
    incoming = stored.filter("asof_date > '2001-01-01'").withColumn("seq", F.lit(1))
    text = plan(load.split_codes(stored, incoming))
    assert "PushedFilters" in text and "open" not in re.search(r"ReadSchema: (\S+)", text).group(1)
    latest = plan(B.latest_dates(stored))
    assert "struct<code:string,asof_date:date>" in latest


def test_dedupe_combines_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedupe.last_wins(df, ["k"], ["id"]))
    assert "partial_max_by" in text and "Window" not in text


@pytest.mark.parametrize("name", ["bars_daily", "upsert_last_wins"])
def test_trades_are_not_sorted_before_the_shuffle(spark, name):
    text = plan(catalog.queries()[name](spark, SF))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "Sort [" not in text


@pytest.mark.parametrize("name, scans", [("snapshot_lists", 1), ("integrity_hits", 1), ("extract_news", 1), ("snapshot_counts", 1)])
def test_the_facts_are_read_once(spark, name, scans):
    text = plan(catalog.queries()[name](spark, SF))
    facts = re.findall(r"FileScan parquet .*?(?:lineitem|events)\.parquet", text)
    assert len(facts) == scans


@pytest.mark.parametrize("name, scans", [("load_merged", 6), ("load_status", 6)])
def test_a_load_is_a_short_plan(spark, name, scans):
    """Feeds, actions and chosen rows are written once: what is left reads each of them once or twice."""
    text = plan(catalog.queries()[name](spark, SF))
    assert text.count("FileScan parquet") <= scans and text.count("Exchange hashpartitioning") <= 14


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_joins(spark, name):
    if "stream" in name or name in ("store_upsert",):
        pytest.skip("runs when called")
    text = plan(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rendered_part_pages_are_dealt_over_tasks(spark, tmp_path):
    """A small file of parts is one task; the pages made from it, many times its size, are not."""
    rows = "id AS p_partkey, 'n' AS p_name, 't' AS p_type, 9.5D AS p_retailprice, 3 AS p_size, 'Brand#11' AS p_brand"
    spark.range(500).selectExpr(*rows.split(", ")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for name in ("extract_basic_info", "extract_handbook"):
        found = catalog.queries()[name](spark, str(tmp_path)).select("code", F.spark_partition_id().alias("task")).collect()
        assert len({r.code for r in found}) == 500 and len({r.task for r in found}) > 4
