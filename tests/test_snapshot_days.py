"""Snapshots of several days from month summaries against single runs over all bars."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.plans import snapshot
from barloom.schemas import BARS
from barloom.sources import months, store


@pytest.fixture(scope="module")
def bars(spark):
    r = random.Random(2)
    rows = []
    for k in range(12):
        price, day = 100.0 + 40 * k, dt.date(2022, 11, 20) + dt.timedelta(days=r.randrange(200))
        while day < dt.date(2024, 7, 1):
            price = max(5.0, round(price * (1 + r.gauss(0, 0.03)), 1))
            rows.append((f"c{k}", day, price, price, price, price, float(r.randrange(1, 99))))
            day += dt.timedelta(days=1 if r.random() < 0.8 else r.randrange(2, 70 if k == 3 else 6))
    return spark.createDataFrame(rows, BARS)


#: Ends of months and years, a leap day, weeks that begin on the first.
DAYS = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2024, 3, 31), dt.date(2024, 4, 1), dt.date(2024, 5, 13), dt.date(2024, 6, 30)]


def with_month(df):
    return df.withColumn("ym", F.year("asof_date") * 100 + F.month("asof_date"))


def test_days_equal_single_runs(spark, bars):
    got = {}
    metrics = snapshot.days_metrics(with_month(bars), snapshot.month_state(bars), DAYS).collect()
    for r in metrics:
        got.setdefault(r["t"], {})[r["code"]] = {k: v for k, v in r.asDict().items() if k not in ("t", "code")}
    for day in DAYS:
        single = {r["code"]: {k: v for k, v in r.asDict().items() if k != "code"} for r in snapshot.day_metrics(bars, F.lit(str(day))).collect()}
        assert got.get(day, {}) == single, day
    assert len(metrics) > 40
    lists = snapshot.snapshots(with_month(bars), snapshot.month_state(bars), DAYS[2:4]).filter(F.col("t") == F.lit(DAYS[3])).drop("t").collect()
    assert sorted(map(str, lists)) == sorted(map(str, snapshot.snapshot(bars, F.lit(str(DAYS[3]))).collect()))


def test_only_edge_months_of_the_store_are_read(spark, bars, tmp_path):
    prices, path = str(tmp_path / "prices"), str(tmp_path / "months")
    store.create(bars, prices, buckets=2)
    months.refresh(spark, path, prices)
    metrics = snapshot.days_metrics(store.read(spark, prices), months.read(spark, path), [dt.date(2024, 5, 13)])
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert snapshot.edge_months(dt.date(2024, 5, 13)) == [202305, 202404, 202405]
    assert "PartitionFilters: [ym" in plan.replace("isnotnull", "") or "ym#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 2


def test_a_correction_leaves_no_trace(spark, bars, tmp_path):
    prices, path = str(tmp_path / "prices"), str(tmp_path / "months")
    wrong = bars.withColumn("close", F.when((F.col("code") == "c1") & (F.month("asof_date") == 3), F.col("close") * 100).otherwise(F.col("close")))
    store.create(wrong, prices, buckets=2)
    months.refresh(spark, path, prices)
    right = bars.filter("code = 'c1' AND month(asof_date) = 3")
    store.upsert(spark, prices, right)
    for _ in range(2):
        months.refresh(spark, path, prices, months.months_of(right))
        assert sorted(map(str, months.read(spark, path).select("code", "asof_date", "last", "hi", "lo").collect())) == sorted(map(str, snapshot.month_state(bars).drop("ym").select("code", "asof_date", "last", "hi", "lo").collect()))
