"""Load decisions and the partitioned store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import load
from barloom.schemas import BARS, RAW_BARS
from barloom.sources import store

TODAY = dt.date(2026, 3, 2)
RUN = F.lit  # evaluated inside tests, once a session exists


def bars(spark, rows):
    """rows: (code, days before today, close)."""
    return spark.createDataFrame([(c, TODAY - dt.timedelta(days=k), x, x, x, x, 1.0) for c, k, x in rows], BARS)


def incoming(spark, rows):
    return bars(spark, rows).withColumn("seq", F.monotonically_increasing_id())


def keyed(df):
    return {(r["code"], (TODAY - r["asof_date"]).days): r["close"] for r in df.collect()}


def plan(spark, codes, stored, inc, **kw):
    names = spark.createDataFrame([(c,) for c in codes], "code string")
    status, rows = load.plan_load(names, stored, inc, kw.pop("full", inc), F.lit(str(TODAY)), **kw)
    return {r["code"]: r for r in status.collect()}, status, rows


def test_every_branch(spark):
    stored = bars(spark, [("diff", 1, 10.0), ("diff", 2, 9.0), ("skip", 0, 5.0), ("ahead", -1, 5.0), ("split", 1, 20.0), ("gone", 1, 7.0), ("dup", 1, 3.0)])
    inc = incoming(
        spark,
        [("full", 0, 1.0), ("full", 1, 2.0), ("diff", 0, 11.0), ("diff", 1, 10.0), ("diff", -1, 99.0), ("split", 0, 10.5), ("split", 1, 10.0),
         ("skip", 0, 6.0), ("dup", 0, 3.0), ("dup", 0, 4.0), ("dup", 1, 3.0)],
    )
    got, status, rows = plan(spark, ["full", "diff", "skip", "ahead", "split", "gone", "dup", "nothing"], stored, inc)
    actions = {c: (r["action"], r["n_rows"], r["failed"]) for c, r in got.items()}
    assert actions == {
        "full": ("FULL", 2, False), "diff": ("DIFF", 1, False), "skip": ("SKIP", 0, False), "ahead": ("ERROR", 0, False),
        "split": ("REPLACE", 2, False), "gone": ("DIFF", 0, False), "dup": ("ERROR", 0, True), "nothing": ("FULL", 0, False),
    }
    assert got["gone"]["latest"] == TODAY - dt.timedelta(days=1)
    assert keyed(rows) == {("full", 0): 1.0, ("full", 1): 2.0, ("diff", 0): 11.0, ("split", 0): 10.5, ("split", 1): 10.0}
    merged = keyed(load.merge_bars(stored, rows, status.filter("action = 'REPLACE'")))
    assert merged[("split", 1)] == 10.0 and merged[("dup", 1)] == 3.0 and merged[("skip", 0)] == 5.0
    texts = {r["code"]: r["t"] for r in status.select("code", load.status_text().alias("t")).collect()}
    assert texts["full"] == "全件取得＆DB更新：2件" and texts["ahead"] == load.STATUS_FUTURE and texts["dup"] == load.STATUS_FAILED


def test_split_looks_at_five_stored_bars_only(spark):
    stored = bars(spark, [("a", k, 10.0) for k in range(1, 9)])
    older = incoming(spark, [("a", k, 10.0 if k <= 5 else 5.0) for k in range(0, 9)])
    newer = incoming(spark, [("a", k, 5.0 if k == 5 else 10.0) for k in range(0, 9)])
    assert load.split_codes(stored, older).count() == 0
    assert load.split_codes(stored, newer).count() == 1
    assert load.split_codes(stored, newer, tolerance=6.0).count() == 0


def test_split_counts_a_missing_close_as_zero(spark):
    stored = bars(spark, [("a", 1, None), ("b", 1, None)])
    inc = incoming(spark, [("a", 1, 0.0), ("b", 1, 1.0)])
    assert [r["code"] for r in load.split_codes(stored, inc).collect()] == ["b"]


def test_full_load_takes_the_first_rows_read(spark):
    inc = incoming(spark, [("a", k, float(k)) for k in range(30)])
    _, _, rows = plan(spark, ["a"], bars(spark, []), inc, cap=12)
    assert sorted(k for _, k in keyed(rows)) == list(range(12))


def test_replacement_reads_the_full_feed(spark):
    stored = bars(spark, [("a", k, 20.0) for k in range(1, 301)])
    daily = incoming(spark, [("a", 0, 10.0), ("a", 1, 10.0)])
    full = incoming(spark, [("a", k, 10.0) for k in range(300)])
    got, status, rows = plan(spark, ["a"], stored, daily, full=full)
    assert (got["a"]["action"], got["a"]["n_rows"]) == ("REPLACE", 300) and len(keyed(rows)) == 300
    for short in (None, full.limit(0)):
        got, status, rows = plan(spark, ["a"], stored, daily, full=short)
        assert got["a"]["failed"] and rows.count() == 0
        assert len(keyed(load.merge_bars(stored, rows, status.filter("action = 'REPLACE'")))) == 300


def test_counts_have_every_action(spark):
    _, status, _ = plan(spark, ["a"], bars(spark, []), incoming(spark, [("a", 0, 1.0)]))
    counts = {r["action"]: r["codes"] for r in load.status_counts(status).collect()}
    assert counts == {"FULL": 1, "REPLACE": 0, "DIFF": 0, "SKIP": 0, "ERROR": 0}


def test_validate_rows(spark):
    raw = spark.createDataFrame(
        [("1301", "2026-03-02", "1", "", "x", "2.5", "10.9"), ("toolongcode", "2026-03-02", "1", "1", "1", "1", "1"),
         ("1302", "2026/03/02", "1", "1", "1", "1", "1"), ("1303", "2026-02-30", "1", "1", "1", "1", "1"), ("A_-z", "2026-03-01", None, None, None, None, None)],
        RAW_BARS,
    )
    got = {r["code"]: r for r in load.validate_rows(raw).collect()}
    assert set(got) == {"1301", "A_-z"}
    r = got["1301"]
    assert (r["open"], r["high"], r["low"], r["close"], r["volume"]) == (1.0, None, None, 2.5, 10.0)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "prices")


def test_upsert_overwrites_and_extends(spark, path):
    store.create(bars(spark, [("a", 0, 1.0), ("a", 40, 2.0), ("b", 0, 3.0)]), path, buckets=2)
    rows = bars(spark, [("a", 0, 9.0), ("c", 0, 4.0)])
    for _ in range(2):  # the same rows again change nothing
        store.upsert(spark, path, rows, buckets=2)
        assert keyed(store.read(spark, path)) == {("a", 0): 9.0, ("a", 40): 2.0, ("b", 0): 3.0, ("c", 0): 4.0}


def test_the_store_keeps_its_bucket_count(spark, path):
    store.create(bars(spark, [(f"c{k}", 0, 1.0) for k in range(20)]), path, buckets=2)
    store.upsert(spark, path, bars(spark, [(f"c{k}", 0, 2.0) for k in range(20)]))
    assert store.read(spark, path).count() == 20
    with pytest.raises(ValueError):
        store.upsert(spark, path, bars(spark, [("c1", 0, 3.0)]), buckets=16)


def test_replacement_empties_old_partitions(spark, path):
    store.create(bars(spark, [("a", k, 1.0) for k in (0, 40, 80, 120)] + [("b", 40, 5.0)]), path, buckets=1)
    replaced = spark.createDataFrame([("a",)], "code string")
    store.upsert(spark, path, bars(spark, [("a", 0, 7.0)]), replaced, buckets=1)
    assert keyed(store.read(spark, path)) == {("a", 0): 7.0, ("b", 40): 5.0}


def test_upsert_leaves_other_partitions_alone(spark, path):
    import glob
    import os

    store.create(bars(spark, [("a", 0, 1.0), ("a", 40, 2.0)]), path, buckets=1)
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/ym=*/bucket=*/*.parquet")}
    store.upsert(spark, path, bars(spark, [("a", 0, 3.0)]), buckets=1)
    after = set(glob.glob(f"{path}/ym=*/bucket=*/*.parquet"))
    kept = [p for p in before if p in after]
    assert len(kept) == 1 and "ym=202601" in kept[0] and os.stat(kept[0]).st_mtime_ns == before[kept[0]]


def test_a_load_through_the_store(spark, path):
    store.create(bars(spark, [("split", 1, 20.0), ("split", 400, 22.0), ("diff", 1, 10.0)]), path, buckets=2)
    inc = incoming(spark, [("split", 0, 10.5), ("split", 1, 10.0), ("diff", 0, 11.0), ("diff", 1, 10.0), ("new", 0, 1.0)])
    _, status, rows = plan(spark, ["split", "diff", "new"], store.read(spark, path), inc)
    store.apply_load(spark, path, status, rows)
    assert keyed(store.read(spark, path)) == {("split", 0): 10.5, ("split", 1): 10.0, ("diff", 0): 11.0, ("diff", 1): 10.0, ("new", 0): 1.0}
