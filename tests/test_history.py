"""Whole-history smoothing against plain recursion, and slices of thousands of rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators import smoothing
from barloom.plans import analysis
from barloom.schemas import BARS


def plain_smooth(x, alpha, lo, hi):
    out, e = [None] * len(x), None
    for i, v in enumerate(x):
        if i == hi:
            e = sum(x[lo : hi + 1]) / (hi - lo + 1)
        elif i > hi:
            e = alpha * v + (1 - alpha) * e
        out[i] = e if i >= hi else None
    return out


def plain_rsi(c, period=14):
    gain = [0.0] + [max(b - a, 0.0) for a, b in zip(c, c[1:])]
    loss = [0.0] + [max(a - b, 0.0) for a, b in zip(c, c[1:])]
    g, l = plain_smooth(gain, 1 / period, 1, period), plain_smooth(loss, 1 / period, 1, period)  # noqa: E741
    return [None if a is None else 100.0 if b == 0 else 100 - 100 / (1 + a / b) for a, b in zip(g, l)]


def plain_macd(c):
    if len(c) < 37:
        return [None] * len(c), [None] * len(c)
    f, s = plain_smooth(c, 2 / 13, 0, 11), plain_smooth(c, 2 / 27, 0, 25)
    line = [None if b is None else a - b for a, b in zip(f, s)]
    signal, e = [None] * len(c), 0.0
    for i, v in enumerate(line):
        if i >= 8:
            e = e if v is None else 0.2 * v + 0.8 * e
            signal[i] = e
    return line, signal


@pytest.fixture(scope="module")
def histories(spark):
    r, out = random.Random(1), {}
    for code, n in (("long", 10_000), ("edge", 64 * 64 + 1), ("b", 128), ("c", 65), ("d", 37), ("e", 36), ("f", 15), ("g", 1)):
        out[code] = [round(1000 + 300 * math.sin(k / 50) + r.gauss(0, 20), 2) for k in range(n)]
    out["flat"] = [5.0] * 200
    out["up"] = [float(k) for k in range(1, 101)]
    day = dt.date(1990, 1, 1)
    rows = [(c, day + dt.timedelta(days=k), x) for c, xs in out.items() for k, x in enumerate(xs)]
    return out, spark.createDataFrame(rows, "code string, asof_date date, close double").repartition(6)


def series_of(df, name):
    got = {}
    for r in df.orderBy("code", "asof_date").collect():
        got.setdefault(r["code"], []).append(r[name])
    return got


def near(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-9 * max(1.0, abs(b)))


def test_rsi_of_any_length(histories):
    want, bars = histories
    got = series_of(smoothing.rsi_history(bars), "rsi_14")
    assert got.keys() == want.keys()
    for code, closes in want.items():
        assert all(near(a, b) for a, b in zip(got[code], plain_rsi(closes), strict=True)), code


def test_macd_of_any_length(histories):
    want, bars = histories
    df = smoothing.macd_history(bars)
    line, signal = series_of(df, "macd"), series_of(df, "macd_signal")
    for code, closes in want.items():
        a, b = plain_macd(closes)
        assert all(near(x, y) for x, y in zip(line[code], a, strict=True)), code
        assert all(near(x, y) for x, y in zip(signal[code], b, strict=True)), code
    assert not any(x is not None and math.isnan(x) for xs in signal.values() for x in xs)


def test_fast_smoothing_does_not_overflow(spark):
    """A factor whose powers leave double precision after a few hundred bars."""
    bars = spark.range(3_000).select(F.lit("a").alias("code"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("asof_date"), (F.col("id") % 7 * 1e6).alias("x"))
    rows = smoothing.scan(smoothing.numbered(bars), {"e": smoothing.smoothing(F.col("x"), 0.9, 0, 2)}).orderBy("i").collect()
    want = plain_smooth([k % 7 * 1e6 for k in range(3_000)], 0.9, 0, 2)
    assert all(near(r["e"], w) for r, w in zip(rows[2:], want[2:], strict=True))


def test_slices_too_long_for_the_closed_form_are_refused(spark):
    with pytest.raises(ValueError, match="whole histories"):
        analysis.metric_series(spark.createDataFrame([], BARS), slice_bars=6_000)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 700, 1_500, 10_000])
def test_newest_many(spark, n):
    """A hot key, rows without a day, equal days and repeated rows."""
    r = random.Random(n)
    day = dt.date(2020, 1, 1)
    rows = [("hot" if k % 3 else f"k{k % 11}", None if k % 97 == 0 else day + dt.timedelta(days=r.randrange(900)), k % 1_000) for k in range(6_000)]
    df = spark.createDataFrame(rows, "key string, day date, o int")
    got = sorted((x["key"], x["rd"], str(x["day"]), x["o"]) for x in B.newest_many(df, n, "key", "day", ["o"]).collect())
    want = []
    for key in {x[0] for x in rows}:
        mine = sorted((x for x in rows if x[0] == key), key=lambda x: (x[1] or dt.date.min, x[2]), reverse=True)
        want += [(key, i + 1, str(x[1]), x[2]) for i, x in enumerate(mine[:n])]
    assert got == sorted(want)


def test_no_window_holds_a_whole_key(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1)], "key string, day date, o int")
    text = plan(B.newest_many(df, 5_000, "key", "day", ["o"]))
    partitions = [x.split("]")[0] for x in text.split("row_number()")[1].split("windowspecdefinition(")[1:2]]
    assert partitions and "_month" in partitions[0] and "partial_count" in text
