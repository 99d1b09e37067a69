"""Metrics against plain loops, and the boundaries of every rule."""

import datetime as dt
import random

import pytest
from brute import metrics as brute_metrics
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators import integrity, market, series
from barloom.plans import analysis
from barloom.schemas import BARS

DAY0 = dt.date(2020, 1, 1)


def make(spark, histories):
    """histories: code -> list of (high, low, close, volume) or closes."""
    rows = []
    for code, hist in histories.items():
        for k, b in enumerate(hist):
            h, l, c, v = b if isinstance(b, tuple) else (b, b, b, 100.0)
            rows.append((code, DAY0 + dt.timedelta(days=k), c, h, l, c, v))
    return spark.createDataFrame(rows, BARS)


def row(df, code):
    return next(r.asDict() for r in df.filter(F.col("code") == code).collect())


@pytest.fixture(scope="module")
def histories():
    rng = random.Random(7)
    out = {}
    for code, n in (("long", 260), ("exact", 200), ("short", 130), ("least", 101)):
        price, hist = 1000.0, []
        for k in range(n):
            price = max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
            spread = rng.uniform(0, 20)
            # Long runs without volume leave holes in the volume deviations.
            hist.append((price + spread, price - spread, price, 0.0 if (k // 12) % 3 == 0 else float(rng.randint(1, 500))))
        out[code] = hist
    out["quiet"] = [(b[0], b[1], b[2], 0.0) for b in out["exact"]]
    return out


@pytest.mark.parametrize("code", ["long", "exact", "short", "least", "quiet"])
def test_metrics_match_plain_loops(spark, histories, code):
    got = row(analysis.metrics(make(spark, {code: histories[code]})), code)
    want = brute_metrics(histories[code][-200:])
    want.pop("macd_signal")
    for name, value in want.items():
        if value is None:
            assert got[name] is None, name
        else:
            assert got[name] == pytest.approx(value, rel=1e-8, abs=1e-9), name


def test_macd_signal(spark, histories):
    df = series.with_macd_signal(series.with_macd(B.slice_positions(make(spark, {"long": histories["long"]}))))
    got = df.filter("rd = 1").collect()[0]["macd_signal"]
    assert got == pytest.approx(brute_metrics(histories["long"][-200:])["macd_signal"], rel=1e-9)


def test_catalog_of_columns():
    numbers = [m.number for m in analysis.METRICS]
    assert len(numbers) == 101 and numbers == sorted(numbers)
    assert {54, 87, 98}.isdisjoint(numbers)
    assert analysis.METRICS[0].header == "(1)直近の始値" and analysis.METRICS[-1].header == "(104) パーフェクトオーダー判定"


def test_gate_and_status(spark, histories):
    bars = make(spark, {"least": histories["least"], "few": histories["least"][:100]})
    codes = spark.createDataFrame([("least",), (" few ",), ("none",), ("",)], "code string")
    base = spark.createDataFrame([("least", "1,234", "x"), ("few", "-", "y")], "code string, margin_long string, kind string")
    out = {r["code"]: r.asDict() for r in analysis.analyse(codes, bars, None, "2020-06-01", base).collect()}
    assert set(out) == {"least", "few", "none"}
    assert out["least"]["result"] == analysis.STATUS_OK and out["least"]["kind"] == "x"
    assert out["few"]["result"] == analysis.STATUS_SHORT and out["few"]["close"] is None and out["few"]["kind"] == "y"
    assert out["none"]["result"] == analysis.STATUS_SHORT and out["none"]["margin_days"] is None
    assert out["least"]["margin_days"] == pytest.approx(1234 * 1000 / out["least"]["volume_sma_10"])


def test_null_repair(spark):
    bars = spark.createDataFrame([("a", DAY0, None, None, None, 5.0, None), ("b", DAY0, 1.0, None, None, None, 7.0)], BARS)
    a, b = (row(B.repair_nulls(bars), c) for c in "ab")
    assert (a["open"], a["high"], a["low"], a["volume"]) == (5.0, 5.0, 5.0, 0.0)
    assert (b["open"], b["high"], b["close"]) == (1.0, 0.0, 0.0)


def test_flat_prices(spark):
    got = row(analysis.metrics(make(spark, {"flat": [50.0] * 120})), "flat")
    assert got["rsi_14"] == 100.0 and got["streak"] == 0 and got["macd"] == pytest.approx(0.0, abs=1e-12)
    assert got["close_slope_10"] == 0.0 and got["perfect_order"] == 0 and got["rise_5"] == 0.0
    assert got["breakout_up"] == 0 and got["breakout_down"] == 0 and got["gap_retrace"] == 0


def test_rising_and_falling(spark):
    up, down = [100.0 + k for k in range(150)], [300.0 - k for k in range(150)]
    out = analysis.metrics(make(spark, {"up": up, "down": down}))
    u, d = row(out, "up"), row(out, "down")
    assert (u["streak"], d["streak"]) == (149, -149)
    assert (u["perfect_order"], d["perfect_order"]) == (1, -1)
    assert u["rsi_14"] == 100.0 and d["rsi_14"] == pytest.approx(0.0)
    # Newest 249 against the shelf's highest, 235: 5.96 % is 19 steps of 0.3 %, so the floor of 1.
    assert u["breakout_up"] == 1 and d["breakout_down"] == 1


def test_breakout_steps(spark):
    base = [100.0] * 119
    out = analysis.metrics(make(spark, {"a": [*base, 100.2], "b": [*base, 101.0], "c": [*base, 99.5], "d": [*base, 100.0]}))
    assert row(out, "a")["breakout_up"] == 10
    assert row(out, "b")["breakout_up"] == 7
    assert row(out, "c")["breakout_down"] == 9
    assert row(out, "d")["breakout_up"] == 0


def test_gap_uses_the_oldest_jump(spark):
    base = [100.0] * 107
    # Jump of 10 % with full retrace to 99: 1 % is two steps of 0.5 % plus one.
    one = [*base, 110.0, *[105.0] * 12, 99.0]
    # The oldest jump (base 90) is not retraced; a later one (base 100) is, and must not count.
    two = [*base[:-1], 90.0, 100.0, 110.0, *[105.0] * 10, 99.0]
    # The jump is 15 bars back: out of the window.
    late = [*base, 110.0, *[105.0] * 13, 99.0]
    out = analysis.metrics(make(spark, {"one": one, "two": two, "late": late}))
    assert row(out, "one")["gap_retrace"] == 3
    assert row(out, "two")["gap_retrace"] == 0
    assert row(out, "late")["gap_retrace"] == 0


def test_zero_previous_close(spark):
    hist = [100.0] * 118 + [0.0, 50.0]
    got = row(analysis.metrics(make(spark, {"z": hist})), "z")
    assert got["close_change"] == 50.0 and got["close_change_pct"] is None
    assert got["rise_5"] is None and got["fall_5"] == -50.0


def test_market_statistics(spark):
    rng = random.Random(3)
    m = [1000.0]
    for _ in range(199):
        m.append(m[-1] * (1 + rng.uniform(-0.02, 0.02)))
    twice = [50.0]
    for a, b in zip(m, m[1:]):
        twice.append(twice[-1] * (1 + 2 * (b / a - 1)))
    bars = make(spark, {"0010": m, "twice": twice, "recent": twice[80:]})
    index = market.index_series(bars)
    got = row(analysis.metrics(bars, index), "twice")
    assert got["beta"] == pytest.approx(2.0) and got["corr"] == pytest.approx(1.0) and got["rel_vol"] == pytest.approx(2.0)
    assert got["resid_vol"] == pytest.approx(0.0, abs=1e-8) and got["up_capture"] == pytest.approx(2.0)
    same = row(analysis.metrics(bars, index), "0010")
    assert same["style"] == analysis.scores.STYLES["market_mirror"]
    # 120 bars against 200: positions 30..119 of both, which are different days.
    pos = row(analysis.metrics(bars, index), "recent")
    ys = [b / a - 1 for a, b in zip(twice[80:][29:119], twice[80:][30:120])]
    xs = [b / a - 1 for a, b in zip(m[29:119], m[30:120])]
    mx, my = sum(xs) / 90, sum(ys) / 90
    beta = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
    assert pos["beta"] == pytest.approx(beta)


def test_short_index_is_not_used(spark):
    bars = make(spark, {"0010": [100.0 + k % 7 for k in range(100)], "a": [100.0 + k % 5 for k in range(150)]})
    got = row(analysis.metrics(bars, market.index_series(bars)), "a")
    assert got["beta"] is None and got["style"] == analysis.scores.STYLES["none"]


def test_drops_between_years(spark):
    """Drops at the first bar of a year, over a gap of years, and two in one year, of which the newer counts."""
    def bars(code, *days):
        return [(code, dt.date(*day), None, None, None, close, None) for *day, close in days]

    rows = (
        bars("edge", (2018, 12, 30, 900.0), (2018, 12, 31, 900.0), (2019, 1, 2, 500.0))
        + bars("gap", (2018, 5, 5, 900.0), (2021, 5, 5, 500.0), (2022, 1, 1, 510.0))
        + bars("two", (2018, 12, 31, 2000.0), (2019, 1, 2, 1000.0), (2019, 1, 3, 500.0), (2020, 1, 1, 500.0), (2020, 1, 2, 500.0))
        + bars("none", (2018, 12, 31, 500.0), (2019, 1, 2, None), (2020, 1, 2, 300.0))
    )
    got = {r["code"]: r for r in integrity.suspicious_drops(spark.createDataFrame(rows, BARS)).collect()}
    assert set(got) == {"edge", "gap", "two"}
    day = dt.date
    assert [got["edge"][c] for c in ("asof_date", "prev_date", "prev_close", "repair_date")] == [day(2019, 1, 2), day(2018, 12, 31), 900.0, day(2018, 12, 31)]
    assert [got["gap"][c] for c in ("asof_date", "prev_date", "close", "repair_date")] == [day(2021, 5, 5), day(2018, 5, 5), 500.0, day(2021, 5, 5)]
    assert [got["two"][c] for c in ("asof_date", "prev_close", "drop_pct", "repair_date")] == [day(2019, 1, 3), 1000.0, 50.0, day(2020, 1, 1)]


def test_suspicious_drops(spark):
    bars = make(
        spark,
        {
            "hit": [900.0, 500.0, 510.0, 330.0, 331.0, 332.0],
            "small": [400.0, 200.0, 210.0],
            "edge": [1000.0, 650.0, 651.0],
            "rise": [300.0, 900.0],
            "one": [500.0],
        },
    )
    out = {r["code"]: r for r in integrity.suspicious_drops(bars).collect()}
    assert set(out) == {"hit", "edge"}
    h = out["hit"]
    assert (h["close"], h["prev_close"], h["asof_date"]) == (330.0, 510.0, DAY0 + dt.timedelta(days=3))
    assert h["repair_date"] == DAY0 + dt.timedelta(days=4)
    assert h["repair"] == f"update prices_eod set close = 0 where code = 'hit' and asof_date = '{h['repair_date']}';"
