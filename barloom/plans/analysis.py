"""The all-stock daily analysis: 101 columns per code from its newest 200 bars.

Plan shape: one scan of the bars, cut to 200 rows per code before the only large shuffle (on
code); three rounds of windows and one aggregation reuse that partitioning; the base-info join
is left to the optimizer, which broadcasts it only when it is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import float_or_null
from ..operators import market, regress, scores, series
from ..operators.bars import MIN_BARS, SLICE_BARS, repair_nulls, slice_positions
from ..operators.series import SPANS

# Status texts of the report.
STATUS_OK = "正常終了"
STATUS_SHORT = "エラー：データ不足(100件以下)"
STATUS_OTHER = "エラー：その他"


#: Beyond it powers of the smoothing factors leave double precision, and ranks are no longer cut before the shuffle.
LONGEST_SLICE = 1_000


def slope_window(span: int) -> int:
    """A 5-bar series is fitted over 5 values, all longer ones over 10."""
    return 5 if span == 5 else 10


@dataclass(frozen=True)
class Metric:
    number: int
    name: str
    header: str


def _catalog() -> list[Metric]:
    """Numbers, names and spreadsheet headers of the metric columns, in report order."""
    out: list[Metric] = []

    def add(number: int, name: str, text: str, gap: str = "") -> None:
        out.append(Metric(number, name, f"({number}){gap}{text}"))

    pairs = (("close", "終値"), ("volume", "出来高"))
    words = (("open", "始値"), ("high", "高値"), ("low", "安値"), *pairs)
    for k, (name, word) in enumerate(words, 1):
        add(k, name, f"直近の{word}")
    for k, (name, word) in zip((6, 8), pairs):
        add(k, f"{name}_change", f"直近の{word}の前日比")
        add(k + 1, f"{name}_change_pct", f"直近の{word}の前日比率")
    for base, (name, word) in zip((10, 15), pairs):
        for j, s in enumerate(SPANS):
            add(base + j, f"{name}_slope_{s}", f"{word}の直近{s}日間の回帰係数")
    for base, (name, word) in zip((20, 25), pairs):
        for j, s in enumerate(SPANS):
            add(base + j, f"{name}_sma_{s}", f"{word}{s}日移動平均")
    for base, (name, word) in zip((30, 35), pairs):
        for j, s in enumerate(SPANS):
            add(base + j, f"{name}_sma_slope_{s}", f"{word}{s}日移動平均の直近{slope_window(s)}日の回帰係数")
    add(40, "range_mean", "200日分の高値-安値の一日の値幅平均")
    for j, s in enumerate(SPANS):
        add(41 + j, f"range_std_{s}", f"直近{s}日間の高値-安値の値幅のボラティリティ")
    for j, s in enumerate(SPANS):
        text = f"直近{s}日間の高値-安値の値幅のボラティリティの直近{slope_window(s)}日間の回帰係数"
        add(46 + j, f"range_std_slope_{s}", text)
    for numbers, (name, word) in zip(((51, 52, 53, 55, 56), (57, 58, 59, 60, 61)), pairs):
        for k, s in zip(numbers, SPANS):
            add(k, f"{name}_dev_{s}", f"{word}{s}日移動平均と{word}の移動平均乖離率")
    for base, (name, word) in zip((62, 67), pairs):
        for j, s in enumerate(SPANS):
            text = f"{word}{s}日移動平均の移動平均乖離率の直近{slope_window(s)}日間の回帰係数"
            add(base + j, f"{name}_dev_slope_{s}", text)
    named = (
        (72, "beta", "β"), (73, "corr", "相関"), (74, "rel_vol", "相対ボラ"), (75, "resid_vol", "残差ボラ"),
        (76, "beta_up", "アップサイドβ"), (77, "beta_down", "ダウンサイドβ"), (78, "up_capture", "Up Capture"),
        (79, "down_capture", "Down Capture"), (80, "rsi_14", "RSI"), (81, "rsi_slope_22", "RSIの直近22日間の回帰係数"),
        (82, "macd", "MACD"), (83, "macd_slope_22", "MACDの直近22日間の回帰係数"), (84, "streak", "連続日数"),
        (85, "rise_5", "5日間上昇率"), (86, "rise_10", "10日間上昇率"), (88, "rise_22", "22日間上昇率"),
        (89, "fall_5", "5日間下落率"), (90, "fall_10", "10日間下落率"), (91, "fall_22", "22日間下落率"),
        (92, "low_vol_score", "低ボラ出来高増"), (93, "breakout_up", "水平ライン上突破"),
        (94, "breakout_down", "水平ライン下突破"), (95, "gap_retrace", "GUPから全モ"), (96, "composite", "AI基準判定"),
        (97, "style", "タイプ分類"),
    )
    for k, name, word in named:
        add(k, name, word, " ")
    for j, s in enumerate(SPANS):
        add(99 + j, f"range_instability_{s}", f"直近{s}日間の値幅不安定率", " ")
    add(104, "perfect_order", "パーフェクトオーダー判定", " ")
    return out


METRICS = _catalog()
METRIC_NAMES = [m.name for m in METRICS]
MARGIN_DAYS = Metric(98, "margin_days", "(98) 信用買い残日数")
KEY_HEADERS = {"code": "証券コード", "run_date": "更新日", "result": "実行結果"}


def metric_series(bars: DataFrame, slice_bars: int = SLICE_BARS) -> DataFrame:
    """Slice of every code with all per-bar series the metrics need."""
    wanted = bars.select("code", "asof_date", "open", "high", "low", "close", "volume")
    if slice_bars > LONGEST_SLICE:
        raise ValueError(f"the smoothed series hold for slices of up to {LONGEST_SLICE} bars; operators.smoothing does whole histories")
    base = slice_positions(repair_nulls(wanted), slice_bars)
    first = series.with_macd(series.with_range_std(series.with_sma(series.with_steps(base))))
    second = series.with_rsi(series.with_deviation(first))
    devs = [f"{c}_dev_{s}" for c in ("close", "volume") for s in SPANS]
    return series.with_defined_rank(second, devs)


def _metric_aggregates() -> dict[str, Column]:
    out: dict[str, Column] = {"bars": F.max("n")}
    for c in ("open", "high", "low", "close", "volume"):
        out[c] = regress.newest(c)
    out |= scores.step_aggregates()
    rd = "rd"
    for c in ("close", "volume"):
        for s in SPANS:
            average, dev = f"{c}_sma_{s}", f"{c}_dev_{s}"
            out[f"{c}_slope_{s}"] = regress.slope_last_n(c, s)
            out[f"{c}_sma_{s}"] = regress.newest(average)
            out[f"{c}_sma_slope_{s}"] = regress.slope_last_n_defined(average, rd, slope_window(s))
            out[f"{c}_dev_{s}"] = regress.last_defined(dev, f"dr_{c}_dev_{s}")
            out[f"{c}_dev_slope_{s}"] = regress.slope_last_n_defined(dev, f"dr_{c}_dev_{s}", slope_window(s))
    out["range_mean"] = regress.mean_finite("range")
    for s in SPANS:
        std = f"range_std_{s}"
        out[f"range_std_{s}"] = regress.newest(std)
        out[f"range_std_slope_{s}"] = regress.slope_last_n_defined(std, rd, slope_window(s))
    out |= market.market_aggregates()
    for name, slope in (("rsi_14", "rsi_slope_22"), ("macd", "macd_slope_22")):
        out[name] = regress.newest(name)
        out[slope] = regress.slope_last_n_defined(name, rd, 22)
    out["streak"] = scores.streak_aggregate()
    out |= scores.extreme_aggregates() | scores.breakout_aggregates()
    out["gap_retrace"] = scores.gap_retrace_aggregate()
    return out


def metrics(
    bars: DataFrame,
    index: DataFrame | None = None,
    align: str = "position",
    labels: dict[str, str] | None = None,
    min_bars: int = MIN_BARS,
) -> DataFrame:
    """One row per code with at least ``min_bars`` bars: code, bars and every metric.

    Without an ``index`` the market columns are NULL and the style is the last label.
    """
    rows = market.with_index_returns(metric_series(bars).filter(F.col("n") >= min_bars), index, align)
    grouped = rows.groupBy("code").agg(*[a.alias(k) for k, a in _metric_aggregates().items()])
    return with_scores(grouped, labels)


def with_scores(grouped: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Scores, label, instability and perfect order on top of the aggregated metrics."""
    ratios = {f"range_instability_{s}": scores.range_instability(s) for s in SPANS}
    staged = grouped.withColumns(
        {
            "low_vol_score": scores.low_vol_score(),
            "style": scores.style_label(labels),
            "perfect_order": scores.perfect_order(),
            **ratios,
        }
    )
    return staged.withColumn("composite", scores.composite_score()).select("code", "bars", *METRIC_NAMES)


def analyse(
    codes: DataFrame,
    bars: DataFrame,
    index: DataFrame | None,
    run_date: str,
    base_info: DataFrame | None = None,
    align: str = "position",
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """The report: every code of ``codes`` in one row, short histories with a status and blank metrics.

    ``base_info`` has unique ``code`` plus any columns, ``margin_long`` among them for column 98.
    """
    listed = codes.filter(F.trim("code") != "").select(F.trim("code").alias("code"))
    numbered = {m.name: m for m in METRICS}
    out = listed.join(metrics(bars, index, align, labels), "code", "left")
    extras: list[str] = []
    margin = F.lit(None).cast("double")
    if base_info is not None:
        extras = [c for c in base_info.columns if c != "code"]
        clash = {c: f"base_{c}" for c in extras if c in out.columns}
        out = out.join(base_info.withColumnsRenamed(clash), "code", "left")
        extras = [clash.get(c, c) for c in extras]
        if "margin_long" in extras:
            margin = float_or_null(F.col("margin_long"))
    return out.select(
        "code",
        F.lit(run_date).alias("run_date"),
        F.when(F.col("bars").isNotNull(), STATUS_OK).otherwise(STATUS_SHORT).alias("result"),
        *[F.col(k).alias(k, metadata={"number": m.number, "header": m.header}) for k, m in numbered.items()],
        *extras,
        scores.margin_days(margin, F.col("volume_sma_10")).alias(
            MARGIN_DAYS.name, metadata={"number": MARGIN_DAYS.number, "header": MARGIN_DAYS.header}
        ),
    )


def latest_change(codes: DataFrame, bars: DataFrame, min_bars: int = MIN_BARS) -> DataFrame:
    """Newest bar, day change, moving averages and 10-day slope per code, with status."""
    rows = series.with_sma(series.with_steps(slice_positions(repair_nulls(bars)))).filter(F.col("n") >= min_bars)
    aggs = {c: regress.newest(c) for c in ("open", "high", "low", "close", "volume")}
    aggs |= scores.step_aggregates()
    aggs |= {f"close_sma_{s}": regress.newest(f"close_sma_{s}") for s in SPANS}
    aggs["close_slope_10"] = regress.slope_last_n("close", 10)
    per_code = rows.groupBy("code").agg(F.max("n").alias("bars"), *[a.alias(k) for k, a in aggs.items()])
    status = F.when(F.col("bars").isNotNull(), STATUS_OK).otherwise(STATUS_SHORT)
    return codes.join(per_code, "code", "left").withColumn("result", status)
