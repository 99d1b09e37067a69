"""The analytic core: panels per bar, statistics per code, the wide report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import integrity, series
from ..operators.market import INDEX_CODE
from ..plans import analysis
from ..session import materialised
from ..sources import adapters
from .common import (
    SQL_BARS_BRAND, SQL_BARS_MIXED, SQL_BARS_SHORT, SQL_BARS_SUPPLIER, SQL_BASE, SQL_CODES, bars_mixed, base_info_of,
    codes_of, index_of, r6, rounded,
)

RUN_DATE = "2002-01-04"
SPANS = series.SPANS
PRICED = ("close", "volume")


SMA = [f"{c}_sma_{s}" for c in PRICED for s in SPANS]
STD = [f"range_std_{s}" for s in SPANS]
DEV = [f"{c}_dev_{s}" for c in PRICED for s in SPANS]
MARKET = ["beta", "corr", "rel_vol", "resid_vol", "beta_up", "beta_down", "up_capture", "down_capture"]
EXTREMES = [f"{k}_{n}" for k in ("rise", "fall") for n in SPANS[:3]]
SLOPES = [f"{c}_slope_{s}" for c in PRICED for s in SPANS]


def _sliced(spark, d):
    return series.with_steps(B.slice_positions(B.repair_nulls(bars_mixed(spark, d))))


def _panel(*cols: str, steps=(), digits=6):
    def run(spark, d):
        df = _sliced(spark, d)
        for s in steps:
            df = s(df)
        return rounded(df.select("code", "asof_date", *cols), digits)

    return run


def _per_code(*cols: str, align: str = "position"):
    """Some columns of the report; the optimizer drops the windows and aggregates behind the others.

    Bars that feed both the slices and the index are written once, like the price table they stand for.
    """
    needs_index = bool({*MARKET, "style"} & {*cols})

    def run(spark, d):
        bars = bars_mixed(spark, d)
        if not needs_index:
            return rounded(analysis.metrics(bars).select("code", *cols))
        bars = materialised(bars, "bars")
        return rounded(analysis.metrics(bars, index_of(bars), align).select("code", *cols))

    return run


def _wide(spark, d):
    bars = materialised(bars_mixed(spark, d), "bars")
    out = analysis.analyse(codes_of(spark, d), bars, index_of(bars), RUN_DATE, base_info_of(spark, d))
    return rounded(out)


def _margin_days(spark, d):
    return _wide(spark, d).select("code", "result", "margin_long", "volume_sma_10", "margin_days")


def _latest_change(spark, d):
    return rounded(analysis.latest_change(codes_of(spark, d), bars_mixed(spark, d)))


def _supplier_metrics(spark, d):
    bars = materialised(adapters.bars_supplier(spark, d), "bars")
    return rounded(analysis.metrics(bars, index_of(bars)).drop("bars"))


def _integrity(spark, d):
    return rounded(integrity.suspicious_drops(adapters.bars_brand(spark, d)))


def _bars_daily(spark, d):
    return adapters.bars_brand(spark, d)


def _breakout_cases(spark, d):
    """The newest close of every code set some thousandths above or below its shelf of bars 15 to 60, so that both scores take all values."""
    bars = materialised(bars_mixed(spark, d), "bars")
    near = B.newest_n(bars, 60)
    shelf = near.groupBy("code").agg(
        F.max("asof_date").alias("newest"), F.max(F.expr("if(rd >= 15, close, NULL)")).alias("_high"), F.min(F.expr("if(rd >= 15, close, NULL)")).alias("_low"),
    )
    k = F.length("code") * 7 + F.ascii(F.substring("code", -1, 1))
    moved = F.when(k % 2 == 0, F.col("_high") * (1.0 + k % 37 / 1000.0)).otherwise(F.col("_low") * (1.0 - k % 37 / 1000.0))
    cases = bars.join(shelf, "code").withColumn("close", F.when(F.col("asof_date") == F.col("newest"), moved).otherwise(F.col("close")))
    return rounded(analysis.metrics(cases.select(*bars.columns)).select("code", *_PER_CODE["score_breakout"], *_PER_CODE["score_gap"]))


_PER_CODE = {
    "slope_panel": SLOPES,
    "sma_slope": [f"{c}_sma_slope_{s}" for c in PRICED for s in SPANS],
    "vol_slope": ["range_mean", *STD, *[f"range_std_slope_{s}" for s in SPANS]],
    "dev_slope": [*DEV, *[f"{c}_dev_slope_{s}" for c in PRICED for s in SPANS]],
    "market_stats_pos": MARKET,
    "rsi_macd_slope": ["rsi_14", "rsi_slope_22", "macd", "macd_slope_22"],
    "streaks": ["streak"],
    "extremes": EXTREMES,
    "score_lowvol": ["low_vol_score"],
    "score_breakout": ["breakout_up", "breakout_down"],
    "score_gap": ["gap_retrace"],
    "score_ai": ["composite"],
    "type_label": ["style"],
    "perfect_order": ["perfect_order"],
    "range_instability": [f"range_instability_{s}" for s in SPANS],
}

QUERIES = {
    "bars_daily": _bars_daily,
    "latest_change": _latest_change,
    "sma_panel": _panel(*SMA, steps=[series.with_sma], digits=4),
    "range_vol_panel": _panel("range", *STD, steps=[series.with_range_std]),
    "deviation_panel": _panel(*DEV, steps=[series.with_sma, series.with_deviation]),
    "rsi14": _panel("rsi_14", steps=[series.with_rsi]),
    "macd": _panel("macd", "macd_signal", steps=[series.with_macd, series.with_macd_signal]),
    **{k: _per_code(*v) for k, v in _PER_CODE.items()},
    "market_stats_date": _per_code(*MARKET, align="date"),
    "score_breakout_cases": _breakout_cases,
    "analysis_wide": _wide,
    "margin_days": _margin_days,
    "analysis_supplier": _supplier_metrics,
    "integrity_hits": _integrity,
}


# --- the same in SQL -------------------------------------------------------------------------

SQL_SLICE = """
slice AS (
  SELECT *, n - rd AS i FROM (
    SELECT code, asof_date, coalesce(open, close) AS open, coalesce(high, close) AS high, coalesce(low, close) AS low,
           coalesce(close, 0) AS close, coalesce(volume, 0) AS volume, rd, count(*) OVER (PARTITION BY code) AS n
    FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) AS rd FROM bars) WHERE rd <= 200)),
steps AS (
  SELECT *, lag(close) OVER w AS prev_close, lag(volume) OVER w AS prev_volume, high - low AS range
  FROM slice WINDOW w AS (PARTITION BY code ORDER BY i))"""


def _frame(s: int) -> str:
    return f"OVER (PARTITION BY code ORDER BY i ROWS BETWEEN {s - 1} PRECEDING AND CURRENT ROW)"


SQL_SERIES = "\nseries AS (SELECT *, " + ", ".join(
    [f"CASE WHEN i >= {s - 1} THEN avg({c}) {_frame(s)} END AS {c}_sma_{s}" for c in PRICED for s in SPANS]
    + [f"CASE WHEN i >= {s - 1} THEN stddev_pop(range) {_frame(s)} END AS range_std_{s}" for s in SPANS]
) + " FROM steps),\ndevs AS (SELECT *, " + ", ".join(
    f"CASE WHEN {c}_sma_{s} <> 0 THEN {c} / {c}_sma_{s} - 1 END AS {c}_dev_{s}" for c in PRICED for s in SPANS
) + " FROM series),\nranked AS (SELECT *, " + ", ".join(
    f"count({d}) OVER (PARTITION BY code ORDER BY i DESC) AS dr_{d}" for d in DEV
) + " FROM devs)"

SQL_SMOOTH = """
seeds AS (
  SELECT code, max(n) AS n, avg(close) FILTER (i < 12) AS s12, avg(close) FILTER (i < 26) AS s26,
         avg(greatest(close - prev_close, 0)) FILTER (i BETWEEN 1 AND 14) AS sg,
         avg(greatest(prev_close - close, 0)) FILTER (i BETWEEN 1 AND 14) AS sl
  FROM steps GROUP BY code),
smooth AS (
  SELECT s.code, s.i, CAST(NULL AS DOUBLE) AS e12, CAST(NULL AS DOUBLE) AS e26, CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l
  FROM steps s WHERE i = 0
  UNION ALL
  SELECT s.code, s.i,
    CASE WHEN s.i < 11 THEN NULL WHEN s.i = 11 THEN d.s12 ELSE s.close * (2.0 / 13) + p.e12 * (1 - 2.0 / 13) END,
    CASE WHEN s.i < 25 THEN NULL WHEN s.i = 25 THEN d.s26 ELSE s.close * (2.0 / 27) + p.e26 * (1 - 2.0 / 27) END,
    CASE WHEN s.i < 14 THEN NULL WHEN s.i = 14 THEN d.sg ELSE (p.g * 13 + greatest(s.close - s.prev_close, 0)) / 14 END,
    CASE WHEN s.i < 14 THEN NULL WHEN s.i = 14 THEN d.sl ELSE (p.l * 13 + greatest(s.prev_close - s.close, 0)) / 14 END
  FROM smooth p JOIN steps s ON s.code = p.code AND s.i = p.i + 1 JOIN seeds d ON d.code = p.code),
osc AS (
  SELECT m.code, m.i, CASE WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END AS rsi_14,
         CASE WHEN d.n >= 37 THEN e12 - e26 END AS macd
  FROM smooth m JOIN seeds d ON d.code = m.code),
signals AS (
  SELECT code, i, CAST(NULL AS DOUBLE) AS sig FROM osc WHERE i = 0
  UNION ALL
  SELECT o.code, o.i, CASE WHEN o.i < 8 OR d.n < 37 THEN NULL WHEN o.i = 8 THEN 0.0
                           WHEN o.macd IS NULL THEN p.sig ELSE o.macd * 0.2 + p.sig * 0.8 END
  FROM signals p JOIN osc o ON o.code = p.code AND o.i = p.i + 1 JOIN seeds d ON d.code = p.code)"""

SQL_INDEX = """
mkt AS (
  SELECT asof_date AS m_date, close AS m_close, lag(close) OVER (ORDER BY asof_date) AS m_prev,
         row_number() OVER (ORDER BY asof_date) - 1 AS m_i, count(*) OVER () AS m_n
  FROM (SELECT asof_date, avg(close) AS close, row_number() OVER (ORDER BY asof_date DESC) AS rd FROM bars GROUP BY asof_date)
  WHERE rd <= 200),
pairs_pos AS (
  SELECT code, close / nullif(prev_close, 0) - 1 AS y, m_close / nullif(m_prev, 0) - 1 AS x
  FROM steps JOIN mkt ON i = m_i
  WHERE m_n >= 101 AND least(n, m_n) >= 91 AND i < least(n, m_n) AND i > least(n, m_n) - 91),
aligned AS (
  SELECT code, asof_date, close, m_close, lag(close) OVER w AS pc, lag(m_close) OVER w AS pm,
         row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) AS r, count(*) OVER (PARTITION BY code) AS c
  FROM steps JOIN mkt ON asof_date = m_date WHERE m_n >= 101 WINDOW w AS (PARTITION BY code ORDER BY asof_date)),
pairs_date AS (
  SELECT code, close / nullif(pc, 0) - 1 AS y, m_close / nullif(pm, 0) - 1 AS x FROM aligned WHERE c >= 91 AND r <= 90)"""


def _market_sql(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT code, coalesce(regr_slope(y, x), 0) AS beta, coalesce(corr(y, x), 0) AS corr,
    stddev_samp(y) / greatest(1e-12, stddev_samp(x)) AS rel_vol,
    sqrt(greatest(regr_syy(y, x) - coalesce(regr_slope(y, x), 0) * regr_sxy(y, x), 0) / greatest(1, count(*) - 2)) AS resid_vol,
    CASE WHEN count(*) FILTER (x > 0) >= 5 THEN coalesce(regr_slope(y, x) FILTER (x > 0), 0) END AS beta_up,
    CASE WHEN count(*) FILTER (x < 0) >= 5 THEN coalesce(regr_slope(y, x) FILTER (x < 0), 0) END AS beta_down,
    avg(y) FILTER (x > 0) / avg(x) FILTER (x > 0) AS up_capture,
    avg(y) FILTER (x < 0) / avg(x) FILTER (x < 0) AS down_capture
  FROM {source} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY code HAVING count(*) >= 30)"""


def _slope(y: str, rank: str, n: int) -> str:
    return (
        f"CASE WHEN count({y}) FILTER ({rank} <= {n}) = {n} "
        f"THEN regr_slope({y}, {n} - {rank}) FILTER ({rank} <= {n} AND {y} IS NOT NULL) END"
    )


def _grouped_sql() -> str:
    out = [f"max({c}) FILTER (rd = 1) AS {c}" for c in ("open", "high", "low", "close", "volume")]
    for c in PRICED:
        out.append(f"max({c} - prev_{c}) FILTER (rd = 1) AS {c}_change")
        out.append(f"max(({c} / nullif(prev_{c}, 0) - 1) * 100) FILTER (rd = 1) AS {c}_change_pct")
        for s in SPANS:
            k = analysis.slope_window(s)
            dev = f"{c}_dev_{s}"
            out.append(f"{_slope(c, 'rd', s)} AS {c}_slope_{s}")
            out.append(f"max({c}_sma_{s}) FILTER (rd = 1) AS {c}_sma_{s}")
            out.append(f"{_slope(f'{c}_sma_{s}', 'rd', k)} AS {c}_sma_slope_{s}")
            out.append(f"arg_max({dev}, i) FILTER ({dev} IS NOT NULL) AS {dev}")
            out.append(f"{_slope(dev, f'dr_{dev}', k)} AS {c}_dev_slope_{s}")
    out.append("avg(range) AS range_mean")
    for s in SPANS:
        out.append(f"max(range_std_{s}) FILTER (rd = 1) AS range_std_{s}")
        out.append(f"{_slope(f'range_std_{s}', 'rd', analysis.slope_window(s))} AS range_std_slope_{s}")
    for c, name in (("rsi_14", "rsi_slope_22"), ("macd", "macd_slope_22")):
        out.append(f"max({c}) FILTER (rd = 1) AS {c}")
        out.append(f"{_slope(c, 'rd', 22)} AS {name}")
    for n in SPANS[:3]:
        for word, agg in (("rise", "min"), ("fall", "max")):
            edge = f"nullif({agg}(close) FILTER (rd <= {n}), 0)"
            out.append(f"floor((max(close) FILTER (rd = 1) / {edge} - 1) * 100 * 100) / 100 AS {word}_{n}")
    out.append("max(sign(close - prev_close)) FILTER (rd = 1) AS last_move")
    out.append("max(close) FILTER (rd BETWEEN 15 AND 60) AS shelf_high")
    out.append("min(close) FILTER (rd BETWEEN 15 AND 60) AS shelf_low")
    out.append(
        "arg_min(prev_close, i) FILTER (rd <= 14 AND prev_close > 0 AND close / nullif(prev_close, 0) - 1 >= 0.08) AS jump_base"
    )
    return ", ".join(out)


SQL_GROUPED = f"""
joined AS (SELECT r.*, o.rsi_14, o.macd FROM ranked r JOIN osc o ON o.code = r.code AND o.i = r.i WHERE r.n >= 101),
runs AS (
  SELECT code, count(*) FILTER (ok) AS run FROM (
    SELECT code, bool_and(sign(close - prev_close) = mv) OVER (PARTITION BY code ORDER BY rd) AS ok
    FROM (SELECT *, max(CASE WHEN rd = 1 THEN sign(close - prev_close) END) OVER (PARTITION BY code) AS mv FROM steps)
    WHERE prev_close IS NOT NULL) GROUP BY code),
grouped AS (SELECT code, max(n) AS bars, {_grouped_sql()} FROM joined GROUP BY code)"""

SQL_SCORED = """
scored AS (
  SELECT g.*, m.* EXCLUDE (code), CAST(last_move * run AS INTEGER) AS streak,
    CASE WHEN range_std_10 < range_std_45 AND close_sma_slope_10 > 0 AND volume_sma_slope_10 > 0
              AND volume_sma_slope_10 > volume_sma_slope_45 AND volume_sma_10 > volume_sma_45 AND volume_sma_45 > 0
         THEN CAST(least(10, floor((volume_sma_10 / volume_sma_45 - 1) / 0.2) + 1) AS INTEGER) ELSE 0 END AS low_vol_score,
    CASE WHEN close > shelf_high AND shelf_high > 0
         THEN CAST(greatest(1, 10 - floor((close - shelf_high) / shelf_high * 100 / 0.3)) AS INTEGER) ELSE 0 END AS breakout_up,
    CASE WHEN close < shelf_low AND shelf_low > 0
         THEN CAST(greatest(1, 10 - floor((shelf_low - close) / shelf_low * 100 / 0.3)) AS INTEGER) ELSE 0 END AS breakout_down,
    CASE WHEN close < jump_base
         THEN CAST(least(10, floor((jump_base - close) / jump_base * 100 / 0.5) + 1) AS INTEGER) ELSE 0 END AS gap_retrace,
    CASE WHEN greatest(close_sma_slope_10, close_sma_slope_22, close_sma_slope_45, close_sma_slope_90) < 0 THEN -1
         WHEN least(close_sma_slope_10, close_sma_slope_22, close_sma_slope_45, close_sma_slope_90) > 0 THEN 1 ELSE 0 END AS perfect_order,
    up_capture * 100 AS uc, down_capture * 100 AS dc
  FROM grouped g LEFT JOIN stats m ON m.code = g.code LEFT JOIN runs r ON r.code = g.code),
final AS (
  SELECT *,
    CAST(round(round(least(10, greatest(0, 5 + 5 * (
      0.35 * (0.5 * sign(round(close_slope_10, 9)) + 0.3 * sign(round(close_slope_22, 9)) + 0.2 * sign(round(close_slope_45, 9)))
      + 0.10 * 0.5 * sign(round(volume_slope_10, 9)) + 0.20 * low_vol_score / 10 + 0.15 * breakout_up / 10
      + 0.10 * (0.7 * least(1, greatest(-1, (rsi_14 - 50) / 20)) + 0.3 * tanh(80 * macd / close))
      - 0.20 * breakout_down / 10 - 0.15 * gap_retrace / 10))), 14)) AS INTEGER) AS composite,
    CASE WHEN beta IS NULL OR corr IS NULL OR rel_vol IS NULL OR resid_vol IS NULL OR beta_up IS NULL OR beta_down IS NULL
              OR uc IS NULL OR dc IS NULL THEN '該当なし'
         WHEN beta > 1.3 AND corr < 0.5 AND resid_vol >= 0.05 AND dc > 130 THEN '危険物'
         WHEN beta > 1.2 AND beta_up > beta AND uc > 120 AND corr >= 0.6 AND dc > 120 THEN '只のハイボラ危険株'
         WHEN corr < 0.5 AND resid_vol >= 0.03 AND beta BETWEEN 0.5 AND 1.5 AND abs(uc - 100) > 30 AND abs(dc - 100) > 30
              AND (abs(uc - dc) > 60 OR (uc - 100) * (dc - 100) < 0) THEN '統計拒否'
         WHEN beta > 1.2 AND beta_up > beta AND uc > 120 AND corr >= 0.6 THEN '攻撃的順張り'
         WHEN beta BETWEEN 0.8 AND 1.2 AND corr >= 0.8 AND rel_vol BETWEEN 0.8 AND 1.2 AND uc BETWEEN 90 AND 110
              AND dc BETWEEN 90 AND 110 THEN '市場の写像'
         WHEN beta < 0.8 AND dc < 80 AND beta_down < 0.7 AND corr <= 0.6 THEN 'ディフェンシブ耐久'
         WHEN beta BETWEEN 0.8 AND 1.2 AND corr >= 0.8 AND rel_vol BETWEEN 0.8 AND 1.2 AND uc BETWEEN 95 AND 115 AND dc < 95
              THEN '非対称アルファ'
         ELSE '該当なし' END AS style,
    %s
  FROM scored)""" % ", ".join(
    f"CASE WHEN abs(close_sma_{s}) >= 1e-12 THEN range_std_{s} / close_sma_{s} END AS range_instability_{s}" for s in SPANS
)

_INTS = {"streak", "low_vol_score", "breakout_up", "breakout_down", "gap_retrace", "composite", "perfect_order"}
_TEXTS = {"style"}


def _out(cols, digits: int = 6) -> str:
    return ", ".join(c if c in _INTS | _TEXTS else r6(c, c, digits) for c in cols)


def _chain(bars_sql: str = SQL_BARS_MIXED) -> str:
    parts = (bars_sql, SQL_SLICE, SQL_SERIES, SQL_SMOOTH, SQL_INDEX, _market_sql("pairs_pos", "stats"), SQL_GROUPED, SQL_SCORED)
    return "WITH RECURSIVE " + ",".join(parts)


def _panel_sql(cols, source: str, digits: int = 6) -> str:
    steps = {"series": SQL_SERIES.split("),\ndevs")[0] + ")", "devs": SQL_SERIES}
    ctes = ",".join((SQL_BARS_MIXED, SQL_SLICE, steps[source]))
    return f"WITH {ctes} SELECT code, asof_date, {_out(cols, digits)} FROM {source}"


def _osc_sql(cols: str) -> str:
    ctes = ",".join((SQL_BARS_MIXED, SQL_SLICE, SQL_SMOOTH))
    return (
        f"WITH RECURSIVE {ctes} SELECT s.code, s.asof_date, {cols} FROM steps s JOIN osc o ON o.code = s.code AND o.i = s.i "
        "JOIN signals g ON g.code = s.code AND g.i = s.i"
    )


def _wide_sql(cols: str) -> str:
    return (
        f"{_chain()},{SQL_CODES},{SQL_BASE}, wide AS (SELECT c.code, '{RUN_DATE}' AS run_date, "
        f"CASE WHEN f.code IS NULL THEN '{analysis.STATUS_SHORT}' ELSE '{analysis.STATUS_OK}' END AS result, "
        "f.* EXCLUDE (code), b.listing_class, b.margin_long, "
        "CASE WHEN b.size % 5 <> 0 AND f.volume_sma_10 > 0 THEN b.size * 1000.0 / f.volume_sma_10 END AS margin_days "
        "FROM codes c LEFT JOIN final f ON f.code = c.code LEFT JOIN base b ON b.code = c.code) "
        f"SELECT {cols} FROM wide"
    )


_LATEST = ["open", "high", "low", "close", "volume", "close_change", "close_change_pct", "volume_change", "volume_change_pct"]
_LATEST += [f"close_sma_{s}" for s in SPANS] + ["close_slope_10"]

ORACLES = {
    "bars_daily": f"WITH {SQL_BARS_BRAND} SELECT * FROM bars_brand",
    "latest_change": f"{_chain()},{SQL_CODES} SELECT c.code, CAST(f.bars AS INTEGER) AS bars, {_out(_LATEST)}, "
    f"CASE WHEN f.code IS NULL THEN '{analysis.STATUS_SHORT}' ELSE '{analysis.STATUS_OK}' END AS result "
    "FROM codes c LEFT JOIN final f ON f.code = c.code",
    "sma_panel": _panel_sql(SMA, "series", 4),
    "range_vol_panel": _panel_sql(["range", *STD], "series"),
    "deviation_panel": _panel_sql(DEV, "devs"),
    "rsi14": _osc_sql(r6("rsi_14", "rsi_14")),
    "macd": _osc_sql(r6("macd", "macd") + ", " + r6("sig", "macd_signal")),
    **{k: f"{_chain()} SELECT code, {_out(v)} FROM final" for k, v in _PER_CODE.items()},
    "market_stats_date": f"WITH {SQL_BARS_MIXED},{SQL_SLICE},{SQL_INDEX},{_market_sql('pairs_date', 'stats')} "
    f"SELECT c.code, {_out(MARKET)} FROM (SELECT DISTINCT code FROM steps WHERE n >= 101) c LEFT JOIN stats s ON s.code = c.code",
    "score_breakout_cases": _chain(
        SQL_BARS_MIXED.replace("bars AS (", "plain AS (") + """,
shelf AS (SELECT code, max(asof_date) AS newest, max(close) FILTER (rd >= 15) AS high, min(close) FILTER (rd >= 15) AS low, length(code) * 7 + ascii(right(code, 1)) AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) AS rd FROM plain) WHERE rd <= 60 GROUP BY code),
bars AS (SELECT p.* REPLACE (CASE WHEN p.asof_date = s.newest THEN
    CASE WHEN k % 2 = 0 THEN s.high * (1.0::DOUBLE + k % 37 / 1000.0::DOUBLE) ELSE s.low * (1.0::DOUBLE - k % 37 / 1000.0::DOUBLE) END ELSE p.close END AS close)
  FROM plain p JOIN shelf s ON s.code = p.code)"""
    )
    + f" SELECT code, {_out([*_PER_CODE['score_breakout'], *_PER_CODE['score_gap']])} FROM final",
    "analysis_wide": _wide_sql(
        f"code, run_date, result, {_out(analysis.METRIC_NAMES)}, listing_class, margin_long, " + r6("margin_days", "margin_days")
    ),
    "margin_days": _wide_sql(
        "code, result, margin_long, " + r6("volume_sma_10", "volume_sma_10") + ", " + r6("margin_days", "margin_days")
    ),
    "analysis_supplier": _chain(f"{SQL_BARS_SUPPLIER}, bars AS (SELECT * FROM bars_supplier)")
    + f" SELECT code, {_out(analysis.METRIC_NAMES)} FROM final",
    "integrity_hits": f"""WITH {SQL_BARS_BRAND},
b AS (SELECT code, asof_date, close, lag(asof_date) OVER w AS pd, lag(close) OVER w AS pc,
             row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) AS rd
      FROM bars_brand WINDOW w AS (PARTITION BY code ORDER BY asof_date)),
h AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY asof_date DESC) AS k FROM b
      WHERE pc <> 0 AND abs((close - pc) / pc) * 100 >= 35 AND close > 200 AND close < pc),
second AS (SELECT code, asof_date AS repair_date FROM b WHERE rd = 2)
SELECT h.code, h.asof_date, {r6("h.close", "close")}, h.pd AS prev_date, {r6("h.pc", "prev_close")},
  {r6("abs((h.close - h.pc) / h.pc) * 100", "drop_pct")}, s.repair_date,
  'update prices_eod set close = 0 where code = ''' || h.code || ''' and asof_date = ''' || strftime(s.repair_date, '%Y-%m-%d') || ''';' AS repair
FROM h JOIN second s ON s.code = h.code WHERE h.k = 1""",
}
