"""Series over whole histories and slices of thousands of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import smoothing
from ..session import materialised
from ..sources import adapters
from .common import SQL_BARS_BRAND, r6, rounded

NEWEST = 5_000


def _bars(spark, d):
    return materialised(adapters.bars_brand(spark, d).select("code", "asof_date", "close"), "bars")


def _rsi(spark, d):
    return rounded(smoothing.rsi_history(_bars(spark, d)).select("code", "asof_date", "rsi_14"))


def _macd(spark, d):
    return rounded(smoothing.macd_history(_bars(spark, d)).select("code", "asof_date", "macd", "macd_signal"))


_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]


def _newest(spark, d):
    """The newest trades of every return flag: three keys that hold all trades, ranked beyond the group limit."""
    trades = adapters.table(spark, d, "lineitem").select("l_returnflag", F.col("l_shipdate").cast("date").alias("day"), *_ORDER)
    return B.newest_many(trades, NEWEST, "l_returnflag", "day", _ORDER)


QUERIES = {"rsi_history": _rsi, "macd_history": _macd, "newest_trades": _newest}

# One row per code with its closes as a list; the recursion walks along the list, bar by bar.
_WALK = f"""WITH RECURSIVE {SQL_BARS_BRAND},
days AS (SELECT code, asof_date, row_number() OVER (PARTITION BY code ORDER BY asof_date) - 1 AS i FROM bars_brand),
lists AS (SELECT code, list(close ORDER BY asof_date) AS c, count(*) AS n FROM bars_brand GROUP BY code),
walk AS (
  SELECT code, 0 AS i, c[1] AS sum12, c[1] AS sum26, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l FROM lists
  UNION ALL
  SELECT p.code, p.i + 1,
    CASE WHEN p.i + 1 < 11 THEN sum12 + c[p.i + 2] WHEN p.i + 1 = 11 THEN (sum12 + c[p.i + 2]) / 12 ELSE c[p.i + 2] * (2.0::DOUBLE / 13) + sum12 * (11.0::DOUBLE / 13) END,
    CASE WHEN p.i + 1 < 25 THEN sum26 + c[p.i + 2] WHEN p.i + 1 = 25 THEN (sum26 + c[p.i + 2]) / 26 ELSE c[p.i + 2] * (2.0::DOUBLE / 27) + sum26 * (25.0::DOUBLE / 27) END,
    CASE WHEN p.i + 1 < 14 THEN g + greatest(c[p.i + 2] - c[p.i + 1], 0) WHEN p.i + 1 = 14 THEN (g + greatest(c[p.i + 2] - c[p.i + 1], 0)) / 14
         ELSE (g * 13 + greatest(c[p.i + 2] - c[p.i + 1], 0)) / 14 END,
    CASE WHEN p.i + 1 < 14 THEN l + greatest(c[p.i + 1] - c[p.i + 2], 0) WHEN p.i + 1 = 14 THEN (l + greatest(c[p.i + 1] - c[p.i + 2], 0)) / 14
         ELSE (l * 13 + greatest(c[p.i + 1] - c[p.i + 2], 0)) / 14 END
  FROM walk p JOIN lists s ON s.code = p.code WHERE p.i + 1 < s.n),
lines AS (SELECT w.*, n, CASE WHEN i >= 25 AND n >= 37 THEN sum12 - sum26 END AS macd FROM walk w JOIN lists s ON s.code = w.code),
linelists AS (SELECT code, list(macd ORDER BY i) AS m, any_value(n) AS n FROM lines GROUP BY code),
signals AS (
  SELECT code, 8 AS i, 0.0::DOUBLE AS sig FROM lists WHERE n >= 37
  UNION ALL
  SELECT p.code, p.i + 1, CASE WHEN m[p.i + 2] IS NULL THEN sig ELSE m[p.i + 2] * 0.2::DOUBLE + sig * 0.8::DOUBLE END
  FROM signals p JOIN linelists s ON s.code = p.code WHERE p.i + 1 < s.n)"""

ORACLES = {
    "rsi_history": f"""{_WALK} SELECT d.code, d.asof_date, {r6("CASE WHEN d.i >= 14 THEN CASE WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END END", "rsi_14")}
FROM days d JOIN walk w ON w.code = d.code AND w.i = d.i""",
    "macd_history": f"""{_WALK} SELECT d.code, d.asof_date, {r6("macd", "macd")}, {r6("sig", "macd_signal")}
FROM days d JOIN lines w ON w.code = d.code AND w.i = d.i LEFT JOIN signals g ON g.code = d.code AND g.i = d.i""",
    "newest_trades": f"""SELECT * FROM (
  SELECT l_returnflag, CAST(l_shipdate AS DATE) AS day, {', '.join(_ORDER)},
    row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_shipdate AS DATE) DESC, {', '.join(c + ' DESC' for c in _ORDER)}) AS rd FROM lineitem)
WHERE rd <= {NEWEST}""",
}
