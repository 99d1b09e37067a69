"""The market snapshot computed from bars: ranked lists and counts for one day.

One scan, one aggregation per code with conditional minima and maxima (all of them combine before
the shuffle), then one row per (code, list). The two limit-price lists need the exchange's table of
daily limits and exist only as extraction from pages.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.listings import PRICE_FLOOR, TOP_DAY, top_in_order


@dataclass(frozen=True)
class RankedList:
    """``sort`` is ranked descending when ``falling``; without ``top`` every qualifying code is listed."""

    name: str
    sort: str
    falling: bool
    condition: str = "true"
    top: int | None = TOP_DAY
    diff: str = "diff"
    diff_pct: str = "diff_pct"
    amount: str = "CAST(NULL AS DOUBLE)"


def _period(name: str, key: str, falling: bool) -> RankedList:
    change = f"(price / nullif({key}, 0) - 1) * 100"
    return RankedList(name, change, falling, f"{change} IS NOT NULL", TOP_DAY, f"price - {key}", change, key)


# Names of the report's lists, in report order.
LISTS: tuple[RankedList, ...] = (
    RankedList("売買代金", "price * volume", True, amount="price * volume"),
    RankedList("出来高", "volume", True, f"price >= {PRICE_FLOOR}", amount="volume"),
    RankedList("今日の株価上昇率", "diff_pct", True, "diff_pct IS NOT NULL"),
    RankedList("今日の株価下落率", "diff_pct", False, "diff_pct IS NOT NULL"),
    RankedList("本日、52週高値更新", "price", True, "price > high_52w", None),
    RankedList("本日、52週安値更新", "price", False, "price < low_52w", None),
    RankedList("本日、年初来高値更新", "price", True, "price > high_ytd", None),
    RankedList("本日、年初来安値更新", "price", False, "price < low_ytd", None),
    _period("今週の株価上昇率", "base_week", True),
    _period("今月の株価上昇率", "base_month", True),
    _period("今年の株価上昇率", "base_year", True),
    _period("過去1週間の株価上昇率", "base_7d", True),
    _period("過去1ヵ月の株価上昇率", "base_1m", True),
    _period("過去1年の株価上昇率", "base_1y", True),
    _period("今週の株価下落率", "base_week", False),
    _period("今月の株価下落率", "base_month", False),
    _period("今年の株価下落率", "base_year", False),
    _period("過去1週間の株価下落率", "base_7d", False),
    _period("過去1ヵ月の株価下落率", "base_1m", False),
    _period("過去1年の株価下落率", "base_1y", False),
)


def _metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics per key from rows of (code, asof_date, t, last, hi, lo, volume): a bar, or a whole month of bars under its last day."""

    def last_close(condition: str) -> Column:
        return F.expr(f"max_by(last, asof_date) FILTER (WHERE {condition})")

    def extreme(agg: str, column: str, since: str) -> Column:
        return F.expr(f"{agg}({column}) FILTER (WHERE asof_date < t AND asof_date >= {since})")

    out = rows.groupBy(*keys).agg(
        F.expr("max(last) FILTER (WHERE asof_date = t)").alias("price"),
        F.expr("max(volume) FILTER (WHERE asof_date = t)").alias("volume"),
        last_close("asof_date < t").alias("prev"),
        extreme("max", "hi", "date_sub(t, 364)").alias("high_52w"),
        extreme("min", "lo", "date_sub(t, 364)").alias("low_52w"),
        extreme("max", "hi", "trunc(t, 'YEAR')").alias("high_ytd"),
        extreme("min", "lo", "trunc(t, 'YEAR')").alias("low_ytd"),
        last_close("asof_date < trunc(t, 'WEEK')").alias("base_week"),
        last_close("asof_date < trunc(t, 'MONTH')").alias("base_month"),
        last_close("asof_date < trunc(t, 'YEAR')").alias("base_year"),
        last_close("asof_date <= date_sub(t, 7)").alias("base_7d"),
        last_close("asof_date <= add_months(t, -1)").alias("base_1m"),
        last_close("asof_date <= add_months(t, -12)").alias("base_1y"),
    )
    return out.filter("price IS NOT NULL").withColumns(
        {"diff": F.col("price") - F.col("prev"), "diff_pct": (F.try_divide("price", "prev") - 1.0) * 100.0}
    )


def _as_rows(bars: DataFrame) -> DataFrame:
    return bars.select("code", "asof_date", *[F.col("close").alias(n) for n in ("last", "hi", "lo")], "volume")


def day_metrics(bars: DataFrame, run_date: Column) -> DataFrame:
    """Price, volume, previous close, earlier extremes and period bases of codes that traded on the day."""
    rows = _as_rows(bars).withColumn("t", run_date.cast("date"))
    return _metrics(rows.filter(F.col("asof_date") <= F.col("t")), ["code"])


def month_state(bars: DataFrame) -> DataFrame:
    """(code, ym, asof_date, last, hi, lo): one row per code and month, under its last day. Combines in every task before the shuffle."""
    month = (F.year("asof_date") * 100 + F.month("asof_date")).cast("int")
    return bars.groupBy("code", month.alias("ym")).agg(
        F.max("asof_date").alias("asof_date"), F.max_by("close", "asof_date").alias("last"), F.max("close").alias("hi"), F.min("close").alias("lo")
    )


def edge_months(day: dt.date) -> list[int]:
    """The months that a bound of the day's metrics cuts: the day itself, 52 weeks, the week, 7 days, a month and a year before.

    Every other month lies inside or outside each period as a whole, so its summary is enough.
    """

    def months_before(n: int) -> dt.date:
        k = day.year * 12 + day.month - 1 - n
        return dt.date(k // 12, k % 12 + 1, 1)

    week = day - dt.timedelta(days=day.weekday())
    cut = [day, day - dt.timedelta(days=364), week, day - dt.timedelta(days=7), months_before(1), months_before(12)]
    return sorted({x.year * 100 + x.month for x in cut})


def days_metrics(bars: DataFrame, state: DataFrame, days: list[dt.date]) -> DataFrame:
    """Metrics of several days (column ``t``) in one aggregation: bars of the edge months only, all other months from their summaries.

    ``bars`` and ``state`` both have the month as ``ym``, so a table partitioned by it is read in these months alone. A summary or bar goes once
    to each of the days, which combine in every task before the shuffle.
    """
    edges = {t: edge_months(t) for t in days}
    cut = sorted({m for months in edges.values() for m in months})
    cases = F.array(*[F.struct(F.lit(t).alias("t"), F.array(*[F.lit(m) for m in months]).alias("cut")) for t, months in edges.items()])
    fine = _as_rows(bars.filter(F.col("ym").isin(cut))).withColumn("ym", F.year("asof_date") * 100 + F.month("asof_date")).withColumn("fine", F.lit(True))
    whole = state.select("code", "asof_date", "last", "hi", "lo", F.lit(None).cast("double").alias("volume"), "ym", F.lit(False).alias("fine"))
    rows = fine.unionByName(whole).filter(F.col("asof_date") <= F.lit(max(days)))
    rows = rows.withColumn("_d", F.explode(cases)).filter(F.array_contains("_d.cut", F.col("ym")) == F.col("fine"))
    rows = rows.select("code", "asof_date", "last", "hi", "lo", "volume", "_d.t").filter(F.col("asof_date") <= F.col("t"))
    return _metrics(rows, ["code", "t"])


def snapshot_entries(metrics: DataFrame, lists: tuple[RankedList, ...] = LISTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every (list, code) that qualifies, before ranking: one pass instead of one scan per list."""
    entries = [
        f"if(coalesce({x.condition}, false), named_struct('list_rank', {k}, 'list', '{x.name}', 'top', {str(x.top is not None).lower()}, "
        f"'sort', double({'-' if x.falling else ''}({x.sort})), 'diff', double({x.diff}), 'diff_pct', double({x.diff_pct}), "
        f"'amount', double({x.amount})), NULL)"
        for k, x in enumerate(lists, 1)
    ]
    picked = F.expr(f"inline(filter(array({', '.join(entries)}), e -> e IS NOT NULL))")
    flat = metrics.select(*keep, "code", "price", "volume", F.col("diff").alias("d"), F.col("diff_pct").alias("p"), picked)
    return flat.select(*keep, "list_rank", "list", "top", "sort", "code", "price", "diff", "diff_pct", "amount")


def snapshot(
    bars: DataFrame, run_date: Column, lists: tuple[RankedList, ...] = LISTS, names: DataFrame | None = None
) -> DataFrame:
    """The lists under each other. ``rank`` is set for top lists; full lists are ordered by ``sort`` only,
    since numbering them would need one task per list.

    One window ranks everything, so bars are read once: a code of a full list is a group of its own there and always
    passes. ``names`` has one row per code with ``code``, ``name`` and ``market``.
    """
    ranked = _ranked(snapshot_entries(day_metrics(bars, run_date), lists), [])
    return ranked if names is None else ranked.join(names.select("code", "name", "market"), "code", "left")


def _ranked(entries: DataFrame, keys: list[str]) -> DataFrame:
    entries = entries.withColumn("_own", F.when(~F.col("top"), F.col("code")))
    ranked = top_in_order(entries, TOP_DAY, [*keys, "list_rank", "_own"], [F.col("sort"), F.col("code")])
    return ranked.withColumn("rank", F.when(F.col("top"), F.col("rank"))).drop("top", "_own")


def snapshots(bars: DataFrame, state: DataFrame, days: list[dt.date], lists: tuple[RankedList, ...] = LISTS) -> DataFrame:
    """The lists of several days (column ``t``) from month summaries and the bars of few months; see ``days_metrics``."""
    return _ranked(snapshot_entries(days_metrics(bars, state, days), lists, ("t",)), ["t"])


def snapshot_counts(bars: DataFrame, run_date: Column, lists: tuple[RankedList, ...] = LISTS) -> DataFrame:
    """Number of codes per full list, 0 for a list without codes."""
    entries = snapshot_entries(day_metrics(bars, run_date), lists)
    found = entries.filter("NOT top").groupBy("list_rank").agg(F.count(F.lit(1)).alias("codes"))
    names = [(k, x.name) for k, x in enumerate(lists, 1) if x.top is None]
    every = bars.sparkSession.createDataFrame(names, "list_rank int, list string")
    return every.join(found, "list_rank", "left").select("list_rank", "list", F.coalesce("codes", F.lit(0)).alias("codes"))
