"""Announcement jobs from stored pages to their reports: disclosures, earnings, holdings and rolling news.

Pages are read in order of ``page_id``; a row's place in its listing is (page_id, row). Rows are extracted once and written inside the
job: the end of the scan and the report both read them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, titles
from ..operators import extract as X
from ..operators import listings as L
from ..operators import news as N
from ..session import materialised
from ..sources import guarded

PLACE = ["page_id", "row"]


def disclosures(pages: DataFrame, target: Column, watch: list[str] | DataFrame | None = None) -> DataFrame:
    """Announcements of the target day, of watched codes only if there is a watch list."""
    rows = X.disclosure_rows(pages).withColumn("day", dates.date_inside(F.col("datetime_str")))
    rows = materialised(rows, "disclosure-rows")
    rows = L.target_day(rows, F.col("day"), target, PLACE)
    return rows if watch is None else L.watched(rows, watch)


def earnings(pages: DataFrame, target: Column) -> DataFrame:
    """Earnings headlines of the target day with company, body and class."""
    rows = materialised(X.extract(pages, X.EARNINGS).filter("code <> '' AND title <> ''"), "earnings-rows")
    rows = L.target_day(rows, dates.market_time(F.col("iso")).cast("date"), target, PLACE)
    split = titles.company_and_body(F.col("title"))
    return rows.select(
        *PLACE, dates.month_day(F.col("iso")).alias("date"), dates.clock(F.col("iso")).alias("time"), "code",
        split["company"].alias("company"), split["body"].alias("body"), titles.first_keyword(split["body"]).alias("class"),
    )


def holdings(pages: DataFrame, target: Column, base_url: str, keywords: tuple[str, ...]) -> DataFrame:
    """Shareholding headlines of the target day that mention a keyword, each link once."""
    rule = X.holdings_rule(base_url)
    rows = X.extract(pages, rule)
    parts = titles.holding_parts(F.col("title"), F.col("flag"), F.col("url"))
    rows = materialised(rows.select(*PLACE, "date", parts.alias("parts")).select(*PLACE, "date", "parts.*"), "holding-rows")
    rows = L.target_day(rows, dates.any_date(F.col("date")), target, PLACE)
    return L.keyword_hits(rows, keywords, PLACE)


@dataclass(frozen=True)
class NewsSource:
    """``style`` says how the source prints its time (see ``news.timed``); the age limit holds for ``limited`` sources."""

    rule: X.Rule
    style: str
    limited: bool = True


def _source_rows(pages: DataFrame, s: NewsSource, k: int, run_ts: Column) -> DataFrame:
    return N.timed(X.extract(pages, s.rule), run_ts, s.style).select(
        *PLACE, "title", "url", "ts", F.lit(s.rule.name).alias("source"),
        F.lit(k).alias("source_rank"), F.lit(s.limited).alias("limited"),
    )


def _merged(parts: list[DataFrame], run_ts: Column, history: DataFrame) -> DataFrame:
    rows = N.fresh_enough(reduce(DataFrame.unionByName, parts), run_ts.cast("timestamp_ntz"), only=F.col("limited")).drop("limited")
    return N.with_ids(N.merge_news(rows, history, ["source_rank", *PLACE])).drop("source_rank")


def rolling_news(
    pages: dict[str, DataFrame], sources: tuple[NewsSource, ...], run_ts: Column, history: DataFrame
) -> DataFrame:
    """News rows to add: each link once, the first source of the list wins, links of ``history`` left out.

    ``pages`` holds the pages of every source under the name of its rule. Rows whose time cannot be read are dropped.
    """
    parts = [_source_rows(pages[s.rule.name], s, k, run_ts).filter("ts IS NOT NULL") for k, s in enumerate(sources, 1)]
    return _merged(parts, run_ts, history)


def rolling_news_guarded(
    pages: dict[str, Callable[[], DataFrame]], sources: tuple[NewsSource, ...], run_ts: Column, history: DataFrame
) -> tuple[DataFrame | None, DataFrame, list[guarded.Loaded]]:
    """The same from sources that may fail: (rows to add, report, sources as loaded). The rest goes on without a source that fails.

    ``pages`` holds a reader per source. Rows whose time cannot be read are kept with their reason in ``rejected`` of their source.
    Rows are None when every source failed.
    """
    spark = history.sparkSession
    reason = F.when(F.col("ts").isNull(), "unreadable time")
    loaded = [
        guarded.load(spark, s.rule.name, lambda s=s, k=k: _source_rows(pages[s.rule.name](), s, k, run_ts), reason)
        for k, s in enumerate(sources, 1)
    ]
    parts = [x.rows for x in loaded if x.rows is not None]
    return (_merged(parts, run_ts, history) if parts else None), guarded.report(spark, loaded), loaded
