"""The rolling news table: union of sources, age cutoff, dedupe by link, stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_at_run_clock, inferred_time, market_time
from ..functions.text import short_id
from .dedupe import first_wins, new_only

MAX_AGE_DAYS = 8


def fresh_enough(rows: DataFrame, run_ts: Column, days: int = MAX_AGE_DAYS, only: Column | None = None) -> DataFrame:
    """Rows not older than the cutoff; an unreadable time counts as too old.

    ``only`` limits the rule to some rows (the sources it applies to); other rows pass.
    """
    young = F.coalesce(F.col("ts") >= run_ts - F.expr(f"INTERVAL {int(days)} DAYS"), F.lit(False))
    return rows.filter(young if only is None else young | ~only)


def timed(rows: DataFrame, run_ts: Column, style: str, time_text: str = "time_text") -> DataFrame:
    """Add ``ts`` as market wall time from the text a source prints.

    ``iso``: ISO time; ``run``: the source prints no time, the run's is used; ``inferred``: with or
    without year; ``day``: a day only, completed with the run's clock.
    """
    s = F.col(time_text)
    ts = {
        "iso": lambda: market_time(s),
        "run": lambda: run_ts.cast("timestamp_ntz"),
        "inferred": lambda: inferred_time(s, run_ts),
        "day": lambda: day_at_run_clock(s, run_ts),
    }[style]()
    return rows.withColumn("ts", ts)


def with_ids(rows: DataFrame) -> DataFrame:
    """``id`` from time and title, ``read`` blank."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return rows.withColumns({"id": short_id(text, F.col("title")), "read": F.lit("")})


def first_of_links(rows: DataFrame, order: list[str]) -> DataFrame:
    """Each link once, the first row in ``order`` wins. A link that repeats a billion times costs one row per task."""
    return first_wins(rows.withColumn("url", F.trim("url")), ["url"], order)


def merge_news(rows: DataFrame, history: DataFrame, order: list[str]) -> DataFrame:
    """New rows only, each link once, the first source in ``order`` wins.

    Links are reduced to one row each before they meet the history, so both sides of the anti join have unique keys.
    """
    return new_only(first_of_links(rows, order), history, "url")
