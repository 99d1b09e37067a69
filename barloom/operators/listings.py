"""Listing jobs: target-day selection, start gate, ranking, labelled unions, keyword counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.titles import EARNINGS_KEYWORDS, NO_CLASS, OTHER_LABEL, mentions_any
from .dedupe import first_wins

TOP_DAY, TOP_NIGHT = 20, 30
PRICE_FLOOR = 100


def target_day(
    rows: DataFrame, day: Column, target: Column, order: list[str], by: list[str] | None = None,
    keep_undated: bool = False,
) -> DataFrame:
    """Rows of the target day that stand before the first older row of their listing.

    Newer rows are passed over; the first older row ends the scan, whatever follows it. ``order`` is
    the reading position (page, row) and ``by`` names the listing. The end of the scan is one
    value per listing from a partial aggregation, so no listing is ever sorted or held in one
    task. Undated rows are dropped, or kept as if they were of the target day on request.
    """
    by = by or []
    dated = rows.withColumn("_day", day)
    older = dated.filter(F.col("_day") < target)
    kept = F.col("_day") == target
    if keep_undated:
        kept = kept | F.col("_day").isNull()
    chosen = dated.filter(kept).withColumn("_pos", F.struct(*order))
    stops = older.groupBy(*by).agg(F.min(F.struct(*order)).alias("_stop"))
    if by:
        # One row per listing; the optimizer picks a broadcast or, beyond its size limit, a skew-safe join.
        chosen = chosen.join(stops, by, "left")
        stop = F.col("_stop")
    else:
        stop = stops.select("_stop").scalar()
    return chosen.filter(stop.isNull() | (F.col("_pos") < stop)).drop("_day", "_pos", "_stop")


def gated(rows: DataFrame, page_date: Column, run_date: Column, force: bool = False) -> DataFrame:
    """The rows when the listing's own date is the run date, nothing otherwise."""
    return rows if force else rows.filter(page_date == run_date)


def watched(rows: DataFrame, codes: list[str] | DataFrame, column: str = "code") -> DataFrame:
    """Rows of the watch list, upper and lower case alike; the list may also be a table."""
    if isinstance(codes, DataFrame):
        wanted = codes.select(F.upper("code").alias("_wanted")).distinct()
        return rows.join(wanted, F.upper(column) == F.col("_wanted"), "left_semi")
    return rows.filter(F.upper(column).isin(*[c.upper() for c in codes]))


def top_in_order(rows: DataFrame, k: int, by: list[str], order: list[Column]) -> DataFrame:
    """First k rows per list. The rank filter cuts every task's part to k rows before the shuffle."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def labelled_union(lists: dict[str, DataFrame]) -> DataFrame:
    """Lists under each other with ``list`` and ``list_rank``; columns a list lacks stay NULL."""
    parts = [
        df.withColumns({"list": F.lit(name), "list_rank": F.lit(k)}) for k, (name, df) in enumerate(lists.items(), 1)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def header_and_captured(rows: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    """What the header of each list announces next to the number of rows captured, 0 for a list without rows."""
    captured = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("captured"))
    return headers.join(captured, keys, "left").withColumn("captured", F.coalesce("captured", F.lit(0)))


def keyword_counts(
    rows: DataFrame, column: str = "class", keywords: tuple[str, ...] = EARNINGS_KEYWORDS, other: str = OTHER_LABEL
) -> DataFrame:
    """Counts per class in keyword order, classes without a row left out, the rest under ``other``."""
    order = F.array_position(F.array(*[F.lit(k) for k in (*keywords, NO_CLASS)]), F.col(column))
    label = F.when(F.col(column) == NO_CLASS, other).otherwise(F.col(column))
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(order.cast("int").alias("position"), label.alias("label"), "count")


def keyword_hits(rows: DataFrame, keywords: tuple[str, ...], order: list[str], title="title", url="url") -> DataFrame:
    """Rows whose title mentions a keyword, one per link; rows without a link are left out."""
    hits = rows.filter(mentions_any(F.col(title), keywords) & (F.coalesce(F.col(url), F.lit("")) != ""))
    return first_wins(hits, [url], order)
