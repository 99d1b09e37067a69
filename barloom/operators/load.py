"""The daily price load: what to do per code, and the rows that result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import strict_number
from ..session import materialised
from .bars import latest_dates, newest_n
from .dedupe import last_wins  # noqa: F401  (part of this module's interface)

FULL, REPLACE, DIFF, SKIP, ERROR = "FULL", "REPLACE", "DIFF", "SKIP", "ERROR"
SPLIT_BARS = 5
KEY = ["code", "asof_date"]
#: What a run keeps of the store before it: the newest SPLIT_BARS bars per code.
FROZEN = "code string, asof_date date, close double"

# Status texts of the load report, {n} is the row count.
STATUS_TEXT = {
    FULL: "全件取得＆DB更新：{n}件",
    REPLACE: "全件洗替：{n}件",
    DIFF: "差分取得＆DB更新：{n}件",
    SKIP: "処理なし",
}
STATUS_FUTURE = "エラー：DBに未来日が保存されている"
STATUS_FAILED = "エラー：株探読み込みに失敗"


def validate_rows(raw: DataFrame) -> DataFrame:
    """Typed bars from text rows; rows with a malformed date or code are dropped."""
    day = F.when(F.col("asof_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date("asof_date", "yyyy-MM-dd"))
    good = F.col("code").rlike(r"^[0-9A-Za-z_\-]{1,8}$") & day.isNotNull()
    prices = {c: strict_number(F.col(c)) for c in ("open", "high", "low", "close")}
    volume = strict_number(F.col("volume")).try_cast("bigint").cast("double")
    return raw.filter(good).withColumns({"asof_date": day, **prices, "volume": volume})


def split_codes(stored: DataFrame, incoming: DataFrame, bars: int = SPLIT_BARS, tolerance: float = 0.0) -> DataFrame:
    """Codes whose newest stored closes differ from the incoming close of the same day.

    Only days that also came in can differ, and a bar's rank depends on newer bars alone, so
    stored bars before the first incoming day are pruned in the scan without changing the result.
    """
    first_day = incoming.agg(F.min("asof_date")).first()[0]
    recent = stored.filter(F.col("asof_date") >= F.lit(first_day).cast("date")).select(*KEY, "close")
    ours = newest_n(recent, bars).select(*KEY, F.col("close").alias("ours"))
    both = ours.join(incoming.select(*KEY, F.col("close").alias("theirs")), KEY)
    gap = F.abs(F.coalesce("ours", F.lit(0.0)) - F.coalesce("theirs", F.lit(0.0)))
    return both.groupBy("code").agg(F.bool_or(gap > tolerance).alias("split")).filter("split")


def load_actions(codes: DataFrame, stored: DataFrame, incoming: DataFrame, run_date: Column, **split) -> DataFrame:
    """(code, latest, action) for every code of the master."""
    latest, today = F.col("latest"), run_date.cast("date")
    action = (
        F.when(latest.isNull(), FULL)
        .when(today > latest, F.when(F.coalesce("split", F.lit(False)), REPLACE).otherwise(DIFF))
        .when(today == latest, SKIP)
        .otherwise(ERROR)
    )
    return (
        codes.select("code")
        .join(latest_dates(stored), "code", "left")
        .join(split_codes(stored, incoming, **split), "code", "left")
        .select("code", "latest", action.alias("action"))
    )


def duplicate_dates(rows: DataFrame) -> DataFrame:
    """(code, asof_date, copies) for every day that came in more than once."""
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def chosen_rows(
    actions: DataFrame, daily: DataFrame, full: DataFrame | None, run_date: Column, cap: int | None = None
) -> DataFrame:
    """Rows each code will load; ``seq`` is the order in which they were read, unique per code and feed.

    A difference load takes the days of ``daily`` after the stored ones up to today. Full and replacing
    loads read the code again in ``full``, all of it unless ``cap`` says how many rows such a load
    reaches back (280 pages' worth in the original report). With a cap the last row within it is looked
    up per code (the rank filter cuts every task's part first) instead of ranking all rows of a code in one task.
    """
    newer = (F.col("asof_date") > F.col("latest")) & (F.col("asof_date") <= run_date.cast("date"))
    diff = daily.join(actions.filter(F.col("action") == DIFF), "code").filter(newer)
    if full is None:
        return diff
    whole = full.join(actions.filter(F.col("action").isin(FULL, REPLACE)), "code")
    if cap is not None:
        ordered = whole.select("code", (-F.col("seq")).alias("_order"))
        reach = newest_n(ordered, cap, order="_order").groupBy("code").agg((-F.min("_order")).alias("_reach"))
        whole = whole.join(reach, "code").filter(F.col("seq") <= F.col("_reach")).drop("_reach")
    return diff.unionByName(whole)


def plan_load(
    codes: DataFrame, stored: DataFrame, daily: DataFrame, full: DataFrame | None, run_date: Column,
    cap: int | None = None, **split,
) -> tuple[DataFrame, DataFrame]:
    """(status, rows) of one run. A code that fails keeps its stored bars and the others go on.

    ``daily`` serves the split check and difference loads, ``full`` the full and replacing loads. A code
    that must be replaced but has no row in ``full`` fails, so a short feed never costs stored history.

    The actions, one row per code, and the chosen rows are written once inside the job: status and rows are short plans over them, and
    no feed is read a second time.

    status: code, action, latest, n_rows, failed. rows: bars to write, with the code's action.
    """
    actions = materialised(load_actions(codes, stored, daily, run_date, **split), "load-actions")
    chosen = materialised(chosen_rows(actions, daily, full, run_date, cap), "load-chosen")
    per_day = chosen.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))
    per_code = per_day.groupBy("code").agg(
        F.sum("copies").alias("n_rows"), F.max("asof_date").alias("newest"), (F.max("copies") > 1).alias("doubled")
    )
    joined = actions.join(per_code, "code", "left")
    n_rows = F.coalesce("n_rows", F.lit(0))
    failed = F.coalesce("doubled", F.lit(False)) | ((F.col("action") == REPLACE) & (n_rows == 0))
    status = joined.select(
        "code",
        F.when(failed, ERROR).otherwise(F.col("action")).alias("action"),
        F.when(failed, F.col("latest")).otherwise(F.coalesce("newest", "latest")).alias("latest"),
        F.when(failed, F.lit(0)).otherwise(n_rows).cast("bigint").alias("n_rows"),
        failed.alias("failed"),
    )
    # A code with a doubled day loads nothing, so what is left has one row per code and day.
    bad = per_code.filter("doubled").select("code")
    return status, chosen.join(bad, "code", "left_anti").select(*chosen.columns)


def status_text(action: str = "action", n_rows: str = "n_rows", failed: str = "failed") -> Column:
    """The report's status text."""
    text = F.when(F.col(failed), STATUS_FAILED)
    for key, template in STATUS_TEXT.items():
        parts = template.split("{n}")
        value = F.concat(F.lit(parts[0]), F.col(n_rows), F.lit(parts[1])) if len(parts) == 2 else F.lit(template)
        text = text.when(F.col(action) == key, value)
    return text.otherwise(STATUS_FUTURE)


def status_counts(status: DataFrame) -> DataFrame:
    """Codes per action; an action without codes counts 0."""
    every = status.sparkSession.createDataFrame([(a,) for a in (FULL, REPLACE, DIFF, SKIP, ERROR)], "action string")
    found = status.groupBy("action").agg(F.count(F.lit(1)).alias("codes"))
    return every.join(found, "action", "left").select("action", F.coalesce("codes", F.lit(0)).alias("codes"))


def merge_bars(stored: DataFrame, rows: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Stored bars without replaced codes, overwritten and extended by ``rows`` on (code, day)."""
    kept = stored if replaced is None else stored.join(replaced.select("code"), "code", "left_anti")
    fresh = rows.select(*stored.columns)
    return kept.join(fresh.select(*KEY), KEY, "left_anti").unionByName(fresh)
