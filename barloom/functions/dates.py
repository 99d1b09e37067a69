"""Date and time parsing. "Now" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import trim

MARKET_ZONE = "Asia/Tokyo"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


#: A day with one kind of separator; a year of two digits goes with slashes only. Groups: year, separator, month, day.
_DAY = r"(\d{4}|\d{2}(?=/))([-/])(\d{1,2})\2(\d{1,2})"
_FULL_DAY = r"(\d{4})(/)(\d{2})/(\d{2})"
_SHORT_DAY = r"(?<!\S)(\d{2})(/)(\d{2})/(\d{2})(?!\S)"
#: A day whose year may be left out, and a clock whose seconds may. Groups: year, month, day, hour, minute, second.
_DAY_AND_CLOCK = r"^(?:(\d{4})/)?(\d{2})/(\d{2})\s+(\d{2}):(\d{2})(?::([0-5]\d))?$"


def _day(s: Column, pattern: str) -> Column:
    """The date of the first match, two-digit years in this century; NULL for none or for no day of the calendar."""
    year, month, day = (F.regexp_extract(s, pattern, g) for g in (1, 3, 4))
    full = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    return F.try_to_date(F.concat_ws("-", full, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def market_time(iso: Column, zone: str = MARKET_ZONE) -> Column:
    """ISO time as wall time of the market; texts without an offset already are wall time."""
    s = trim(iso)
    moved = F.convert_timezone(None, F.lit(zone), F.try_to_timestamp(s))
    return F.when(s.rlike(_OFFSET), moved).otherwise(s.try_cast("timestamp_ntz"))


def market_time_text(iso: Column, zone: str = MARKET_ZONE) -> Column:
    return F.date_format(market_time(iso, zone), "yyyy-MM-dd HH:mm:ss")


def month_day(iso: Column) -> Column:
    return F.date_format(market_time(iso), "MM/dd")


def clock(iso: Column) -> Column:
    return F.date_format(market_time(iso), "HH:mm")


def any_date(s: Column) -> Column:
    """Y-m-d, Y/m/d, yy/m/d (this century) or an ISO time, as a date; otherwise NULL."""
    t = trim(s)
    return F.coalesce(_day(t, f"^{_DAY}$"), market_time(t).cast("date"))


def date_inside(s: Column) -> Column:
    """First Y/m/d found in a text, else a two-digit-year date standing alone."""
    return F.coalesce(_day(s, _FULL_DAY), _day(s, _SHORT_DAY))


def date_key(s: Column) -> Column:
    """First eight digits of a text as a number."""
    digits = F.regexp_extract_all(s, F.lit(r"\d"), F.lit(0))
    return F.array_join(F.slice(digits, 1, 8), "").try_cast("int")


def inferred_time(s: Column, run_ts: Column) -> Column:
    """``Y/m/d H:M`` or ``m/d H:M`` wall time; a yearless time after ``run_ts`` belongs to last year.

    Missing seconds count as 00.
    """
    t, now = trim(s), run_ts.cast("timestamp_ntz")
    year, month, day, hour, minute, second = (F.regexp_extract(t, _DAY_AND_CLOCK, g).try_cast("int") for g in range(1, 7))

    def in_year(y: Column) -> Column:
        return F.try_make_timestamp_ntz(y, month, day, hour, minute, F.coalesce(second, F.lit(0)))

    this_year = in_year(F.year(now))
    yearless = F.when(this_year > now, this_year - F.expr("INTERVAL 1 YEAR")).otherwise(this_year)
    return F.when(year.isNotNull(), in_year(year)).otherwise(yearless)


def day_at_run_clock(day: Column, run_ts: Column) -> Column:
    """``Y/m/d`` with the run's clock time."""
    text = F.concat(
        F.date_format(_day(trim(day), f"^{_FULL_DAY}$"), "yyyy-MM-dd"),
        F.lit(" "),
        F.date_format(run_ts, "HH:mm:ss"),
    )
    return text.try_cast("timestamp_ntz")


def compare_days(a: Column, b: Column, invalid_is_equal: bool = False) -> Column:
    """-1, 0 or 1 for two ``Y-m-d`` texts; an invalid side gives NULL, or 0 on request."""

    def day(s: Column) -> Column:
        return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))

    cmp = F.signum(F.datediff(day(a), day(b))).cast("int")
    return F.coalesce(cmp, F.lit(0)) if invalid_is_equal else cmp
