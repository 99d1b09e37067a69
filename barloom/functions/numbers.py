"""Lenient number parsing, unit removal and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and words that price pages put around numbers.
NBSP = "\u00a0"
WIDE_SPACE = "　"
WIDE_COMMA = "，"
WIDE_DIGITS = "０１２３４５６７８９"
DASHES = ("-", "－", "ー")
DASH_OUT = "ー"
TIMES_UNIT = "倍"
UNITS = "円|株|％|%"
OKU_UNIT = "億円?"
CHO_UNIT = "兆"

BLANKS = " \t\n\r\0\x0b"
_NUMERIC = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_PREFIX = r"^\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"


def trim(s: Column) -> Column:
    """Strip ASCII blanks and control blanks from both ends."""
    return F.btrim(s, F.lit(BLANKS))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def only_finite(x: Column) -> Column:
    return F.when(finite(x), x)


def strict_number(s: Column) -> Column:
    """The text as a double if the whole of it is one number, else NULL."""
    t = trim(s)
    return F.when(t.rlike(_NUMERIC), t.try_cast("double"))


def number_prefix(s: Column) -> Column:
    """The number a text starts with; 0.0 when it starts with none."""
    return F.coalesce(F.regexp_extract(s, _PREFIX, 1).try_cast("double"), F.lit(0.0))


def ascii_digits(s: Column) -> Column:
    """Full-width digits to ASCII, commas removed."""
    return trim(F.translate(s, WIDE_DIGITS + ",", "0123456789"))


def float_or_null(s: Column) -> Column:
    """Commas and spaces removed, then a double; dashes and other text give NULL."""
    t = trim(s.cast("string"))
    return F.when(~t.isin("", "-", "—"), strict_number(F.translate(t, f",{WIDE_SPACE} ", "")))


def lenient_int(s: Column) -> Column:
    """Keep digits, sign and point, truncate toward zero; nothing left gives 0."""
    kept = F.regexp_replace(s, r"[^\-0-9.]", "")
    return F.coalesce(number_prefix(kept).try_cast("bigint"), F.lit(0).cast("bigint"))


def first_int(s: Column) -> Column:
    """First run of digits once thousands separators are gone, else NULL."""
    return F.regexp_extract(F.translate(s, "," + WIDE_COMMA, ""), r"(\d+)", 1).try_cast("bigint")


def _unspaced(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, "&nbsp;", ""), r"(?U)[\s,]", "")


def drop_units(s: Column) -> Column:
    """Text without blanks, commas and currency, share or percent signs."""
    return trim(F.regexp_replace(_unspaced(s), UNITS, ""))


def number_without_units(s: Column) -> Column:
    """Number without its unit; a lone dash counts as zero, empty input as NULL."""
    t = drop_units(s)
    return F.when(s.isNull() | (s == ""), None).when(t.isin("", *DASHES), F.lit(0.0)).otherwise(number_prefix(t))


def one_decimal(s: Column) -> Column:
    return F.when(s.isNotNull() & (s != ""), F.round(number_prefix(_unspaced(s)), 1))


def market_cap(s: Column) -> Column:
    """Market value in units of 10^8, the 10^12 unit expanded by 10,000."""
    t = trim(F.regexp_replace(F.regexp_replace(s, f"&nbsp;|{NBSP}|,", ""), OKU_UNIT, ""))
    parts = F.split(t, CHO_UNIT)
    split = number_prefix(parts[0]) * 10000.0 + number_prefix(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))
    value = F.when(t.contains(CHO_UNIT), split).otherwise(number_prefix(t))
    return F.when(t != "", F.round(value, 1))


def plain_number(x: Column) -> Column:
    """Whole numbers without a point, others with at most six decimals and no trailing zeros."""
    whole = F.abs(x - F.round(x)) < 1e-7
    fixed = F.format_string("%.6f", x)
    shown = F.when(whole, F.round(x).try_cast("bigint").cast("string")).otherwise(
        F.rtrim(F.regexp_replace(fixed, r"0+$", ""), F.lit("."))
    )
    return F.when(x.isNotNull(), shown)


def per_display(s: Column) -> Column:
    """Price/earnings ratio as shown: a lone dash stays a dash."""
    t = trim(F.regexp_replace(s, TIMES_UNIT, ""))
    return F.when(t.isin(*DASHES), F.lit(DASH_OUT)).otherwise(plain_number(one_decimal(t)))


def margin_ratio_display(ratio: Column, short: Column, long_: Column) -> Column:
    """Margin ratio as shown: a dash when either side of it is zero."""
    zero = (F.coalesce(number_without_units(short), F.lit(1.0)) == 0.0) | (
        F.coalesce(number_without_units(long_), F.lit(1.0)) == 0.0
    )
    return F.when(zero, F.lit(DASH_OUT)).otherwise(plain_number(one_decimal(F.regexp_replace(ratio, TIMES_UNIT, ""))))


def floor2(x: Column) -> Column:
    """Floor to two decimals, also below zero."""
    return F.floor(only_finite(x) * 100.0).cast("double") / 100.0


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def sign(x: Column) -> Column:
    return F.coalesce(F.signum(only_finite(x)), F.lit(0.0))


def ratio(a: Column, b: Column, eps: float = 1e-12) -> Column:
    """a / b, NULL when either is missing or b is (almost) zero."""
    return F.when(F.abs(only_finite(b)) >= eps, F.try_divide(only_finite(a), b))
