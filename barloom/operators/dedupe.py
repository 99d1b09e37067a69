"""First-wins and last-wins per key as aggregations, never as a window over the key.

``min_by``/``max_by`` combine inside every task, so even a key held by a third of all rows sends
one candidate row per task through the shuffle. Rows of fixed-width columns under one order number
are picked by a hash aggregation; rows with texts, or an order of several columns, by a sorted one.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_WHOLE = ("tinyint", "smallint", "int", "bigint", "decimal")
_FIXED = (*_WHOLE, "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def _pick(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    kinds = {c: t.split("(")[0] for c, t in df.dtypes}
    if len(order) == 1 and kinds[order[0]] in _WHOLE and all(kinds[c] in _FIXED for c in rest):
        # A missing order number is the smallest, as it is inside a struct.
        number = F.coalesce(F.col(order[0]).cast("decimal(38,0)"), F.lit(Decimal(-(10**38) + 1)))
        return df.groupBy(*keys).agg(*[pick(c, number).alias(c) for c in rest]).select(*df.columns)
    by: Column = F.struct(*order)
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    return _pick(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key."""
    return _pick(df, keys, order, F.max_by)


def new_only(rows: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``history``; blank history keys count for nothing."""
    known = history.select(F.trim(key).alias(key)).filter(F.col(key) != "").distinct()
    return rows.join(known, key, "left_anti")
