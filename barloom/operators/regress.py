"""Aggregates over the newest bars of a slice: slopes, newest values, extremes.

Columns are given by name (or SQL text); ``rd`` is the bar's rank, 1 = newest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _finite(x: str) -> str:
    return f"({x} IS NOT NULL AND NOT isnan({x}) AND abs({x}) < double('inf'))"


def _weighted_slope(y: str, rank: str, n: int) -> str:
    """Least-squares slope over x = 0 .. n-1, with rank 1 the newest value.

    With evenly spaced x the slope is a fixed weighted sum, one plain ``sum`` per column,
    which keeps the wide aggregation small and inside generated code.
    """
    centre, spread = (n + 1) / 2.0, n * (n * n - 1) / 12.0
    return f"sum(if({rank} <= {n}, {y} * ({centre}D - {rank}), NULL)) / {spread}D"


def slope_last_n(y: str, n: int) -> Column:
    """Slope over the newest n values; NULL when one of them is missing."""
    return F.expr(f"if(count_if(rd <= {n} AND {_finite(y)}) = {n}, {_weighted_slope(y, 'rd', n)}, NULL)")


def slope_last_n_defined(y: str, rank: str, n: int) -> Column:
    """Slope over the newest n *defined* values, gaps closed; NULL when there are fewer."""
    return F.expr(f"if(count_if({rank} <= {n} AND {y} IS NOT NULL) = {n}, {_weighted_slope(y, rank, n)}, NULL)")


def last_defined(x: str, rank: str) -> Column:
    """The newest defined value, however old."""
    return F.expr(f"max(if({rank} = 1, {x}, NULL))")


def newest(x: str) -> Column:
    return F.expr(f"max(if(rd = 1, {x}, NULL))")


def mean_finite(x: str) -> Column:
    return F.expr(f"avg(if({_finite(x)}, {x}, NULL))")


def min_last_n(x: str, n: int) -> Column:
    return F.expr(f"min(if(rd <= {n} AND {_finite(x)}, {x}, NULL))")


def max_last_n(x: str, n: int) -> Column:
    return F.expr(f"max(if(rd <= {n} AND {_finite(x)}, {x}, NULL))")
