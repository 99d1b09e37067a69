"""Exponential smoothing over whole histories: a scan of affine maps.

Every smoothing step is a map y -> a y + b of the value before it, and maps compose: (a2, b2) after (a1, b1) is (a2 a1, a2 b1 + b2). So the
value at a bar is the composition of all maps up to it, applied to 0, and compositions can be taken in any grouping:

1. Bars are numbered per code and cut into blocks of ``BLOCK``. Inside a block, log2(BLOCK) steps compose each map with the one 1, 2, 4, ...
   rows before it (a parallel prefix scan; Blelloch 1990). Windows see one block at a time.
2. The last map of every block stands for the block. These are scanned in the same way, BLOCK times fewer of them per level.
3. A block's value before its first bar goes back to its bars: one join on (code, block).

Nothing is divided by a power of the smoothing factor, so no length of history overflows, and no window or task is asked for
more than a block; the numbering itself goes over each code's bars once, in order, holding none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialised

BLOCK, LEVELS = 64, 3
#: Bars of a code that three levels of blocks can hold; more are refused.
LONGEST = BLOCK**LEVELS


def numbered(bars: DataFrame, key: str = "code", order: str = "asof_date") -> DataFrame:
    """``i``: 0, 1, 2, ... per key in the given order."""
    i = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    checked = F.when(i < LONGEST, i).otherwise(F.raise_error(F.lit(f"more than {LONGEST} rows of one {key}")).cast("int"))
    return bars.withColumn("i", checked)


def _inside(rows: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Each map composed with all before it in its block."""
    block = Window.partitionBy(key, "_block").orderBy("_at")
    step = 1
    while step < BLOCK:
        moved = {}
        for n in names:
            a, b = F.col(f"_a_{n}"), F.col(f"_b_{n}")
            before_a, before_b = F.lag(a, step).over(block), F.lag(b, step).over(block)
            moved[f"_a_{n}"] = F.when(before_a.isNull(), a).otherwise(a * before_a)
            moved[f"_b_{n}"] = F.when(before_a.isNull(), b).otherwise(a * before_b + b)
        rows = rows.withColumns(moved)
        step *= 2
    return rows


def _scanned(rows: DataFrame, key: str, names: list[str], level: int) -> DataFrame:
    """``_a``, ``_b`` of every row become the composition of all maps of the key up to it. ``_at`` numbers the rows from 0."""
    rows = _inside(rows.withColumn("_block", F.floor(F.col("_at") / BLOCK)), key, names)
    if level == LEVELS:
        return rows.drop("_block")
    maps = [f"_{x}_{n}" for n in names for x in "ab"]
    rows = materialised(rows, f"smoothing-{level}")
    whole = rows.groupBy(key, "_block").agg(*[F.max_by(m, "_at").alias(m) for m in maps])
    upper = _scanned(whole.withColumnRenamed("_block", "_at"), key, names, level + 1)
    before = upper.select(key, (F.col("_at") + 1).alias("_block"), *[F.col(m).alias(f"{m}_0") for m in maps])
    joined = rows.join(before, [key, "_block"], "left")
    done = {}
    for n in names:
        a, b = F.col(f"_a_{n}"), F.col(f"_b_{n}")
        done[f"_b_{n}"] = a * F.coalesce(F.col(f"_b_{n}_0"), F.lit(0.0)) + b
        done[f"_a_{n}"] = a * F.coalesce(F.col(f"_a_{n}_0"), F.lit(1.0))
    return joined.withColumns(done).drop("_block", *[f"{m}_0" for m in maps])


def scan(rows: DataFrame, maps: dict[str, tuple[Column, Column]], key: str = "code") -> DataFrame:
    """Add a column per entry: its map y -> a y + b, applied bar by bar from 0, in the order of ``i`` (see ``numbered``)."""
    made = {f"_{x}_{n}": c.cast("double") for n, ab in maps.items() for x, c in zip("ab", ab)}
    scanned = _scanned(rows.withColumns({"_at": F.col("i").cast("long"), **made}), key, list(maps), 1)
    return scanned.withColumns({n: F.col(f"_b_{n}") for n in maps}).drop("_at", *made)


def smoothing(x: Column, alpha: float, seed_from: int, seed_to: int) -> tuple[Column, Column]:
    """The maps of e_i = alpha x_i + (1 - alpha) e_(i-1), seeded with the plain mean of x from ``seed_from`` to ``seed_to``.

    The mean is a sum of maps y + x / n, so it needs no pass of its own; before ``seed_to`` the value is a part of it and undefined.
    """
    i, n = F.col("i"), seed_to - seed_from + 1
    a = F.when(i < seed_from, 0.0).when(i <= seed_to, 1.0).otherwise(1.0 - alpha)
    b = F.when(i < seed_from, 0.0).when(i <= seed_to, x / n).otherwise(alpha * x)
    return a, b


def _known(name: str, seed_to: int) -> Column:
    return F.when(F.col("i") >= seed_to, F.col(name))


def rsi_history(bars: DataFrame, period: int = 14) -> DataFrame:
    """``rsi_<period>`` of every bar of every code, from its first ``period`` steps on; 100 when there was no loss."""
    rows = numbered(bars).withColumn("_step", F.col("close") - F.lag("close").over(Window.partitionBy("code").orderBy("i")))
    step = F.coalesce("_step", F.lit(0.0))
    gain, loss = F.greatest(step, F.lit(0.0)), F.greatest(-step, F.lit(0.0))
    rows = scan(rows, {n: smoothing(x, 1.0 / period, 1, period) for n, x in (("_gain", gain), ("_loss", loss))})
    value = F.when(F.col("_loss") == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + F.try_divide("_gain", "_loss")))
    return rows.withColumn(f"rsi_{period}", F.when(F.col("i") >= period, value)).drop("_gain", "_loss", "_step", "i")


def macd_history(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """``macd`` and ``macd_signal`` of every bar of every code that has at least slow + signal + 2 bars.

    As in the report, the undefined head of the line enters the signal's seed as 0, and an undefined value leaves the signal as it is.
    """
    rows = numbered(bars).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("code")))
    rows = scan(rows, {f"_ema_{p}": smoothing(F.col("close"), 2.0 / (p + 1.0), 0, p - 1) for p in (fast, slow)})
    line = _known(f"_ema_{fast}", fast - 1) - _known(f"_ema_{slow}", slow - 1)
    rows = rows.withColumn("macd", F.when(F.col("_n") >= slow + signal + 2, line))
    i, alpha = F.col("i"), 2.0 / (signal + 1.0)
    head = F.coalesce("macd", F.lit(0.0)) / signal
    a = F.when((i < signal) | F.col("macd").isNull(), 1.0).otherwise(1.0 - alpha)
    b = F.when(i < signal, head).when(F.col("macd").isNull(), 0.0).otherwise(alpha * F.col("macd"))
    rows = scan(rows, {"_signal": (a, b)})
    known = (F.col("_n") >= slow + signal + 2) & (i >= signal - 1)
    return rows.withColumn("macd_signal", F.when(known, F.col("_signal"))).drop("_signal", "_n", "i", f"_ema_{fast}", f"_ema_{slow}")
