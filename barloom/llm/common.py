"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialised

#: Bytes that part words, as a class for regular expressions; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits that tell the keys with a label from others, 8 MB; with more labels than that more rows without one pass, and are dropped by the join.
MARKS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def by_place(df: DataFrame) -> DataFrame:
    """The same columns called c0, c1, ...: Arrow functions take columns by name, and not every name can be looked up."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """A table in the shared checkpoint folder: computed once, and read again if an executor is lost."""
    return materialised(df, f"llm-{purpose}")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def words(text: Column) -> Column:
    """The number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _given(labels: DataFrame, label: str, key: str) -> DataFrame:
    return labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, label).distinct()


def shards(labels: DataFrame, label: str, key: str, bound: int) -> int:
    """How many learners of about ``bound`` rows each it takes to learn from every label."""
    return max(1, -(-_given(labels, label, key).count() // bound))


def shard(n: int) -> Column:
    """The learner of a row of ``fitting_rows``, by a hash of its key."""
    return F.pmod(F.xxhash64(F.lit("shard"), F.col("h")), F.lit(n)).cast("int")


def _mark(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("mark"), F.col(key)), F.lit(MARKS)) + 1


def _likely(rows: DataFrame, given: DataFrame) -> DataFrame:
    """All rows whose k is in ``given``, and few others: every k of ``given`` sets one bit of ``MARKS``, and the bits travel with the tasks."""
    if dict(rows.dtypes)["k"] != dict(given.dtypes)["k"]:  # keys of two types are equal without having equal hashes
        return rows
    marks = given.groupBy(F.bitmap_bucket_number(_mark("k")).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(_mark("k"))).alias("bits"))
    placed = rows.withColumns({"b": F.bitmap_bucket_number(_mark("k")), "at": F.bitmap_bit_position(_mark("k")).cast("int")})
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.element_at(F.lit([1, 2, 4, 8, 16, 32, 64, 128]), F.col("at") % 8 + 1)), F.lit(2))
    return placed.join(F.broadcast(marks), "b").where(bit == 1).select("k", "t")


def fitting_rows(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, bound: int | None = None) -> DataFrame:
    """(h, y, t): hash of the key, label and text of all labelled rows; of at most about ``bound`` of them only for a caller that asks, as no query does.

    Rows whose label or key is null are left out. A key counts once per label, with its smallest text if it has several, so a key that
    holds a third of all rows adds no more than any other: its rows shrink to one in every task. Texts are shuffled once, and nearly only
    those that have a label.
    """
    given = _given(labels, label, key)
    n = 0 if bound is None else given.count()
    if bound is not None and n > bound:
        given = given.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000)) < int(1_000_000 * bound / n))
    given = given.select(F.col(key).alias("k"), F.col(label).cast("double").alias("y")).distinct()
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    texts = _likely(rows, given).groupBy("k").agg(F.min("t").alias("t"))
    return texts.join(given, "k").select(F.xxhash64("k").alias("h"), "y", "t")


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str, per_block: int = 65_536) -> DataFrame:
    """``name``: 0, 1, 2, ... within each group, without bringing a group, a key or the copies of a row together in one task.

    Rows that agree in all of ``groups`` and ``order`` are counted first, so a row that repeats a billion times is one row on the way to its
    count. The count is cut into pieces of ``per_block``, and a hash of the whole row and the number of the piece deals the pieces over
    blocks, whatever key is hot. A small table of block sizes gives each block its first number; ranks are taken inside a block, and pieces become
    rows again where they are. The order is: block, then ``order``.
    """
    n_blocks = 2 * (df.count() // per_block + 1) + 1
    same = df.groupBy(*groups, *order).agg(F.count(F.lit(1)).alias("_n"))
    same = same.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / per_block))))
    same = same.withColumn("_n", F.least(F.lit(per_block).cast("long"), F.col("_n") - F.col("_piece") * per_block))
    same = same.withColumn("_block", F.pmod(F.xxhash64(*groups, *order, "_piece"), F.lit(n_blocks)))
    inside = Window.partitionBy(*groups, "_block").orderBy(*[F.col(c).asc_nulls_first() for c in order], "_piece")
    same = same.withColumn("_before", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    sizes = same.groupBy(*groups, "_block").agg(F.sum("_n").alias("_size"))
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*groups, "_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_first"))
    start = F.col("_first") + F.coalesce(F.col("_before"), F.lit(0))
    return (
        same.join(firsts, [*groups, "_block"])
        .withColumn(name, F.explode(F.sequence(start, start + F.col("_n") - 1)))
        .drop("_block", "_first", "_before", "_n", "_piece")
    )


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
