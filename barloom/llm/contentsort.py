"""Exact duplicates by a sort of the contents.

1. Texts are normalised: every run of white space becomes one space.
2. Sampled splitters deal the rows into ranges of (first ``HEAD`` bytes, 64-bit mark of the whole text, key). The splitters, which go
   through the driver, hold these short columns only. The key is part of them, so a text that fills a third of the table
   spans as many ranges as its rows need.
3. Every range is sorted (Spark's sort, which spills) by the same columns with the whole text before the key: equal texts stand side by
   side, the smallest key first, whatever the marks.
4. One pass over a range compares neighbours in full and closes a run of equal texts when the next text differs.
5. A run may go on in the next range. The first and the last run of every range, with their texts, are compared with those of the
   range after it and chained: at most two rows per range.

Each text is shuffled once; nothing is grouped by a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bytes of a text in a splitter.
HEAD = 64
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, part): keys and normalised texts in ranges, sorted inside each; ``part`` numbers the ranges in their order."""
    rows = docs.select(common.named(key).alias("k"), normalised(common.named(text)).cast("binary").alias("t"))
    rows = rows.select("k", "t", F.substring("t", 1, HEAD).alias("head"), F.xxhash64("t").alias("mark"), F.col("k").isNull().alias("last"))
    dealt = rows.repartitionByRange("head", "mark", "last", "k")
    return dealt.sortWithinPartitions("head", "mark", "t", "last", "k").select("k", "t", F.spark_partition_id().alias("part"))


def runs(ordered: DataFrame) -> DataFrame:
    """One row per row: k, part, run, first (smallest key of the run), n (its rows in this range), leads (whether the row is its first),
    digest, and edge: the text, on the leading row of the first and the last run of the range, else null."""
    kind = ordered.schema["k"].dataType
    schema = T.StructType(
        [T.StructField("k", kind), T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("first", kind),
         T.StructField("n", T.LongType()), T.StructField("leads", T.BooleanType()), T.StructField("digest", T.BinaryType()), T.StructField("edge", T.BinaryType())]
    )

    def close(part: int, run: int, text: bytes, keys: list[pa.Array], last: bool) -> pa.RecordBatch:
        k = pa.concat_arrays(keys)
        n = len(k)
        leads = np.zeros(n, bool)
        leads[0] = True
        digest = pa.array([hashlib.sha256(text).digest()], pa.binary())
        edge = pa.concat_arrays([pa.array([text if last or run == 0 else None], pa.binary()), pa.nulls(n - 1, pa.binary())])
        at = pa.array(np.zeros(n, np.int64))
        columns = [k, pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, run)), k.take(at), pa.array(np.full(n, n)), pa.array(leads), digest.take(at), edge]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, text, keys = 0, -1, b"", []
        for b in batches:
            if not b.num_rows:
                continue
            t, k, part = b.column("t"), b.column("k"), b.column("part")[0].as_py()
            new = np.ones(len(t), bool)
            new[0] = run < 0 or t[0].as_py() != text
            if len(t) > 1:
                new[1:] = ~pc.equal(t.slice(1), t.slice(0, len(t) - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            keys += [k.slice(0, int(starts[0]) if len(starts) else len(k))]
            done = []
            for lo, hi in zip(starts, [*starts[1:], len(t)]):
                if run >= 0:
                    done.append(close(part, run, text, keys, False))
                run, text, keys = run + 1, t[int(lo)].as_py(), [k.slice(int(lo), int(hi - lo))]
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if run >= 0:
            yield close(part, run, text, keys, True)

    return ordered.mapInArrow(walk, schema)


def chained(marked: DataFrame) -> DataFrame:
    """(part, run, keep, total, heads): runs at the ends of ranges, put together with their continuations.

    A run goes on if the first text of the next range that has rows is the same, compared in full. All windows here see at
    most two rows per range; texts meet in a join on the number of the row, not in a window.
    """
    edges = marked.where(F.col("edge").isNotNull())
    order = Window.orderBy("part", "run")
    ends = common.stored(edges.select("part", "run", "first", "n").withColumn("i", F.row_number().over(order)), "sort-ends")
    texts = edges.select("part", "run", "edge").join(F.broadcast(ends.select("part", "run", "i")), ["part", "run"])
    before = texts.select((F.col("i") + 1).alias("i"), F.col("part").alias("p"), F.col("edge").alias("e"))
    goes_on = texts.join(before, "i").where((F.col("p") != F.col("part")) & (F.col("e") == F.col("edge"))).select("i", F.lit(False).alias("heads"))
    linked = ends.join(goes_on, "i", "left").withColumn("heads", F.coalesce("heads", F.lit(True)))
    linked = linked.withColumn("chain", F.sum(F.col("heads").cast("int")).over(Window.orderBy("i")))
    of = Window.partitionBy("chain")
    return linked.select("part", "run", F.min("first").over(of).alias("keep"), F.sum("n").over(of).alias("total"), "heads")


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, keep (key of the row that stays), group_size, kept, digest (SHA-256 of the normalised text).

    A null text is an empty one; all empty texts are equal, and a text of white space alone equals a single space. A null key counts as larger
    than any other. Where the smallest key repeats, one of its rows stays. An empty table gives no rows; other columns, whatever
    their names, are not read. Texts of any length are compared as a whole.
    """
    marked = common.stored(runs(in_order(docs, key, text)), "sort-runs")
    joined = marked.drop("edge").join(F.broadcast(chained(marked)), ["part", "run"], "left")
    at_edge = F.col("total").isNotNull()
    return joined.select(
        F.col("k").alias(key),
        F.when(at_edge, F.col("keep")).otherwise(F.col("first")).alias("keep"),
        F.coalesce("total", "n").alias("group_size"),
        (F.col("leads") & F.coalesce("heads", F.lit(True))).alias("kept"),
        "digest",
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each text, that of the smallest key.

    Rows that agree in key and text are one row here.
    """
    mark = common.unused(docs, "_digest")
    kept = copies(docs, key, text).where("kept").select(F.col("digest").alias(mark), common.named(key).alias("_kept"))
    marked = docs.withColumn(mark, F.unhex(F.sha2(normalised(common.named(text)), 256)))
    same = (marked[mark] == kept[mark]) & common.named(key).eqNullSafe(F.col("_kept"))
    found = marked.join(kept, same, "left_semi")
    out = found.dropDuplicates([mark])
    return out.select(*[common.named(c) for c in docs.columns])


def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = copies(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("keep").alias("keep_id"), "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op11_content_sort": op11_content_sort}
ORACLES = {
    "op11_content_sort": r"""WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)"""
}
