"""Texts against a table of keywords.

The keywords go into a multi-pattern automaton (Aho and Corasick 1975), built once per task, which reads every text once, however many
keywords there are. What travels to the tasks is bounded: ``PASS_KEYWORDS`` keywords and ``PASS_BYTES`` bytes of them. A larger table is dealt
over several passes by a hash of the keyword; each pass keeps the better of its find and the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import no_blanks
from ..session import materialised, shared_dir

PASS_KEYWORDS, PASS_BYTES = 50_000, 4 << 20


def bare_keywords(keywords: DataFrame, keyword: str = "keyword", rank: str = "rank") -> DataFrame:
    """(bare, rank, keyword): each keyword without blanks once, under its smallest (rank, keyword); blank ones count for nothing."""
    rows = keywords.select(no_blanks(F.col(keyword)).alias("bare"), F.struct(F.col(rank).cast("long").alias("rank"), F.col(keyword).alias("keyword")).alias("_k"))
    best = rows.filter("bare <> '' AND _k.rank IS NOT NULL").groupBy("bare").agg(F.min("_k").alias("_k"))
    return best.select("bare", "_k.rank", "_k.keyword")


def _pass(rows: DataFrame, mine: list[tuple[str, int, str]]) -> DataFrame:
    """``rows`` with ``_best`` (rank, keyword) improved by the keywords of one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(mine)
    kind = pa.struct([("rank", pa.int64()), ("keyword", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for bare, rank, word in shared.value:
            machine.add_word(bare, (rank, word))
        machine.make_automaton()
        for b in batches:
            k = b.schema.get_field_index("_best")
            best = []
            for text, old in zip(b.column("_bare").to_pylist(), b.column(k).to_pylist()):
                at = (old["rank"], old["keyword"]) if old else None
                for _, hit in machine.iter(text or "") if len(machine) else ():
                    if at is None or hit < at:
                        at = hit
                best.append(at and {"rank": at[0], "keyword": at[1]})
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(best, kind), *b.columns[k + 1 :]], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _in_passes(table: DataFrame, passes: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The keywords with ``part``, ranges in order of rank, and the first and last part of each pass."""
    # Ranges are cut by a sample: a quarter of a pass each, so that the passes made of them come out near their bounds.
    dealt = table.repartitionByRange(4 * passes, "rank", "keyword").withColumn("part", F.spark_partition_id())
    dealt = materialised(dealt, "keyword-parts")
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("bare") + F.octet_length("keyword")).alias("size"))
    out, n, size = [], 0, 0
    for r in sizes.orderBy("part").toLocalIterator():
        if out and n + r["n"] <= PASS_KEYWORDS and size + r["size"] <= PASS_BYTES:
            out[-1] = (out[-1][0], r["part"])
            n, size = n + r["n"], size + r["size"]
        else:
            out.append((r["part"], r["part"]))
            n, size = r["n"], r["size"]
    return dealt, out


def _collected(table: DataFrame) -> list[tuple[str, int, str]]:
    # One slice of the table at a time is in the driver; its size is what the passes were chosen for.
    return [(r["bare"], r["rank"], r["keyword"]) for r in table.collect()]


def _search_in_passes(texts: DataFrame, table: DataFrame, passes: int) -> DataFrame:
    """(_key, _best) of the texts with a find, from (_key, _bare, _best)."""
    spark = texts.sparkSession
    dealt, slices = _in_passes(table, passes)
    turns = [shared_dir(spark, f"keyword-turn-{k}") for k in range(2)]
    out, schema = texts, texts.schema
    for k, (lo, hi) in enumerate(slices):
        found = _pass(out, _collected(dealt.filter(F.col("part").between(lo, hi))))
        # Later passes hold larger ranks only: a text with a find is done, and only its key goes on.
        found.withColumn("_bare", F.when(F.col("_best").isNull(), F.col("_bare"))).write.mode("overwrite").parquet(turns[k % 2])
        out = spark.read.schema(schema).parquet(turns[k % 2])
        if out.filter("_bare IS NOT NULL").isEmpty():
            break
    return out.filter("_best IS NOT NULL").groupBy("_key").agg(F.min("_best").alias("_best"))


def first_listed(rows: DataFrame, keywords: DataFrame, text: str = "title", keyword: str = "keyword", rank: str = "rank") -> DataFrame:
    """The rows with ``keyword`` and ``keyword_rank``: the keyword of the smallest rank that the text contains, blanks ignored on both sides.

    Equal ranks go by the keyword's bytes. Rows without a find have NULL in both; no row is dropped. In several passes the finds
    are joined to the rows by the digest of the text, so other columns are not written.
    """
    table = materialised(bare_keywords(keywords, keyword, rank), "keywords")
    n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("bare") + F.octet_length("keyword")), F.lit(0))).first()
    passes = max(1, -(-n // PASS_KEYWORDS), -(-size // PASS_BYTES))
    best = T.StructType([T.StructField("rank", T.LongType()), T.StructField("keyword", T.StringType())])
    bare, none = no_blanks(F.col(text)), F.lit(None).cast(best)
    if passes == 1:
        out = rows.withColumns({"_bare": bare, "_best": none})
        out = _pass(out, _collected(table)) if n else out
    else:
        key = F.sha2(F.encode(F.col(text), "UTF-8"), 256)
        texts = rows.select(key.alias("_key"), bare.alias("_bare"), none.alias("_best")).filter("_bare <> ''")
        out = rows.withColumn("_key", key).join(_search_in_passes(texts, table, passes), "_key", "left")
    return out.select(*rows.columns, F.col("_best.keyword").alias("keyword"), F.col("_best.rank").alias("keyword_rank"))
