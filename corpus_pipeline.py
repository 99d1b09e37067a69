"""The corpus pipeline, from raw documents to packed batches.

Every stage takes the rows that the stage before kept and writes a table in the shared folder, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import common, decontamination, packing, quality, shingles, simhash, toxicity

#: Documents with a toxicity of at least, or a quality below, these go.
TOXIC_FROM, QUALITY_FROM = 0.5, 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    p = common.unused(docs, "_toxicity")
    return toxicity.score(docs, model, name=p).where(F.col(p) < TOXIC_FROM).drop(p)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go."""
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    p = common.unused(docs, "_quality")
    return toxicity.score(docs, model, name=p).where(F.col(p) >= QUALITY_FROM).drop(p)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates one document stays: of the smallest id, then text; rows without an id come last.

    Groups are connected by fingerprints of at most RADIUS differing bits, and by five-word shingle sets of a similarity of at least 0.8.
    """
    mark = common.unused(docs, "_text")
    texts = docs.select(F.xxhash64("text").alias("x"), F.col("text").alias("t"))
    marked = common.stored(simhash.fingerprints(texts, "x", "t").distinct(), "near-marks")
    alike = shingles.alike(texts).join(marked.toDF("a", "fp_a"), "a").join(marked.toDF("b", "fp_b"), "b")
    roots = simhash.rooted(marked, more=alike.where("fp_a != fp_b").select(F.greatest("fp_a", "fp_b"), F.least("fp_a", "fp_b")))
    group = marked.join(roots, "fp").select(F.col("x").alias(mark), "root")
    rows = docs.select(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.xxhash64("text").alias(mark)).alias("row"))
    first = rows.join(group, F.col(f"row.{mark}") == F.col(mark)).groupBy("root").agg(F.min("row").alias("row")).select("row.id", F.col(f"row.{mark}").alias("x"))
    again = docs.withColumn(mark, F.xxhash64("text"))
    kept = again.join(first, (again[mark] == first["x"]) & again["doc_id"].eqNullSafe(first["id"]), "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).select(*[common.named(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go."""
    return decontamination.clean(docs, decontamination.fit(docs, common.table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of documents of similar length."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("packing", packed),
]
#: Fitted models have no SQL form; the pipeline is tested stage by stage against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
