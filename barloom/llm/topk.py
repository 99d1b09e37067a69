"""Exact top-k by integer inner product: one KD-tree per shard, best-first search with a propagated bound.

Vectors are dealt to shards of a bounded number of rows. Each shard holds a KD-tree: nodes are split at the median of the widest
dimension, and every node knows the tight box around its vectors. The best score any vector of a box can reach with a query is a sum over
dimensions of the better corner, so nodes are visited from the best bound down, and the search of a shard ends when the bound falls below
the k-th score known so far.

That k-th score is propagated: a first pass looks only into the best leaf of every shard for every query, and the k-th best of all these
real candidates is a lower limit that goes into the full search of every shard, which then returns few rows. Ties are kept, so the result is exact.

Queries travel in rows beside the tree of a shard and are searched batch by batch: a task holds one tree and one batch at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

LEAF_ROWS, SHARD_ROWS = 128, 8_192
#: Sums below this are exact in double precision.
_EXACT = float(1 << 53)
TREE = "shard int, dim int, ids binary, vectors binary, low binary, high binary"


def node_ranges(n: int, leaf: int = LEAF_ROWS) -> list[tuple[int, int]]:
    """Rows of every node of a balanced tree over n rows, node i with children 2i + 1 and 2i + 2."""
    depth = 0
    while n / (1 << depth) > leaf:
        depth += 1
    out = [(0, n)]
    for i in range((1 << depth) - 1):
        lo, hi = out[i]
        out += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
    return out


def build_tree(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of the leaves, and the tight box of every node."""
    order = np.lexsort((ids,))
    ids, vectors = ids[order], vectors[order]
    ranges = node_ranges(len(ids), leaf)
    low = np.empty((len(ranges), vectors.shape[1]), np.int64)
    high = np.empty_like(low)
    for i, (lo, hi) in enumerate(ranges):
        part = vectors[lo:hi]
        low[i], high[i] = part.min(0), part.max(0)
        if 2 * i + 1 < len(ranges):
            axis = int(np.argmax(high[i].astype(np.float64) - low[i]))
            by = np.argpartition(part[:, axis], (hi - lo) // 2)
            ids[lo:hi], vectors[lo:hi] = ids[lo:hi][by], part[by]
    return ids, vectors, low, high


class Tree:
    """Best-first search in one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, leaf: int = LEAF_ROWS):
        self.ids, self.vectors, self.low, self.high = ids, vectors, low.astype(np.float64), high.astype(np.float64)
        self.ranges = node_ranges(len(ids), leaf)
        self.largest = float(max(np.abs(self.low).max(), np.abs(self.high).max()))
        self.floats = vectors.astype(np.float64)

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, only_first_leaf: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its best ids and scores, none below ``floor``; equal scores at the end of the list by smaller id."""
        q = queries.astype(np.float64)
        exact = self.largest * np.abs(q).max(initial=0) * q.shape[1] < _EXACT
        bound = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        if not exact:  # widen, so that rounding never hides a node
            bound += 1e-9 * (np.abs(q) @ np.maximum(np.abs(self.low), np.abs(self.high)).T) + 1
        for r in range(len(q)):
            kth, heap = float(floor[r]), [(-bound[r, 0], 0)]
            ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
            while heap:
                best, node = heapq.heappop(heap)
                if -best < kth:
                    break
                if 2 * node + 1 < len(self.ranges):
                    for child in (2 * node + 1, 2 * node + 2):
                        if bound[r, child] >= kth:
                            heapq.heappush(heap, (-bound[r, child], child))
                    continue
                lo, hi = self.ranges[node]
                found = (self.floats[lo:hi] @ q[r]).astype(np.int64) if exact else self.vectors[lo:hi] @ queries[r]
                use = (found >= kth) & (self.ids[lo:hi] != own[r])
                if use.any():
                    ids, scores = np.concatenate((ids, self.ids[lo:hi][use])), np.concatenate((scores, found[use]))
                    if len(ids) > k:
                        keep = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[keep], scores[keep]
                    if len(ids) == k:
                        kth = max(kth, float(scores.min()))
                if only_first_leaf:
                    break
            yield r, ids, scores


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component; rows with a null id, or a null or non-finite component, take no part."""
    x = F.col(f"`{vector}`")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    usable = x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)) & F.col(f"`{key}`").isNotNull()
    return vectors.where(usable).select(
        F.col(f"`{key}`").cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v")
    )


def _trees(rows: DataFrame, n_shards: int) -> DataFrame:
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, vectors, low, high = build_tree(pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.int64))
        own = [[int(pdf["shard"].iloc[0]), vectors.shape[1], ids.tobytes(), vectors.tobytes(), low.tobytes(), high.tobytes()]]
        return pd.DataFrame(own, columns=["shard", "dim", "ids", "vectors", "low", "high"])

    # Equal ids are spread too: the whole row decides the shard.
    dealt = rows.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id", "v"), F.lit(n_shards)).cast("int").alias("shard"))
    return dealt.groupBy("shard", "dim").applyInPandas(build, TREE)


def _searched(trees: DataFrame, queries: DataFrame, n_shards: int, k: int, only_first_leaf: bool) -> DataFrame:
    """Every query (id, v, kth) against every shard: (query_id, vec_id, score)."""
    from_tree = trees.select("shard", "dim", F.lit(0).alias("kind"), F.struct("ids", "vectors", "low", "high").alias("tree"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<bigint>").alias("v"), F.lit(None).cast("long").alias("kth"))
    everywhere = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    from_query = everywhere.select("shard", F.size("v").alias("dim"), F.lit(1).alias("kind"), F.lit(None).cast(from_tree.schema["tree"].dataType).alias("tree"), "id", "v", "kth")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, tree = None, None
        for pdf in batches:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for (shard, dim, kind), part in pdf.groupby(["shard", "dim", "kind"], sort=True):
                if kind == 0:
                    row = part["tree"].iloc[0]
                    ids = np.frombuffer(row["ids"], np.int64)
                    as_rows = [np.frombuffer(row[c], np.int64).reshape(-1, dim) for c in ("vectors", "low", "high")]
                    at, tree = (shard, dim), Tree(ids, *as_rows)
                elif at == (shard, dim):  # else no vector of this length is in the shard
                    own = part["id"].to_numpy(np.int64)
                    floor = part["kth"].fillna(-np.inf).to_numpy(np.float64)
                    for r, ids, scores in tree.search(np.stack(part["v"].to_numpy()).astype(np.int64), own, floor, k, only_first_leaf):
                        found.append((np.full(len(ids), own[r]), ids, scores))
            if found:
                yield pd.DataFrame({c: np.concatenate([x[i] for x in found]) for i, c in enumerate(("query_id", "vec_id", "score"))})

    both = from_tree.unionByName(from_query).repartition(n_shards, "shard").sortWithinPartitions("shard", "dim", "kind")
    return both.mapInPandas(search, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all vectors for every query, ties to the smaller id.

    A vector is never an answer to its own id. Vectors are compared with queries of the same length only. Rows with a null id, a null or
    empty vector, or a null or non-finite component take no part. A query row that repeats is asked once; a vector row that repeats under
    one id is an answer each time. Without vectors the result is empty. Other columns are not read.
    """
    rows = integer_vectors(vectors, key, vector, scale)
    n_shards = max(1, -(-vectors.count() // shard_rows))
    trees = common.stored(_trees(rows, n_shards), "kd-trees")
    asked = integer_vectors(queries, key, vector, scale).distinct()
    first = _searched(trees, asked.withColumn("kth", F.lit(None).cast("long")), n_shards, k, True)
    limits = _best(first, k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    known = asked.join(limits.withColumnRenamed("query_id", "id"), "id", "left").select("id", "v", "kth")
    found = _searched(trees, common.stored(known, "kd-queries"), n_shards, k, False)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


QUERIES = {"op1_topk": op1_topk}
ORACLES = {
    "op1_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id AS query_id, v AS q FROM v WHERE vec_id % 100 = 0),
s AS (SELECT query_id, vec_id, CAST(list_dot_product(q, v) AS BIGINT) AS score FROM q, v WHERE vec_id <> query_id AND len(q) = len(v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
}
