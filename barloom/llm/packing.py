"""Packing into optimal length buckets.

The global histogram of lengths is made by one aggregation. Dynamic programming over it finds the bucket boundaries with the least padding:
best[k][j] = min over i of best[k-1][i] + boundary(j) * rows(i..j) - tokens(i..j). The cost has a monotone choice, so a lower envelope of lines
solves each of the k rounds in one sweep over the lengths. Every row then goes to the smallest bucket that holds it, and rows of a bucket are
numbered without gaps and cut into batches that stay within the token budget when padded.

The histogram has one row per distinct length, at most the square root of twice the number of tokens, and is all the driver sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKETS, BUDGET = 16, 65_536


def boundaries(lengths: list[int], rows: list[int], buckets: int) -> list[int]:
    """The upper boundaries, at most ``buckets``, of ascending distinct lengths with the least total padding; exact whole numbers."""
    n = len(lengths)
    if not n:
        return []
    count, total = [0], [0]
    for length, r in zip(lengths, rows):
        count.append(count[-1] + r)
        total.append(total[-1] + r * length)
    # best[j]: least padding of the first j lengths; from[k][j]: where the last of k buckets begins.
    best = [0] + [lengths[j - 1] * count[j] - total[j] for j in range(1, n + 1)]
    origin = [[0] * (n + 1)]
    for _ in range(1, min(buckets, n)):
        # Line i at x = boundary: best[i] + total[i] - x * count[i]. Slopes fall with i and x grows with j: a monotone envelope.
        hull: list[tuple[int, int, int]] = []
        at, new, came = 0, list(best), [0] * (n + 1)
        for j in range(1, n + 1):
            i = j - 1
            m, c = -count[i], best[i] + total[i]
            while len(hull) >= 2:
                (m1, c1, _), (m2, c2, _) = hull[-2], hull[-1]
                if (c - c1) * (m1 - m2) <= (c2 - c1) * (m1 - m):
                    hull.pop()
                else:
                    break
            hull.append((m, c, i))
            at = min(at, len(hull) - 1)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            new[j] = hull[at][0] * x + hull[at][1] + x * count[j] - total[j]
            came[j] = hull[at][2]
        best = new
        origin.append(came)
    out, j = [], n
    for came in reversed(origin):
        if j == 0:
            break
        out.append(lengths[j - 1])
        j = came[j]
    return sorted(out)


def histogram(lengths: DataFrame) -> tuple[list[int], list[int]]:
    """Ascending distinct lengths and their numbers of rows."""
    found = sorted((r["n_tokens"], r["n"]) for r in lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toLocalIterator())
    return [x for x, _ in found], [n for _, n in found]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, bucket (its boundary), batch, slot, padding: one row per row.

    Tokens are words parted by white space. Batch numbers run from 0 in every bucket; a batch holds budget / boundary rows, and one row if
    that row alone is over the budget. Rows without words go to the smallest bucket. Null keys and texts, and repeated rows, are packed like
    others; an empty table gives an empty result. Other columns are not read.
    """
    lengths = common.stored(docs.select(common.named(key).alias("_key"), common.words(common.named(text)).alias("n_tokens")), "packing-lengths")
    ends = boundaries(*histogram(lengths), buckets)
    if not ends:
        ends = [0]
    bound = F.element_at(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e >= F.col("n_tokens")), 1)
    placed = common.numbered(lengths.withColumn("bucket", bound), ["bucket"], ["_key", "n_tokens"], "_number")
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bucket"), F.lit(1))))
    return placed.select(
        F.col("_key").alias(key), "n_tokens", "bucket", F.floor(F.col("_number") / per_batch).alias("batch"), F.pmod(F.col("_number"), per_batch).alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))


QUERIES = {"op7_packing": op7_packing}
#: The dynamic programme and the order by hash have no SQL form; the query is tested against all choices of boundaries.
ORACLES: dict[str, str] = {}
