"""Exact search against SQL and a plain loop; shards against the published loop."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from barloom.llm import common, sharding, topk
from oracle import compare, connect
from pyspark.sql import functions as F


def test_topk_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAF_ROWS", 16)
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), sf, topk.op1_topk, topk.ORACLES["op1_topk"]) == []


def test_topk_hard_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 1.0, 1.0]) for i in range(300)] + [(7, [0.5, -0.5, 2.0])]
    bad = [(None, [1.0, 1.0, 1.0]), (2000, None), (2001, [1.0, None, 1.0]), (2002, [math.nan, 0.0, 0.0]), (2003, [math.inf, 0.0, 0.0]), (2004, []), (2005, [1.0, 2.0])]
    vectors = spark.createDataFrame([(k, v, 1) for k, v in rows + bad], "vec_id long, embedding array<double>, score int")
    queries = vectors.where("vec_id % 50 = 0 or vec_id = 7 or vec_id = 2005 or vec_id is null").repartition(3)
    got = defaultdict(list)
    for r in topk.top_k(vectors, queries, k=10, shard_rows=64).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ints = [(k, [math.floor(1024 * x) for x in v]) for k, v in rows]
    asked = {(k, tuple(v)) for k, v in ints if k % 50 == 0 or k == 7}
    for k in {k for k, _ in asked}:
        if sum(1 for a in asked if a[0] == k) > 1:
            continue
        q = next(v for a, v in asked if a == k)
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ints if i != k)[:10]
        assert sorted(got[k]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert 2005 not in got
    assert topk.top_k(vectors.limit(0), queries).collect() == []


def jump(key, n):
    key, b, j = key % (1 << 64), -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards(spark):
    rows = [(i, f"t{i % 5}") for i in range(3000)] + [(5, "same")] * 500 + [(None, None), (-7, ""), ((1 << 62) + 3, "é"), (-(1 << 63), "x")]
    docs = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, slot int").repartition(5)
    for n in (1, 8):
        got = sharding.shard(docs, n, per_block=200).collect()
        slots = defaultdict(list)
        for r in got:
            key = r.doc_id or 0
            assert r.shard == jump(key, n) and r.grown_shard == jump(key, n + 1) and r.grown_shard in (r.shard, n) and r.law == "key"
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        want = sorted((k or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
        assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    assert sharding.shard(docs.limit(0), 8).collect() == []
    plan = sharding.shard(docs, 8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hot_keys_and_copies_are_dealt_over_blocks(spark):
    """Half of all keys null with different texts, one key reused, and one row repeated: no block of a group holds more than its share."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 10 == 1, 77).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 4 == 0, 5).otherwise(F.col("id")).alias("v"), F.lit("g").alias("g"),
    )
    got = common.numbered(rows, ["g"], ["k", "v"], "n", per_block=1_000)
    assert sorted(r.n for r in got.collect()) == list(range(20_000))
    want = Counter((r.k, r.v) for r in rows.collect())
    assert Counter((r.k, r.v) for r in got.collect()) == want
    # Where a row's number lies says which block it is in: the copies of the repeated row and of the null key are in many places.
    copies = sorted(r.n for r in got.where("k is null and v = 5").collect())
    assert len(copies) == 5_000 and max(b - a for a, b in zip(copies, copies[1:])) > 1
    assert sum(b - a > 1 for a, b in zip(copies, copies[1:])) >= 2
