"""Boundaries against all choices, and batches on hard rows."""

import itertools
import random
import re

from barloom.llm import packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def padding(lengths, rows, ends):
    return sum(r * (min(e for e in ends if e >= x) - x) for x, r in zip(lengths, rows))


def test_boundaries_against_all_choices():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 9)
        lengths = sorted(rng.sample(range(0, 60), n))
        rows = [rng.choice([1, 1, 2, 5, 100]) for _ in lengths]
        k = rng.randint(1, 5)
        got = packing.boundaries(lengths, rows, k)
        assert len(got) <= k and got[-1] == lengths[-1]
        least = min(padding(lengths, rows, [*c, lengths[-1]]) for m in range(k) for c in itertools.combinations(lengths[:-1], m))
        assert padding(lengths, rows, got) == least
    assert packing.boundaries([], [], 3) == []


def check(rows, got, buckets, budget):
    assert sorted(WORD.findall(t or "").__len__() for _, t in rows) == sorted(r.n_tokens for r in got)
    assert len({r.bucket for r in got}) <= buckets
    places = [(r.bucket, r.batch, r.slot) for r in got]
    assert len(set(places)) == len(places)
    for bucket in {r.bucket for r in got}:
        own = [r for r in got if r.bucket == bucket]
        per = max(1, budget // max(bucket, 1))
        assert sorted(r.batch * per + r.slot for r in own) == list(range(len(own)))
        assert all(r.n_tokens <= bucket and r.padding == bucket - r.n_tokens for r in own)


def test_hard_rows(spark):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "x"), (None, "x"), (4, "a b"), (4, "a b"), (5, "w " * 5_000), (6, " \t ")]
    docs = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, bucket int")
    check(rows, packing.pack(docs, 3, 4).collect(), 3, 4)
    assert packing.pack(docs.limit(0), 3, 4).collect() == []


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.op7_packing(spark, "/root/testdata/sf0.01").collect()
    check(rows, got, packing.BUCKETS, packing.BUDGET)
    assert sorted(r.doc_id for r in got) == sorted(k for k, _ in rows)
