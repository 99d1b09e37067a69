"""Exact copies against SQL and a plain loop."""

import hashlib
import random
import re

import pytest
from barloom.llm import contentsort
from oracle import compare, connect


def plain(rows):
    norm = [(k, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for k, t in rows]
    groups = {}
    for k, t in norm:
        groups.setdefault(t, []).append(k)
    out = []
    for k, t in norm:
        ids = [x for x in groups[t] if x is not None]
        out.append((k, min(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out, len(groups)


def got(df):
    return [(r.doc_id, r.keep, r.group_size, bytes(r.digest).hex()) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), sf, contentsort.op11_content_sort, contentsort.ORACLES["op11_content_sort"]) == []


@pytest.mark.parametrize("seed", [0, 1])
def test_hot_groups_span_ranges(spark, seed):
    """Groups of a third of all rows, texts that share a long beginning, repeated and null keys, over many ranges."""
    r = random.Random(seed)
    base = "same beginning " * 20
    texts = [base + "x", base + "  x", base + "x" * 5, "", None, " ", "\t\n", "a b", "a\x0b b", "a b", "é" * 70, "\U0001f600 z"]
    rows = [(r.choice([None, *range(300)]), r.choice(texts + [base + "x"] * 8 + [str(r.random())] * 4)) for _ in range(3000)]
    docs = spark.createDataFrame([(k, t, 1, "n") for k, t in rows], "doc_id long, text string, part int, `first.n` string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = contentsort.copies(docs).cache()
        want, n_groups = plain(rows)
        assert ordered(got(found)) == ordered(want)
        kept = found.where("kept").collect()
        assert len(kept) == len({bytes(k.digest) for k in kept}) == n_groups
        assert all(k.doc_id == k.keep for k in kept)
        left = contentsort.without_copies(docs)
        assert left.columns == docs.columns
        assert sorted((x.doc_id is None, x.doc_id or 0) for x in left.collect()) == sorted((k.doc_id is None, k.doc_id or 0) for k in kept)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_whole_texts_are_compared(spark):
    long = "w " * 400_000
    rows = [(3, long + "a"), (2, long + "b"), (1, long + "a"), (0, long)]
    found = contentsort.copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.keep) for r in found.collect()) == [(0, 0), (1, 1), (2, 2), (3, 1)]


def test_other_keys_names_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "y")], "`a.b` string, `text` string")
    assert sorted((r["a.b"] or "", r.keep or "", r.kept) for r in contentsort.copies(docs, "a.b").collect()) == [("", "", True), ("a", "a", True), ("b", "a", False)]
    assert contentsort.copies(docs.limit(0), "a.b").collect() == []
    assert contentsort.without_copies(docs.where("false"), "a.b").collect() == []


def test_splitters_hold_no_texts(spark):
    """What the range exchange samples to the driver are short columns."""
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = contentsort.in_order(docs, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    splitters = plan.split("RepartitionByExpression [")[1].split("]")[0]
    assert [x.split("#")[0] for x in splitters.split(", ")][:4] == ["head", "mark", "last", "k"]
