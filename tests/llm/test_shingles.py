"""Similar shingle sets against a comparison of all pairs."""

import random

import corpus_pipeline
from barloom.llm import shingles

SF = "/root/testdata/sf0.01"


def plain_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain_pairs(rows):
    """Pairs of ids whose sets have a similarity of 0.8 or more."""
    sets = [(k, plain_set(t)) for k, t in rows]
    by_shingle = {}
    for n, (_, s) in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(n)
    near = {(a, b) for ns in by_shingle.values() for a in ns for b in ns if a < b}
    return {(sets[a][0], sets[b][0]) for a, b in near if len(sets[a][1] & sets[b][1]) >= 0.8 * len(sets[a][1] | sets[b][1])}


def near_copies():
    rng = random.Random(6)
    rows = []
    for n in range(60):
        w = [f"w{rng.randrange(5_000)}" for _ in range(rng.randint(60, 400))]
        rows.append((10 * n, " ".join(w)))
        for k in range(1, 4):  # single words changed: similarity around 0.8
            other = list(w)
            for at in rng.sample(range(len(w)), max(1, len(w) * k // 100)):
                other[at] = "new"
            rows.append((10 * n + k, " ".join(other)))
    return rows


def test_stage_leaves_no_similar_pair(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_pairs(rows)
    assert len(want) > 60
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()}
    assert not [p for p in want if p[0] in kept and p[1] in kept]
    assert {10 * n for n in range(60)} <= kept


def test_pairs_are_those_of_all_pairs(spark):
    rows = [*near_copies(), (900, "one two"), (901, "One  two"), (902, ""), (903, None), (904, "a b c d e f"), (905, "a b c d e g")]
    texts = spark.createDataFrame(rows, "x long, t string")
    assert {(r.a, r.b) for r in shingles.alike(texts).collect()} == plain_pairs(rows)
    assert shingles.alike(texts.limit(0)).collect() == []


def families(n, sizes, changed):
    """Families of copies of a base with some words changed: most members are alike through the base or each other only."""
    rng = random.Random(n)
    rows = []
    for f, size in enumerate(sizes):
        base = [f"f{f}w{rng.randrange(5_000)}" for _ in range(400)]
        for m in range(size):
            other = list(base)
            for at in rng.sample(range(400), changed if m else 0):
                other[at] = f"new{rng.randrange(10**6)}"
            rows.append((1_000 * f + m, " ".join(other)))
    return rows


def groups_of(ids, pairs):
    root = {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in ids}


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Buckets of many blocks against the components of all pairs: star families, and texts that no pair connects."""
    monkeypatch.setattr(shingles, "BLOCK", 20)
    rows = families(1, [120, 90, 40, 3], 6) + [(9_000 + k, t) for k, (_, t) in enumerate(families(2, [60], 14))]
    found = {(r.a, r.b) for r in shingles.alike(spark.createDataFrame(rows, "x long, t string")).collect()}
    want = plain_pairs(rows)
    assert found <= want
    assert groups_of([k for k, _ in rows], found) == groups_of([k for k, _ in rows], want)


def test_star_families_leave_one_row_each(spark):
    rows = families(3, [500, 300, 20], 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF).collect())
    assert kept == [0, 1_000, 2_000]


def test_stage_keeps_one_row_of_each_group(spark):
    long = " ".join(f"w{k}" for k in range(100))
    own = ["one whole text of its own " * 3, "another text that has nothing shared " * 3]
    rows = [(1, own[0]), (2, own[0]), (2, own[1]), (1, own[1]), (1, own[1]), (None, own[0]), (None, long), (None, long), (None, long + " more"), (3, None), (None, "")]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n int")
    kept = corpus_pipeline.one_of_each(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.doc_id) == sorted([("1", own[0]), ("1", own[1]), ("3", None)], key=str)
    assert len([r for r in kept if r.doc_id is None]) == 1 and all(r.text.startswith(long) for r in kept if r.doc_id is None)
