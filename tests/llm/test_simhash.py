"""Near-duplicates against a plain loop over all pairs, threshold allocation, and dense groups."""

import re

import numpy as np
import pytest
import xxhash
from barloom.llm import simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    """rows: (id, fingerprint); id to the smallest id that is not null."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    at = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(at[i + 1 :] ^ at[i]) <= 3):
            root[find(fps[i + 1 + j])] = find(f)
    least = {}
    for k, f in rows:
        if k is not None:
            least[find(f)] = min(k, least.get(find(f), k))
    return sorted(((-1 if k is None else k, least.get(find(f))) for k, f in rows), key=str)


def as_rows(found):
    return [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in found.collect()]


def test_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.op8_simhash(spark, "/root/testdata/sf0.01").collect()}
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    assert {k: f for k, f in rows} == {k: v[0] for k, v in got.items()}
    assert plain_components(rows) == sorted(((k, v[1]) for k, v in got.items()), key=str)


def test_hard_rows(spark):
    rows = [(1, "", "x"), (2, None, "x"), (3, " \t\n", "x"), (4, "a", "x"), (4, "a", "x"), (5, "A  B", "x"), (6, "a b", "x"), (None, "a b", "x"),
            (7, "é É", "x"), (8, "w " * 100_000, "x"), (9, "W x " * 3, "x"), (None, "only here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = as_rows(simhash.near_duplicates(docs))
    want = [(k, plain_fingerprint(t)) for k, t, _ in rows]
    assert sorted((k or -1, f) for k, f, _ in got) == sorted((k or -1, f) for k, f in want)
    assert sorted(((-1 if k is None else k, c) for k, _, c in got), key=str) == sorted(plain_components(want), key=str)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("skew", [0.5, 0.03])
def test_links_connect_like_all_pairs(spark, skew, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 256)
    rng = np.random.default_rng(3)
    base = [sum(1 << b for b in range(64) if rng.random() < skew) for _ in range(300)]
    dense = [base[0] ^ sum(1 << int(b) for b in rng.choice(20, 4, replace=False)) for _ in range(1500)]
    near = [f ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 6)), replace=False)) for f in base]
    fps = sorted({*base, *dense, *near})
    classes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    roots = {r.node % (1 << 64): r.root for r in simhash.components(simhash.links(classes), "test").collect()}
    mine = {}
    for f in fps:
        mine.setdefault(roots.get(f, ("own", f)), set()).add(f)
    want = {}
    for k, root in plain_components(list(enumerate(fps))):
        want.setdefault(root, set()).add(fps[k])
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_thresholds_cover_the_radius():
    rng = np.random.default_rng(1)
    parts = np.arange(64).reshape(4, 16)
    counts = rng.integers(0, 50, (4, 1 << 16))
    values = rng.integers(0, 1 << 16, (200, 4))
    got = simhash.allocate(values, simhash.estimates(counts))
    assert (got.sum(1) == 0).all() and (got >= -1).all()
    assert simhash.values_of(np.array([0xFFFF << 16], np.uint64), parts).tolist() == [[0, 0xFFFF, 0, 0]]
