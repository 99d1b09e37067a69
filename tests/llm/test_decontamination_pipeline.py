"""Decontamination against a comparison of all texts with all items, and the pipeline stage by stage."""

import random
import re

import corpus_pipeline
import numpy as np
from barloom.llm import decontamination, packing
from test_shingles import plain_pairs
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def verbatim(docs, items):
    """Pairs of a text and an item whose words it contains in a row."""
    by_start = {}
    for i, t in items:
        w = words_of(t)
        by_start.setdefault(tuple(w[:4]), []).append((i, w))
    out = set()
    for k, t in docs:
        w = words_of(t)
        for p in range(len(w) - 3):
            for i, item in by_start.get(tuple(w[p : p + 4]), ()):
                if w[p : p + len(item)] == item:
                    out.add((k, i))
    return out


def test_documents_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = decontamination.op6_decontamination(spark, SF).collect()
    want = verbatim(docs, items)
    assert want and {(r.doc_id, r.item_id) for r in got} == want


def test_paraphrases_and_hard_rows(spark, monkeypatch):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).select("doc_id", "text")
    base = [r.text for r in docs.collect() if len(r.text.split()) > 150][:20]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r.text.split()) >= 25][:15]
    rows, want = [], set()
    for n, (i, t) in enumerate(items):
        w = t.split()
        for k in rng.sample(range(len(w)), len(w) // 12):
            w[k] = "changed"
        host = base[n].split()
        rows.append((10_000 + n, re.sub("[a-z]", lambda m: m[0].upper(), " ".join([*host[:70], *w, *host[70:]]))))
        want.add((10_000 + n, i))
    rows += [(1, ""), (2, None), (None, items[0][1]), (3, items[0][1]), (3, items[0][1]), (4, "the " * 100_000), (5, "one")]
    some = spark.createDataFrame([(k, t, 0.0) for k, t in rows], "doc_id long, text string, cosine double")
    benchmark = spark.createDataFrame([*items, (900, ""), (901, None), (None, "null id " * 20), (902, "!?")], "item_id long, text string")
    fitted = decontamination.fit(docs.union(some.select("doc_id", "text")), benchmark)
    got = [(r.doc_id, r.item_id) for r in decontamination.leaks(some, fitted).collect()]
    assert want <= set(got)
    assert sorted(got, key=str) == sorted([*want, (None, items[0][0]), (3, items[0][0]), (3, items[0][0])], key=str)
    kept = decontamination.clean(some, fitted).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 4, 5] and kept[0].cosine == 0.0
    # A benchmark over the size of a pass is searched in several, with the same result.
    monkeypatch.setattr(decontamination, "PASS_ITEMS", 5)
    parted = decontamination.fit(docs.union(some.select("doc_id", "text")), benchmark.union(benchmark))
    assert parted.passes > 2 and max(len(parted.items(k).ids) for k in range(parted.passes)) < len(items)
    assert sorted(((r.doc_id, r.item_id) for r in decontamination.leaks(some, parted).collect()), key=str) == sorted(got, key=str)
    assert sorted(r.doc_id for r in decontamination.clean(some, parted).collect()) == [1, 2, 4, 5]
    nothing = decontamination.fit(docs.limit(0), benchmark.limit(0))
    assert decontamination.leaks(some, nothing).collect() == []


def test_stray_matches_do_not_hide_a_passage():
    words = [f"w{k}" for k in range(20)]
    import pyarrow as pa

    items = decontamination.Items([1], pa.array([" ".join(words)]), np.ones(decontamination.TERMS), np.eye(decontamination.TERMS, 4))
    keys = items.keys[0]
    strange = list(range(1, 60))
    assert items.check(0, [*strange, *keys, *strange]) == 1.0
    assert items.check(0, [keys[0], *strange, 7, *keys[1:], *strange]) == 0.95
    assert items.check(0, [x for k in keys for x in (k, *strange[:3])]) == 0.0
    assert items.check(0, [*strange, *keys[:10], *strange]) == 0.0


def test_longest_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = ([int(x) for x in rng.integers(0, 5, rng.integers(1, 12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        length, first, last = decontamination.lcs_ends(a, b)
        assert length == table[-1, -1]
        if length:
            assert decontamination.lcs_ends(a, b[first : last + 1])[0] == length


def plain_groups(rows):
    """The smallest id of every group that fingerprints, or five-word shingle sets of a similarity of at least 0.8, connect."""
    root = dict(plain_components([(k, plain_fingerprint(t)) for k, t in rows]))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in plain_pairs(rows):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {find(k) for k, _ in rows}


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.common.stored(stage(spark, before, SF), f"test-{name}")
        kept = {r.doc_id for r in after.collect()}
        came = [(r.doc_id, r.text) for r in before.collect()]
        assert kept <= {k for k, _ in came} and kept
        if name != "packing":
            assert after.columns == docs.columns
        gone = {k for k, _ in came} - kept
        if name == "toxicity":
            assert np.mean([labels[k].toxic for k in gone if k in labels] or [1]) > 0.9
        elif name == "quality":
            assert np.mean([labels[k].quality == 0 for k in gone if k in labels] or [1]) > 0.9
        elif name == "near_duplicates":
            assert kept == plain_groups(came)
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert gone == {k for k, _ in verbatim(came, items)}
        else:
            assert kept == {k for k, _ in came} and len({r.bucket for r in after.collect()}) <= packing.BUCKETS
        before = after


def test_pipeline_hard_rows(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "en", "s", 0), (3, "same words here", "en", "s", 15), (3, "same words here", "en", "s", 15), (4, "same words here", "en", "s", 15), (5, "x " * 50_000, "en", "s", 1)]
    for some in (rows, []):
        sf = str(tmp_path / str(len(some)))
        spark.createDataFrame(some, columns).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(2, 1, 0), (3, 1, 0), (5, None, None)] if some else [], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, "an item of some words")] if some else [], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        got = corpus_pipeline.run(spark, sf).collect()
        assert len(got) <= len(some)
        assert all(r.doc_id in (None, 1, 2, 3, 5) for r in got)


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    names = ["_toxicity", "_quality", "_text", "score", "h", "t", "y", "k", "fp", "component_id", "item_id", "toxic", "quality", "_n", "bucket", "a.b", "c`d", "c0"]
    for n in names:
        docs = docs.withColumn(n, corpus_pipeline.F.lit(f"own {n}"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        assert all(r[n] == f"own {n}" for r in after.collect() for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 200
