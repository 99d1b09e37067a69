"""The latent space of decontamination is fitted on all documents; its passes against plain loops."""

import random

import numpy as np
import pyarrow as pa
from barloom.llm import decontamination as d


def plain_windows(texts):
    """The terms of every passage of every distinct text, one by one."""
    out = []
    for t in dict.fromkeys(texts):
        for w in d.tokens.words(pa.array([t], pa.string()), d._NOT_WORD):
            term = d.terms(w.key).tolist()
            out += [term[k : k + d.WINDOW] for k in range(0, len(term), d.STEP)]
    return out


def some_texts():
    rng = random.Random(7)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.02)), 900)}" for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 15, 16, 17, 33, 400, 64, 3_000)]
    return [*texts, texts[9], texts[9], None, "", "the " * 5_000, "A a! a", "a a a"]


def test_passes_against_plain_loops(spark, monkeypatch):
    texts = some_texts()
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for words, tile in ((d.WORDS, d.TILE), (40, 8)):
        monkeypatch.setattr(d, "WORDS", words)
        monkeypatch.setattr(d, "TILE", tile)
        coded = d.coded(docs, "text")
        assert coded.count() == len(set(texts))
        frequency, total = d.document_frequency(coded)
        want = np.zeros(d.TERMS, np.int64)
        for t in texts:
            for w in d.tokens.words(pa.array([t], pa.string()), d._NOT_WORD):
                want[np.unique(d.terms(w.key))] += 1
        assert total == len(texts) and (frequency == want).all()
        idf, thin = np.random.default_rng(1).random(d.TERMS), np.random.default_rng(2).normal(size=(d.TERMS, 5))
        product = np.zeros((d.TERMS, 5))
        for terms in plain_windows(texts):
            np.add.at(product, terms, idf[terms, None] * (idf[terms, None] * thin[terms]).sum(0))
        got = d.range_pass(coded, idf, thin)
        assert np.abs(got - product).max() < 1e-5 * np.abs(product).max()


def test_sums_of_rows_by_key():
    rng = np.random.default_rng(3)
    for sizes in ([1], [1, 1, 5], [32, 33, 1, 64, 65], [5_000, 1, 31, 2_000]):
        key = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
        rows, at = rng.integers(-9, 9, (700, 3)).astype(np.float32), rng.integers(0, 700, len(key))
        some, sums = d._summed(rows, at, key)
        assert sorted(some.tolist()) == list(range(len(sizes)))
        for k, s in zip(some.tolist(), sums):
            assert (s == rows[at[key == k]].sum(0)).all()


def test_windows_of_texts_in_tiles(monkeypatch):
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(400)]
    items = pa.array([" ".join(rng.sample(pool, n)) for n in (40, 25, 14, 9, 3)])
    texts = pa.array([" ".join([*rng.choices(pool, k=m), *items[k % 5].as_py().split(), *rng.choices(pool, k=m)]) for k, m in enumerate((0, 5, 80, 81, 700, 3, 160, 18, 0, 400))] + [None, ""])
    items = d.Items(list(range(5)), items, np.ones(d.TERMS), np.random.default_rng(4).normal(size=(d.TERMS, 32)))
    assert len(items.windows) == 4
    found = []
    for tile in (4_096, 8):
        monkeypatch.setattr(d, "TILE", tile)
        found.append(sorted(items.find(texts)))
    assert {x[:2] for x in found[0]} >= {(k, k % 5) for k in range(10)}
    assert np.abs(np.array(found[0]) - np.array(found[1])).max() < 1e-6


def test_every_place_of_an_item_in_a_text(monkeypatch):
    """An item is found word for word at every place, also if one of its words outweighs all others."""
    for length in (20, 21, 31, 47, 64, 65, 130):
        places = d.long_windows(length)
        assert {x % d.STEP for x in places} == set(range(d.STEP)) and min(places) == 0 and max(places) <= length - d.WINDOW
        assert np.diff(places).max() <= d.WINDOW + d.STEP
        words = [f"w{k}" for k in range(length)]
        for heavy in (0, 15, 16, length - 1):
            idf = np.ones(d.TERMS)
            keys = next(d.tokens.words(pa.array([" ".join(words)]), d._NOT_WORD)).key
            idf[d.terms(keys[heavy : heavy + 1])] = 50
            items = d.Items([1], pa.array([" ".join(words)]), idf, np.random.default_rng(5).normal(size=(d.TERMS, 48)))
            texts = pa.array([" ".join([f"x{k}" for k in range(m)] + words + ["y"] * 30) for m in range(24)])
            assert [x[:3] for x in items.find(texts)] == [(m, 0, 1.0) for m in range(24)]


def test_texts_of_words():
    rng = np.random.default_rng(6)
    for _ in range(50):
        data = rng.choice(np.frombuffer(b"ab  .", np.uint8), 60)
        offsets = np.concatenate(([0], np.sort(rng.integers(0, 61, 8)), [60]))
        start, _, text = d.tokens.spans(data, offsets)
        assert text.tolist() == (np.searchsorted(offsets, start, "right") - 1).tolist()


def test_fitted_on_all_documents(spark):
    """Over 20,000 documents that share no word: the terms of every one have their part in the latent space, and no others."""
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('x', id, ' y', id) AS text")
    fitted = d.fit(docs, spark.createDataFrame([(1, "an item")], "item_id long, text string"))
    used = np.zeros(d.TERMS, bool)
    for w in d.tokens.words(pa.array([f"x{k} y{k}" for k in range(24_000)]), d._NOT_WORD):
        used[d.terms(w.key)] = True
    size = np.abs(fitted.basis).max(1)
    assert 0 < (~used).sum() and ((size > 1e-9 * size.max()) == used).all()


def test_pipeline_leaves_no_text_out_of_a_fit(spark, tmp_path, monkeypatch):
    """Over 20,000 documents: decontamination is fitted on every text that reaches it, classifiers on every labelled row."""
    import corpus_pipeline
    from barloom.llm import common

    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('x', id, ' y', id) AS text")
    spark.createDataFrame([(1, "an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    fitted, range_pass = [], d.range_pass
    monkeypatch.setattr(d, "range_pass", lambda texts, *rest: fitted.append(texts.agg({"n": "sum"}).first()[0]) or range_pass(texts, *rest))
    assert corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).count() == 24_000
    assert fitted == [24_000, 24_000] and not hasattr(common, "sampled")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality")
    assert common.fitting_rows(docs, labels, "quality", "doc_id", "text").count() == 24_000
