"""Class-based bigrams: counts and base scores against a plain loop, the model's sums, and what it gains on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from barloom.llm import brown

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def plain(rows, is_training):
    counts = Counter(t for k, text in rows if is_training(k) for t in tokens_of(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for k, text in rows:
        ts = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in ts)
        out.append((k, len(ts), sum(counts[t] > 0 for t in ts), total, base))
    return out


def test_documents_table(spark, monkeypatch):
    monkeypatch.setattr(brown, "TOP", 3_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in brown.op10_brown(spark, "/root/testdata/sf0.001").collect()}
    want = plain([(r.doc_id, r.text) for r in docs.collect()], lambda k: zlib.crc32(str(k).encode()) % 5 != 1)
    assert len(got) == len(want)
    for k, n, known, total, base in want:
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 1)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_hard_rows(spark):
    rows = [(1, "a b a"), (2, None), (3, ""), (None, "B c"), (4, "É é"), (4, "É é"), (5, "new " * 50_000)]
    docs = spark.createDataFrame([(k, t, 1.0) for k, t in rows], "doc_id long, text string, score double")
    train = docs.where("doc_id < 5")
    got = sorted([(r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in brown.score(docs, train).collect()])
    want = plain(rows, lambda k: k is not None and k < 5)
    assert got == sorted((n, known, total, round(base, 6)) for _, n, known, total, base in want)
    empty = brown.score(docs, train.limit(0)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in empty) and len(empty) == len(rows)
    assert brown.score(docs.limit(0), train).collect() == []


def test_exchange_keeps_its_table_and_gains():
    rng = np.random.default_rng(0)
    # Two languages whose words follow each other.
    counts = np.zeros((41, 41))
    for side in (0, 1):
        at = np.arange(20) * 2 + side
        counts[np.ix_(at, at)] = rng.integers(5, 20, (20, 20))
    counts[40, :40] = counts[:40, 40] = 3
    label = brown.exchange(counts, classes=3, passes=10)
    assert len(set(label[:40:2])) == len(set(label[1:40:2])) == 1 and label[0] != label[1] and label[40] == 2


def test_many_words_choose_as_each_by_itself():
    rng = np.random.default_rng(3)
    c = brown.CLASSES
    table = rng.integers(200, 1_000, (c, c)).astype(float)
    old = rng.integers(0, c - 1, 300)
    after, before = (np.where(rng.random((300, c)) < 0.3, rng.integers(1, 6, (300, c)), 0).astype(float) for _ in range(2))
    own = np.minimum(after[np.arange(300), old], before[np.arange(300), old]) * (rng.random(300) < 0.5)
    got = brown.best_classes(table, old, after, before, own)
    for k in range(300):
        right, left, t = after[k].copy(), before[k].copy(), table.copy()
        right[old[k]] -= own[k]
        left[old[k]] -= own[k]
        brown.move(t, old[k], -right, -left, -own[k])
        assert got[k] == brown.best_class(t, right, left, own[k])


def small_model(spark, monkeypatch, top=1_200):
    """A model with a core, words outside it and a tail, over texts of two kinds."""
    monkeypatch.setattr(brown, "TOP", top)
    rng = np.random.default_rng(4)
    text = lambda k: " ".join(f"{'xy'[k]}{int(x)}" for x in rng.zipf(1.15, 90) if x < 1_500)
    rows = [(k, text(k % 2)) for k in range(400)] + [(500, "x1 x1 x1 x1"), (501, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return rows, docs, brown.fit(docs)[0]


def key_of(word):
    import pyarrow as pa

    return int(next(brown.tokens.words(pa.array([word]))).key.view(np.int64)[0])


def ending_of(word):
    import pyarrow as pa

    return int(brown.endings(next(brown.tokens.words(pa.array([word]))))[0])


def test_score_equals_a_plain_walk(spark, monkeypatch):
    """Every token: class bigrams counted, interpolated and multiplied out in plain Python, from the classes that were learnt."""
    rows, docs, m = small_model(spark, monkeypatch)
    counts = Counter(t for _, text in rows for t in tokens_of(text))
    place = {int(k): n for n, k in enumerate(m.classes.vocabulary.keys)}
    assert len(place) == 1_200 < len(counts) - 1
    tail = Counter()
    for t, n in counts.items():
        if t is not None and key_of(t) not in place:
            tail[ending_of(t)] += n
    kinds = Counter(ending_of(t) for t in counts if t is not None and key_of(t) not in place)
    c = brown.CLASSES

    def label(t):
        if t is None:
            return c - 1
        return int(m.classes.label[place[key_of(t)]]) if key_of(t) in place else int(m.classes.of_ending[ending_of(t)])

    pairs = Counter((label(a), label(b)) for _, text in rows for a, b in zip([None, *tokens_of(text)], tokens_of(text)))
    total = sum(pairs.values())
    after, size = Counter(), Counter()
    for (a, b), n in pairs.items():
        after[a] += n
        size[b] += n
    mass = Counter()
    for t, n in counts.items():
        if t is not None and key_of(t) in place:
            mass[label(t)] += n + 0.5
    for e in range(brown.ENDINGS):
        mass[int(m.classes.of_ending[e])] += tail[e] + 0.5

    def p(last, t):
        a, b = label(last), label(t)
        step = (pairs[a, b] + 16 * (size[b] + 0.5) / (total + 0.5 * c)) / (after[a] + 16)
        if t is None:
            return step
        if key_of(t) in place:
            return step * (counts[t] + 0.5) / mass[b]
        e = ending_of(t)
        return step * (tail[e] + 0.5) / mass[b] * (counts[t] + 0.5) / (tail[e] + 0.5 * (kinds[e] + 1))

    asked = [*rows[:20], (900, "x1 never seen y2"), (901, "")]
    got = {r.doc_id: r.score for r in brown.score(spark.createDataFrame(asked, "doc_id long, text string"), docs).collect()}
    for k, text in asked:
        ts = tokens_of(text)
        assert math.isclose(got[k], sum(math.log10(p(a, b)) for a, b in zip([None, *ts], ts)), rel_tol=1e-9)


def test_probabilities_sum_to_one(spark, monkeypatch):
    _, _, m = small_model(spark, monkeypatch)
    for last in range(brown.CLASSES):
        words = (10 ** (m.transition[last, m.classes.label] + m.word)).sum()
        tail = (10 ** (m.transition[last, m.classes.of_ending] + m.ending)).sum()
        assert math.isclose(words + tail + 10 ** m.transition[last, -1], 1, rel_tol=1e-9)


def test_words_outside_the_core_find_their_class(spark, monkeypatch):
    """Two languages that never mix: the distributed pass parts their rarer words as the exchange parts the frequent ones."""
    _, _, m = small_model(spark, monkeypatch, top=10_000)
    sides = {"x": Counter(), "y": Counter()}
    for n in range(1, 1_500):
        for side in sides:
            at, known = m.classes.vocabulary.find(np.array([key_of(f"{side}{n}")]))
            if known[0] and m.classes.vocabulary.unit[at[0]] < 0:
                sides[side][int(m.classes.label[at[0]])] += 1
    shared, all_of_them = sum((sides["x"] & sides["y"]).values()), sum(sum(s.values()) for s in sides.values())
    assert min(sum(s.values()) for s in sides.values()) > 50 and shared < 0.05 * all_of_them
