"""The audit against SQL and a plain loop."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from barloom.llm import divergence
from oracle import compare, connect


def plain(rows, least=10, top=10):
    docs = [(lang or "", s or "", [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for lang, s, t in rows]
    held = defaultdict(Counter)
    for lang, _, w in docs:
        held[lang].update(set(w))
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted((t for t, n in held[lang].items() if n >= least), key=lambda t: t.encode())
        count = {s: Counter() for la, s, _ in docs if la == lang}
        for la, s, w in docs:
            if la == lang:
                count[s].update(x for x in w if held[lang][x] >= least)
        whole = sum(count.values(), Counter())

        def share(c):
            total = sum(c.values()) + 2 * len(kept)
            return [1 + 10**9 * (c[t] + 2) // total for t in kept]

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        d = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = sorted(((-sum(map(d, p[s], p[o])), o.encode()) for o in count if o != s))
            out += [(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(pairs)]
            terms = sorted((-d(a, b), t.encode()) for t, a, b in zip(kept, p[s], q) if count[s][t] and a > b)
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(terms[:top])]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), sf, divergence.op12_source_divergence, divergence.ORACLES["op12_source_divergence"]) == []


@pytest.mark.parametrize(("columns", "rows", "least", "top"), [(512, 64, 10, 10), (7, 3, 2, 4), (3, 1, 1, 2)])
def test_blocks_and_hard_rows(spark, columns, rows, least, top):
    """Many sources over several row blocks, ties, null and empty values, a hot source, a language without terms, names that clash."""
    r = random.Random(columns)
    words = ["Alpha", "beta", "ÉTÉ", "été", "naïve", "日本", "x", "\U0001f600", "a1b", *(f"w{chr(97 + k)}" for k in range(26))]
    data = []
    for k in range(900):
        lang = r.choice(["en", "en", "en", "en", None, "", "de"])
        source = "hot" if k % 3 == 0 else r.choice([None, "", *(f"s{x}" for x in range(9)), "ß"])
        text = r.choice([None, "", " .,1 ", " ".join(r.choice(words[: 3 + len(source or "") * 9]) for _ in range(r.randrange(12)))])
        data.append((lang, source, text))
    data += [("rare", "a", "one"), ("rare", "b", None), ("alone", "a", "one one"), ("en", "s0", "long " * 50_000)] + [("en", "s1", "same row")] * 30
    docs = spark.createDataFrame([(*x, 1, "z") for x in data], "lang string, source string, text string, term int, `part.x` string").repartition(5)
    assert got(divergence.audit(docs, least=least, top=top, columns=columns, rows=rows)) == plain(data, least, top)
    assert divergence.audit(docs.where("false")).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_traversal_equals_a_dense_sum(seed):
    rng = np.random.default_rng(seed)
    n, m = int(rng.integers(2, 40)), int(rng.integers(1, 130))
    cell = rng.random((n, m)) < rng.choice([0.01, 0.1, 0.9])
    row, column = np.nonzero(cell)
    zero = rng.integers(1, 10**6, n)
    p = np.repeat(zero[:, None], m, 1)
    share = rng.integers(1, 10**9 + 1, len(row))
    p[row, column] = share
    dense = np.array([[divergence.distance(p[a], p[b]).sum() for b in range(n)] for a in range(n)])
    above = np.triu_indices(n, 1)
    assert (divergence.between(row, column, share, zero, m)[above] == dense[above]).all()
    split = int(rng.integers(1, n))
    across = np.ix_(np.arange(split), np.arange(split, n))
    assert (divergence.between(row, column, share, zero, m, split)[across] == dense[across]).all()


def test_empty_quadrants_are_counted_not_visited(monkeypatch):
    """Pairs of sparse rows: the cells that are compared one by one are those that have a count in one of the rows."""
    seen = []
    real = divergence.distance
    monkeypatch.setattr(divergence, "distance", lambda p, q: (seen.append(np.size(p)), real(p, q))[1])
    divergence.between(np.array([0, 5]), np.array([3, 700]), np.array([5, 9]), np.full(16, 2), 1_000)
    assert seen[0] == 15 * 2


def test_shares_are_exact_for_large_counts():
    count = np.array([0, 1, 8 * 10**11, 10**15])
    whole = np.array([7, 10**13, 10**13, 10**15])
    terms = np.array([3, 10**7, 10**7, 5])
    want = [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in zip(count.tolist(), whole.tolist(), terms.tolist())]
    assert divergence.shares(count, whole, terms).tolist() == want
