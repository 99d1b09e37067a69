"""Runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from barloom.llm import periodic


def plain_runs(w, least=24, times=3):
    """Every maximal stretch of every period, without those that have a smaller period."""
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if length >= max(least, times * q) and not any(all(w[x] == w[x - r] for x in range(s + r, s + length)) for r in range(1, q)):
                out.append((s, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(k, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if k is None else str(k)).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def sequence(r):
    """Words with runs in runs, runs that overlap, powers of powers."""
    kind, n = r.randrange(5), r.randrange(0, 160)
    if kind == 0:
        return [r.choice("ab") for _ in range(n)]
    if kind == 1:
        block = [r.choice("abc") for _ in range(r.randrange(1, 12))]
        return [*[r.choice("abc") for _ in range(r.randrange(9))], *(block * r.randrange(1, 14))[:n], *[r.choice("abc") for _ in range(r.randrange(9))]]
    if kind == 2:
        block = (["x"] * r.randrange(1, 40) + ["y"]) * r.randrange(1, 5)
        return (block * 4)[: r.randrange(len(block) * 4 + 1)] + ["x"] * r.randrange(40)
    if kind == 3:
        a, b = ["a", "b", "a", "a", "b"], ["a", "b", "a"]
        for _ in range(r.randrange(5)):
            a, b = a + b, a
        return (a * 5)[:250]
    return [chr(97 + int(x)) for x in np.random.default_rng(r.randrange(10**6)).geometric(0.5, n)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_a_plain_search(seed):
    r = random.Random(seed)
    for _ in range(120):
        w = sequence(r)
        least = r.choice([1, 6, 24])
        ids = np.array([hash(x) % 100_003 for x in w], np.int64)
        assert list(zip(*(x.tolist() for x in periodic.runs(ids, len(w), least)))) == plain_runs(w, least), (least, w)


def test_texts_in_a_row_do_not_touch():
    """The end of one text and the beginning of the next never make a run together."""
    found = list(periodic.searched(pa.array(["a b " * 6, "a b " * 6, None, "", "a b " * 12])))
    lists = [x for _, _, columns in found for x in columns[1].to_pylist()]
    assert [len(x) for x in lists] == [0, 0, 0, 0, 1] and lists[4][0] == {"start": 0, "length": 24, "period": 2}


def test_hard_rows(spark):
    r = random.Random(5)
    rows = [(k, " ".join(sequence(r))) for k in range(60)]
    rows += [(None, "x y " * 40), (61, None), (62, ""), (63, " \n\t"), (64, "é\x0bz " * 30), (65, "w " * 100_000), (66, "A a " * 50), (60, "p"), (60, "p")]
    docs = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "`d.id` long, text string, runs int, `k` string").repartition(5)
    got = periodic.collapse(docs, "d.id")
    assert got.columns == ["d.id", "n_words", "runs", "strongest", "collapsed"]

    def want(k, t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = plain_runs(w) if len(w) < 1_000 else [(0, 100_000, 1)]
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        return repr((k, len(w), found, best, plain_collapsed(w, found)))

    have = [repr((x[0], x.n_words, [tuple(y) for y in x.runs], x.strongest and tuple(x.strongest), x.collapsed)) for x in got.collect()]
    assert sorted(have) == sorted(want(k, t) for k, t in rows)
    assert periodic.collapse(docs.where("false"), "d.id").collect() == []


def test_query_equals_plain(spark):
    """The whole query over the smallest tables; a plain search looks at every lag of every text of up to 400 words."""
    sf = "/root/testdata/sf0.001"
    got = {x.doc_id: x for x in periodic.op13_periodic_runs(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    n = 0
    for k, t in rows:
        w = planted(k, t)
        if len(w) > 400:
            continue
        found = plain_runs(w)
        x, best = got[k], max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        n += bool(found)
        assert x.n_runs == len(found)
        assert (x.start, x.length, x.period) == (best or (None, None, None))
        assert x.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert x.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(plain_collapsed(w, found).encode()).hexdigest()
    assert n > 3


def test_planting(spark):
    rows = [(k, f"a{k} b c d e f g h i j k l m" * (k % 4)) for k in range(200)] + [(None, "x y z"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(repr((x.doc_id, (x.text or "").split())) for x in periodic.with_planted_runs(docs).collect())
    assert got == sorted(repr((k, planted(k, t))) for k, t in rows)
