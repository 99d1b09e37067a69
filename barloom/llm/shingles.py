"""Pairs of texts whose sets of word shingles are alike, by MinHash bands and exact verification.

1. Every text gets BANDS keys of ROWS minima each over its shingle hashes (shingles of ``SHINGLE`` words, A-Z in lower case). Two texts of
   similarity s share some key with probability 1 - (1 - s^ROWS)^BANDS: 0.9998 at 0.8.
2. Texts that share a key are candidates. Pairs of buckets of at most ``SMALL`` texts are listed, each once, whatever buckets it shares.
3. A larger bucket is dealt in blocks of about ``BLOCK`` texts, and every pair of blocks goes to one task. The task holds sketches (one byte of
   each minimum) and takes its pairs from the most alike sketches down; pairs that earlier ones connect already are passed over. It
   returns a forest: links that connect what all similar pairs of the two blocks connect, never all pairs.
4. Every link is verified by the exact Jaccard similarity of the shingle sets.

A pair is looked at unless its sketches agree in fewer than ``AGREE`` of 64 places; at a similarity of 0.8 that has a probability below
10^-6. No bucket is cut. Texts are told apart by a 64-bit hash, so copies count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 4
#: Texts of a bucket whose pairs are listed; texts in one block of a larger one; places of 64 in which similar texts agree at least.
SMALL, BLOCK, AGREE = 16, 512, 32
_random = np.random.default_rng(11)
_FACTOR = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def hashes(w: tokens.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle, in order; a text of fewer words is one shingle."""
    per_text = np.bincount(w.text, minlength=w.n_texts)
    length = per_text[w.text]
    place = np.arange(len(w.key)) - (np.cumsum(per_text) - per_text)[w.text]
    at = np.flatnonzero(place <= np.maximum(length - size, 0))
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            there = place[at] + j < length[at]
            now = tokens.mixed(out * _BASE + w.key[np.minimum(at + j, len(w.key) - 1)])
            out = np.where(there, now, out)
    return w.text[at], out


def buckets(texts: DataFrame) -> DataFrame:
    """(x, bucket): the band keys of the texts (x, t), once for each x; texts without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").to_numpy(zero_copy_only=False)
            for w in tokens.words(b.column("t")):
                text, h = hashes(w)
                if not len(h):
                    continue
                begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                of = x[w.first + text[begin]]
                keys = []
                with np.errstate(over="ignore"):
                    for band in range(BANDS):
                        key = np.full(len(begin), band + 1, np.uint64)
                        for k in range(band * ROWS, (band + 1) * ROWS):
                            key = tokens.mixed(key * _BASE + minima(h, begin, k))
                        keys.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(of, BANDS)), pa.array(np.concatenate(keys))], ["x", "bucket"])

    return texts.mapInArrow(run, "x long, bucket long").distinct()


def minima(h: np.ndarray, begin: np.ndarray, k: int) -> np.ndarray:
    """The k-th minimum of every text; ``begin`` is where the hashes of each text begin."""
    with np.errstate(over="ignore"):
        return np.minimum.reduceat(h * _FACTOR[k] + _ADDED[k], begin)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(x, s, k): the sorted distinct shingle hashes of each text and its sketch, once for each x; texts without words have neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in tokens.words(b.column("t")):
                text, h = hashes(w)
                if not len(h):
                    continue
                begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                ends = np.append(begin[1:], len(h))
                sets = [np.unique(h[a:z]).tobytes() for a, z in zip(begin, ends)]
                sketch = np.stack([(minima(h, begin, k) >> np.uint64(56)).astype(np.uint8) for k in range(BANDS * ROWS)], 1)
                x = b.column("x").take(pa.array(w.first + text[begin]))
                yield pa.RecordBatch.from_arrays([x, pa.array(sets, pa.binary()), pa.array([r.tobytes() for r in sketch], pa.binary())], ["x", "s", "k"])

    return texts.select("x", "t").mapInArrow(run, "x long, s binary, k binary").groupBy("x").agg(F.first("s").alias("s"), F.first("k").alias("k"))


def forest(sets: list[np.ndarray], sketch: np.ndarray, split: int | None, similar: float) -> list[tuple[int, int]]:
    """Links that connect all members of which some pair is similar. With ``split`` only pairs of a member before it and one from it on count."""
    n = len(sets)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    pairs, agree = [], []
    for a in range(n if split is None else split):
        first = a + 1 if split is None else split
        same = (sketch[first:] == sketch[a]).sum(1)
        near = np.flatnonzero(same >= AGREE)
        pairs.append(np.stack((np.full(len(near), a), first + near), 1))
        agree.append(same[near])
    if not pairs:
        return []
    pairs, agree = np.concatenate(pairs), np.concatenate(agree)
    links = []
    for a, b in pairs[np.argsort(-agree, kind="stable")].tolist():
        p, q = find(a), find(b)
        if p != q and jaccard(sets[a], sets[b]) >= similar:
            root[max(p, q)] = min(p, q)
            links.append((a, b))
    return links


def block_links(members: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """(a, b): links inside buckets (bucket, x, n) of any size, by pairs of blocks. A set goes to as many tasks as its bucket has blocks."""
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    dealt = members.withColumns({"_blocks": n_blocks, "own": F.pmod(F.xxhash64(F.lit("block"), "x"), n_blocks)})
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    dealt = dealt.select("bucket", "x", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("own", "ascending"), ("x", "ascending")])
        x, own = t.column("x").to_numpy(), t.column("own").to_numpy()
        found = [np.frombuffer(v.as_py(), np.uint64) for v in t.column("s")]
        sketch = np.frombuffer(b"".join(v.as_py() for v in t.column("k")), np.uint8).reshape(len(x), -1)
        i, j = key[1].as_py(), key[2].as_py()
        links = forest(found, sketch, None if i == j else int((own == i).sum()), similar)
        ends = np.array([sorted((x[a], x[b])) for a, b in links], np.int64).reshape(-1, 2)
        return pa.table([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return dealt.join(sets, "x").groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def alike(texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(a, b), a < b: different texts of (x, t) whose shingle sets have a Jaccard similarity of at least ``similar``.

    All such pairs of small buckets; of large buckets enough to connect the same texts.
    """
    keys = common.stored(buckets(texts), "shingle-buckets")
    sizes = common.stored(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("x").cast("decimal(38,0)")).alias("who")).where("n > 1"), "shingle-sizes")
    few = keys.join(sizes.where(F.col("n") <= SMALL).select("bucket"), "bucket").groupBy("bucket").agg(F.collect_list("x").alias("all"))
    inside = few.select("all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b")).where("a < b")
    pairs = common.stored(inside.distinct(), "shingle-pairs")
    # Bands whose buckets hold the very same texts need one of them.
    large = sizes.where(F.col("n") > SMALL).groupBy("n", "who").agg(F.min("bucket").alias("bucket"))
    members = common.stored(keys.join(large.select("bucket", "n"), "bucket"), "shingle-members")
    wanted = pairs.select(F.col("a").alias("x")).union(pairs.select("b")).union(members.select("x")).distinct()
    sets = common.stored(shingle_sets(texts.join(wanted, "x", "left_semi")), "shingle-sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            use = [jaccard(np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)) >= similar for p, q in zip(b.column("p"), b.column("q"))]
            yield b.select(["a", "b"]).filter(pa.array(use, pa.bool_()))

    both = pairs.join(sets.select(F.col("x").alias("a"), F.col("s").alias("p")), "a").join(sets.select(F.col("x").alias("b"), F.col("s").alias("q")), "b")
    listed = both.select("a", "b", "p", "q").mapInArrow(verify, "a long, b long")
    return listed.union(block_links(members, sets, similar)).distinct()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets; 0 where both are empty."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(len(a) + len(b) - shared, 1)
