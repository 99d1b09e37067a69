"""Toxicity by FTRL-proximal logistic regression (McMahan et al. 2013) over hashed word n-grams and skip-grams.

Features of a text: its distinct words, word pairs, and pairs that skip one word, each hashed to one of 2^22 places; words are runs of
letters, A-Z lower-cased. Per-coordinate rates let rare words learn fast, and the L1 term leaves a few thousand weights, small enough to
travel with every task.

Fitting reads all labelled rows. Features are made in parallel; the online learner is sequential by nature, so rows are dealt by a hash of
their key over learners of about ``bound`` rows each, whose weights are averaged (Zinkevich et al. 2010). Scoring reads whole texts in one
pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

BITS = 22
#: Labelled rows of one learner.
BOUND = 20_000
#: Averages are sums of whole multiples of this, so that they do not depend on their order.
_UNIT = 2.0**-40
#: Rate, smoothing of the rate, L1, L2 and passes of the learner.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 5.0, 0.1, 3


def features(values: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, text of each feature, place of each feature), repeats included."""
    shift = np.uint64(64 - BITS)
    for w in tokens.words(values, tokens.NOT_LETTER):
        with np.errstate(over="ignore"):
            near, skip = w.text[1:] == w.text[:-1], w.text[2:] == w.text[:-2]
            pairs = tokens.mixed(w.key[:-1] * np.uint64(3) + w.key[1:])[near]
            skips = tokens.mixed(w.key[:-2] * np.uint64(5) + w.key[2:])[skip]
        places = np.concatenate((w.key, pairs, skips)) >> shift
        yield w.first, w.n_texts, np.concatenate((w.text, w.text[:-1][near], w.text[:-2][skip])), places.astype(np.int64)


def _distinct(text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((text.astype(np.int64) << BITS) | place)
    return both >> BITS, both & ((1 << BITS) - 1)


def fit(rows: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and weights that are not zero, and the bias."""
    z, n, bias_z, bias_n = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0

    def weights(z, n):
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def bias() -> float:
        return -bias_z / ((BETA + bias_n**0.5) / ALPHA + L2)

    for _ in range(PASSES):
        for at, label in rows:
            own_z, own_n = z[at], n[at]
            w, b = weights(own_z, own_n), bias()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - label
            z[at] = own_z + g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / ALPHA * w
            n[at] = own_n + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / ALPHA * b
            bias_n += g * g
    at = np.flatnonzero(n)
    w = weights(z[at], n[at])
    return at[w != 0], w[w != 0], bias()


def coded(place: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """The distinct places of each text in order, as steps from one to the next: low 16 bits and the rest, of which nearly all are 0."""
    step = np.diff(place, prepend=0)
    first = ends[:-1][np.diff(ends) > 0]
    step[first] = place[first]

    def binary(values: np.ndarray) -> pa.Array:
        at = pa.py_buffer((ends * values.itemsize).astype(np.int32))
        return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, at, pa.py_buffer(values.tobytes())])

    return [binary((step & 0xFFFF).astype("<u2")), binary((step >> 16).astype(np.uint8))]


def places(low: bytes, high: bytes) -> np.ndarray:
    """The places of one text again."""
    return np.cumsum(np.frombuffer(low, "<u2") + (np.frombuffer(high, np.uint8).astype(np.int32) << 16), dtype=np.int32)


class Model:
    """Sparse weights; a text without words scores by the bias."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, bias: float):
        self.places, self.weights, self.bias = places, weights.astype(np.float64), bias
        self._dense: np.ndarray | None = None

    def __getstate__(self):
        return self.places, self.weights, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    def score(self, values: pa.Array) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros(1 << BITS)
            self._dense[self.places] = self.weights
        out = np.full(len(values), self.bias)
        for first, n_texts, text, place in features(values):
            used = self._dense[place] != 0
            text, place = _distinct(text[used], place[used])
            out[first : first + n_texts] += np.bincount(text, self._dense[place], n_texts)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", bound: int = BOUND) -> Model:
    """Fit on all labelled rows (see ``common.fitting_rows``); without any the model has no weights."""
    shards = common.shards(labels, label, key, bound)
    rows = common.fitting_rows(docs, labels, label, key, text).withColumn("shard", common.shard(shards))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n_texts, doc, place in features(b.column("t")):
                doc, place = _distinct(doc, place)
                ends = np.searchsorted(doc, np.arange(n_texts + 1))
                part = b.slice(first, n_texts)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("shard", "h", "y")), *coded(place, ends)], ["shard", "h", "y", "low", "high"])

    def model(sample: list[tuple[np.ndarray, float]]) -> pa.RecordBatch:
        at, w, bias = fit(sample)
        values = [[int(x) for x in at]], [[float(x) for x in w]], [float(bias)]
        kinds = pa.list_(pa.int32()), pa.list_(pa.float64()), pa.float64()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["at", "w", "bias"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample: list[tuple[np.ndarray, float]] = []
        last = None
        for b in batches:
            for shard, y, low, high in zip(*(b.column(c).to_pylist() for c in ("shard", "y", "low", "high"))):
                if sample and shard != last:
                    yield model(sample)
                    sample = []
                sample.append((places(low, high), y))
                last = shard
        if sample:
            yield model(sample)

    found = rows.mapInArrow(extract, "shard int, h long, y double, low binary, high binary")
    found = found.repartition(shards, "shard").sortWithinPartitions("shard", "h", "y")
    models = found.mapInArrow(learn, "at array<int>, w array<double>, bias double")
    if shards == 1:
        one = models.collect()
        return Model(np.array(one[0]["at"], np.int64), np.array(one[0]["w"], np.float64), one[0]["bias"]) if one else Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    # The bias goes with the weights, at place -1.
    weights = models.select(F.explode(F.arrays_zip(F.concat("at", F.array(F.lit(-1))).alias("at"), F.concat("w", F.array("bias")).alias("w"))).alias("z"))
    sums = weights.groupBy("z.at").agg(F.sum(F.round(F.col("z.w") / _UNIT).cast("long")).alias("w")).where("w != 0").orderBy("at").collect()
    at, w = np.array([r["at"] for r in sums], np.int64), np.array([r["w"] for r in sums], np.float64) * (_UNIT / shards)
    return Model(at[at >= 0], w[at >= 0], float(w[at < 0].sum()))


def score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """The rows of ``docs`` with a probability in column ``name``; null and empty texts get that of the bias.

    Works for every model with ``score(array of texts) -> array of probabilities``. A column that is called ``name`` already is replaced.
    """
    kept = [c for c in docs.columns if c != name or c == text]
    at = kept.index(text)
    rows = common.by_place(docs.select(*[common.named(c) for c in kept]))
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(b.column(at)), pa.float64())], [*b.schema.names, "score"])

    return rows.mapInArrow(run, schema).toDF(*kept, name)


def held_out_scores(spark: SparkSession, sf_dir: str, trainer, label: str, threshold: float) -> DataFrame:
    """Learn from four of five folds of the labels, score every document."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    model = trainer(docs, labels.where(common.fold(F.col("doc_id"), 5) != 0), label)
    scored = score(docs.select("doc_id", "text"), model).drop("text")
    held = (common.fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(spark, sf_dir, train, "toxic", 0.5)


QUERIES = {"op2_toxicity": op2_toxicity}
#: A fitted model has no SQL form; the query is tested by held-out accuracy.
ORACLES: dict[str, str] = {}
