"""Quality by a small byte-level convolutional network in numpy.

Every byte has a learned vector; learned filters of eight bytes move over the whole text in steps of four; each filter is max-pooled inside
chunks of 256 bytes that overlap by half; the mean and the maximum over all chunks go through one hidden layer into one probability. No
part of a text is left out. Texts are padded with zero bytes, whose vector is fixed at zero.

Fitting reads all labelled rows. They are dealt by a hash of their key to shards of about ``bound`` rows. Gradient steps are sequential, so the
first shard is learned in one task; then, in ``ROUNDS`` rounds, every shard goes on from the same weights in a task of its own and the results are
averaged by their rows (local SGD, Stich 2019). Scoring is one pass without a shuffle, with memory for a group of texts of about 1 MB at a time, or for one longer text in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens, toxicity

#: Labelled rows of a shard.
BOUND = 4_000
#: Sizes: byte vector, filters, step, half of a chunk, hidden units.
DIM, FILTERS, STEP, HALF, HIDDEN = 4, 16, 4, 128, 16
PASSES, BATCH, RATE = 10, 32, 0.01
#: Rounds over all shards, and their first rate.
ROUNDS, ROUND_RATE = 2, 0.003
#: Bytes of texts that are scored together, and half chunks that are convolved together.
_GROUP, _PIECE = 1 << 20, 4_096


def padded(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each filled with zeros to whole half chunks, two at least; and the first half chunk of each."""
    lengths = np.diff(at)
    halves = np.maximum(2, (lengths + STEP + HALF - 1) // HALF)
    first = np.concatenate(([0], np.cumsum(halves)))
    out = np.zeros(int(first[-1]) * HALF + STEP, np.uint8)
    target = np.repeat(first[:-1] * HALF - (at[:-1] - at[0]), lengths) + np.arange(int(at[-1] - at[0]))
    out[target] = raw[at[0] : at[-1]]
    return out, first


class Network:
    """The parameters, and the two directions of the network."""

    NAMES = ("byte", "left", "right", "shift", "hidden", "hidden_shift", "out", "out_shift")

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        make = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.byte = make(256, DIM, scale=0.5)
        self.byte[0] = 0
        self.left, self.right = make(STEP * DIM, FILTERS, scale=0.25), make(STEP * DIM, FILTERS, scale=0.25)
        self.shift = np.zeros(FILTERS, np.float32)
        self.hidden, self.hidden_shift = make(2 * FILTERS, HIDDEN, scale=0.2), np.zeros(HIDDEN, np.float32)
        self.out, self.out_shift = make(HIDDEN, 1, scale=0.2), np.zeros(1, np.float32)

    def convolved(self, data: np.ndarray) -> np.ndarray:
        """One row per step and one column per filter; bytes 4 i to 4 i + 7 meet in row i."""
        steps = self.byte[data].reshape(-1, STEP * DIM)
        return (steps @ self.left)[:-1] + (steps @ self.right)[1:]

    def halves(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each filter in each half chunk, and the row it came from."""
        rows = self.convolved(data).reshape(-1, HALF // STEP, FILTERS)
        where = rows.argmax(1)
        best = np.take_along_axis(rows, where[:, None], 1)[:, 0]
        return best, where + np.arange(len(rows))[:, None] * (HALF // STEP)

    def maxima(self, data: np.ndarray) -> np.ndarray:
        """The values of ``halves`` alone, a piece at a time."""
        n = (len(data) - STEP) // HALF
        pieces = [(lo, min(lo + _PIECE, n)) for lo in range(0, n, _PIECE)]
        rows = [self.convolved(data[lo * HALF : hi * HALF + STEP]).reshape(-1, HALF // STEP, FILTERS).max(1) for lo, hi in pieces]
        return np.concatenate(rows)

    @staticmethod
    def chunks(best: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk maxima from neighbouring halves: values, index of the left half, first chunk of each text."""
        left = np.delete(np.arange(len(best)), first[1:] - 1)
        return np.maximum(best[left], best[left + 1]), left, first - np.arange(len(first))

    def forward(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inner = np.tanh(pooled @ self.hidden + self.hidden_shift)
        return inner, 1 / (1 + np.exp(-np.clip(inner @ self.out + self.out_shift, -30, 30)))[:, 0]

    def pooled(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean and maximum over the chunks of every text."""
        data, first = padded(raw, at)
        value, _, begin = self.chunks(self.maxima(data), first)
        value = np.maximum(value + self.shift, 0)
        mean = np.add.reduceat(value, begin[:-1]) / np.diff(begin)[:, None]
        return np.concatenate((mean, np.maximum.reduceat(value, begin[:-1])), 1).astype(np.float32)

    def score(self, values: pa.Array) -> np.ndarray:
        raw, at = tokens.column(values)
        parts = [self.forward(self.pooled(raw, at[lo : hi + 1]))[1] for lo, hi in tokens.groups(at, _GROUP)]
        return np.concatenate(parts).astype(np.float64) if parts else np.zeros(0)

    def gradients(self, raw: np.ndarray, at: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of a batch; through a maximum only to the place it came from."""
        data, first = padded(raw, at)
        best, where = self.halves(data)
        value, left, begin = self.chunks(best, first)
        use_right = best[left + 1] > best[left]
        active = value + self.shift > 0
        value = np.where(active, value + self.shift, 0)
        counts = np.diff(begin)
        mean = np.add.reduceat(value, begin[:-1]) / counts[:, None]
        largest = np.maximum.reduceat(value, begin[:-1])
        pooled = np.concatenate((mean, largest), 1)
        inner, p = self.forward(pooled)
        d_out = ((p - label) / len(label)).astype(np.float32)[:, None]
        grad = {"out": inner.T @ d_out, "out_shift": d_out.sum(0)}
        d_inner = (d_out @ self.out.T) * (1 - inner * inner)
        grad |= {"hidden": pooled.T @ d_inner, "hidden_shift": d_inner.sum(0)}
        d_pooled = d_inner @ self.hidden.T
        text = np.repeat(np.arange(len(label)), counts)
        is_best = value == largest[text]
        ties = np.add.reduceat(is_best, begin[:-1], dtype=np.float32)
        d_value = d_pooled[text, :FILTERS] / counts[text][:, None] + is_best * (d_pooled[:, FILTERS:] / ties)[text]
        d_value = np.where(active, d_value, 0).astype(np.float32)
        grad["shift"] = d_value.sum(0)
        row = np.where(use_right, where[left + 1], where[left])
        filters = np.broadcast_to(np.arange(FILTERS), row.shape)
        used = d_value != 0
        row, filters, d = row[used], filters[used], d_value[used]
        windows = data[(row * STEP)[:, None] + np.arange(2 * STEP)]
        vectors = self.byte[windows].reshape(len(row), -1)
        both = np.zeros((FILTERS, 2 * STEP * DIM), np.float32)
        np.add.at(both, filters, vectors * d[:, None])
        grad |= {"left": both.T[: STEP * DIM], "right": both.T[STEP * DIM :]}
        kernel = np.concatenate((self.left, self.right)).T[filters].reshape(len(row), 2 * STEP, DIM) * d[:, None, None]
        grad["byte"] = np.zeros_like(self.byte)
        for k in range(DIM):
            grad["byte"][:, k] = np.bincount(windows.ravel(), kernel[:, :, k].ravel(), 256)
        grad["byte"][0] = 0
        return grad

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 11, passes: int = PASSES, rate: float = RATE, last: float = 0.0) -> Network:
        """Adam over shuffled batches, with a rate that falls from ``rate`` to ``last``."""
        rng = np.random.default_rng(seed)
        first = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        second = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        step, steps = 0, passes * -(-len(texts) // BATCH)
        for _ in range(passes):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), BATCH):
                rows = order[lo : lo + BATCH]
                raw, at = tokens.column(pa.array([texts[i] for i in rows], pa.binary()))
                grad = self.gradients(raw, at, labels[rows])
                step += 1
                now = rate * (1 - (step - 1) / steps) + last * ((step - 1) / steps)
                for n in self.NAMES:
                    first[n] = 0.9 * first[n] + 0.1 * grad[n]
                    second[n] = 0.999 * second[n] + 0.001 * grad[n] ** 2
                    change = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - now * change).astype(np.float32))
        return self

    def packed(self) -> bytes:
        return b"".join(getattr(self, n).astype(np.float32).tobytes() for n in self.NAMES)

    @classmethod
    def unpacked(cls, data: bytes) -> Network:
        net, lo = cls(), 0
        for n in cls.NAMES:
            like = getattr(net, n)
            setattr(net, n, np.frombuffer(data, np.float32, like.size, lo).reshape(like.shape).copy())
            lo += 4 * like.size
        return net


def _round(rows: DataFrame, start: Network, k: int) -> Network:
    """All shards one pass further from the same weights, then their average by rows; one row of sums per task comes back."""
    packed, rates = start.packed(), [ROUND_RATE * (1 - (k + i) / ROUNDS) for i in range(2)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        y: list[float] = []
        total, n = np.zeros(len(packed) // 4), 0

        def learned() -> np.ndarray:
            net = Network.unpacked(packed).fit(texts, np.array(y), 11 + k, 1, *rates)
            return np.frombuffer(net.packed(), np.float32).astype(np.float64) * len(texts)

        last = None
        for b in batches:
            for shard, t, label in zip(*(b.column(c).to_pylist() for c in ("shard", "t", "y"))):
                if texts and shard != last:
                    total, n = total + learned(), n + len(texts)
                    texts, y = [], []
                texts.append(t)
                y.append(label)
                last = shard
        if texts:
            total, n = total + learned(), n + len(texts)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()], pa.binary())], ["n", "net"])

    total, n = np.zeros(len(packed) // 4), 0
    for r in rows.mapInArrow(learn, "n long, net binary").toLocalIterator():
        total, n = total + np.frombuffer(r["net"]), n + r["n"]
    return Network.unpacked((total / n).astype(np.float32).tobytes()) if n else start


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", bound: int = BOUND) -> Network:
    """Fit on all labelled rows (see ``common.fitting_rows``). Without labelled rows the network keeps its first weights."""
    shards = common.shards(labels, label, key, bound)
    rows = common.fitting_rows(docs, labels, label, key, text).select(common.shard(shards).alias("shard"), "h", "y", F.col("t").cast("binary").alias("t"))
    if shards > 1:  # read once per round
        rows = common.stored(rows.repartition(shards, "shard").sortWithinPartitions("shard", "h", "y", "t"), "quality-rows")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        y: list[float] = []
        for b in batches:
            texts += b.column("t").to_pylist()
            y += b.column("y").to_pylist()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([Network().fit(texts, np.array(y)).packed()], pa.binary())], ["net"])

    found = rows.where("shard = 0").select("h", "y", "t").repartition(1).sortWithinPartitions("h", "y", "t").mapInArrow(learn, "net binary").collect()
    net = Network.unpacked(found[0]["net"]) if found else Network()
    for k in range(ROUNDS if shards > 1 else 0):
        net = _round(rows, net, k)
    return net


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(spark, sf_dir, train, "quality", 0.3)


QUERIES = {"op5_quality": op5_quality}
#: A fitted model has no SQL form; the query is tested by held-out accuracy.
ORACLES: dict[str, str] = {}
