"""Benchmark decontamination by latent semantic retrieval.

1. Passages. Every text is cut into overlapping windows of words, and every benchmark item into windows of the same kind. Words are runs of
   letters and digits, A-Z in lower case.
2. TF-IDF. Words are hashed to ``TERMS`` columns; document frequencies count all documents. Texts are cut into words once for this and the next
   step: what is kept of every distinct text is two bytes per word.
3. Randomised SVD (Halko et al. 2011), distributed. The rows are the passages of all distinct texts, never stored: each pass multiplies the
   passage matrix by a thin matrix on both sides and sums TERMS x RANK numbers per task. The range found by
   a power step gives the right singular vectors. All passages and items are projected onto them, each coordinate divided by its singular
   value: otherwise the few directions that tell languages apart would outweigh all others.
4. Candidates. Items of fewer than ``WINDOW`` + ``STEP`` words have windows of 8, 4 or fewer words, and texts are searched with windows of those
   sizes as well, so that a short copy is not drowned by the words around it. A passage whose cosine with an item's window in the latent space reaches ``COSINE`` is a candidate.
5. Checks. The longest common subsequence of the item's words and of the text around the passage must cover ``COVERED`` of the item, close
   together, and the item's answer, its rarest words, must be there.

Steps 4 and 5 run where the text is, so nothing but finds is shuffled. The benchmark is a stated query set against all passages, in
blocks of ``BLOCK`` windows. What travels with the tasks is at most about ``PASS_ITEMS`` items and ``PASS_BYTES`` bytes; a larger benchmark is
dealt over several passes, each with a broadcast of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

TERM_BITS, RANK, EXTRA = 15, 48, 16
TERMS = 1 << TERM_BITS
#: Words of a window of a text, and of the step to the next one.
WINDOW, STEP = 16, 4
COSINE, COVERED, ANSWER = 0.7, 0.8, 0.5
#: Weight of a term: its inverse document frequency to this power, so that the words all texts share do not make all passages alike.
POWER = 3
#: Windows of items that are compared at once; items and bytes of their texts in one pass over the documents.
BLOCK, PASS_ITEMS, PASS_BYTES = 4_096, 50_000, 8 << 20
#: Windows of texts that are compared with a block at once.
ROWS = 1_024
#: Words from which an item has windows of a size, that size, and the step of the text's windows; shorter items are windows by themselves.
SIZES = [(WINDOW + STEP, WINDOW, STEP), (11, 8, STEP), (7, 4, STEP)]
#: Words of texts whose windows of step 1, or whose vectors, are made at once; bytes of texts that are cut into windows at once.
PIECE, AT_ONCE = 32_768, 1 << 20
#: Words of texts that are multiplied at once; rows that are added up by place; terms whose sums travel together.
WORDS, CHUNK, TOGETHER = 1 << 17, 32, 16
#: Rows that are added up together, few enough for the cache of a core; steps behind its first that a window reaches.
TILE, REACH = 1_024, WINDOW // STEP - 1
_NOT_WORD = tokens.NOT_LETTER.copy()
_NOT_WORD[48:58] = False


def terms(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def _ends(w: tokens.Words) -> np.ndarray:
    """Where the words of every text begin within all words, and their number."""
    return np.searchsorted(w.text, np.arange(w.n_texts + 1))


def coded(docs: DataFrame, text: str) -> DataFrame:
    """(h, terms, n): the terms of the words of every distinct text, two bytes each, and the number of its rows; h is a hash of the text."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in tokens.words(b.column("t"), _NOT_WORD, AT_ONCE // 4):
                ends = 2 * _ends(w)
                buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(terms(w.key).astype("<u2"))]
                yield pa.RecordBatch.from_arrays([b.column("h").slice(w.first, w.n_texts), pa.BinaryArray.from_buffers(pa.binary(), w.n_texts, buffers)], ["h", "terms"])

    rows = docs.select(F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("t"))
    same = rows.mapInArrow(code, "h long, terms binary").groupBy("h", "terms").agg(F.count(F.lit(1)).alias("n"))
    return common.stored(same, "passage-terms")


def _coded_groups(values: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, terms, and n + 1 offsets into them, of groups of about ``WORDS`` words; a longer text stands alone."""
    raw, at = tokens.column(values)
    for lo, hi in tokens.groups(at, 2 * WORDS):
        yield lo, np.frombuffer(raw[at[lo] : at[hi]], "<u2"), (at[lo : hi + 1] - at[lo]) // 2


def document_frequency(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per term over all rows of the texts of ``coded``, and the number of rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(TERMS, np.int64), 0
        for b in batches:
            rows = b.column("n").to_numpy()
            n += int(rows.sum())
            for first, term, ends in _coded_groups(b.column("terms")):
                order = np.argsort(term, kind="stable")
                term, text = term[order], np.repeat(np.arange(first, first + len(ends) - 1), np.diff(ends))[order]
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
                total += np.bincount(term[new], rows[text[new]], TERMS).astype(np.int64)
        at = np.append(np.flatnonzero(total), TERMS)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total[at[:-1]], n))], ["term", "n"])

    out = np.zeros(TERMS + 1, np.int64)
    summed = texts.select("terms", "n").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in summed.toLocalIterator():
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


def _steps(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text of each step, its first word within all words, its number within its text, its words; text k has the words from ``ends[k]`` to ``ends[k + 1]``."""
    steps = -(-np.diff(ends) // STEP)
    first = np.cumsum(steps) - steps
    text = np.repeat(np.arange(len(steps)), steps)
    number = np.arange(len(text)) - first[text]
    at = ends[:-1][text] + number * STEP
    return text, at, number, np.minimum(ends[1:][text] - at, STEP)


def _step_sums(term: np.ndarray, at: np.ndarray, length: np.ndarray, term_rows: np.ndarray) -> np.ndarray:
    """Sums of the rows of the words of every step."""
    sums = np.take(term_rows, term[at], axis=0)
    more = np.empty_like(sums)
    # One word of every step at a time: a row per step is made, never a row per word.
    for k in range(1, STEP):
        np.take(term_rows, term[np.minimum(at + k, len(term) - 1)], axis=0, out=more, mode="clip")
        more[length <= k] = 0
        sums += more
    return sums


def _doubled(rows: np.ndarray, text: np.ndarray, reach: int, back: bool = False) -> np.ndarray:
    """Every row with that ``reach`` rows behind it added, or with ``back`` before it, if it is of the same text."""
    out = np.empty_like(rows)
    alone, other = slice(len(rows) - min(reach, len(rows)), None), np.flatnonzero(text[reach:] != text[:-reach])
    if back:
        alone, other = slice(0, reach), other + reach
        np.add(rows[reach:], rows[:-reach], out=out[reach:])
    else:
        np.add(rows[:-reach], rows[reach:], out=out[:-reach])
    out[alone], out[other] = rows[alone], rows[other]
    return out


def _added(sums: np.ndarray, text: np.ndarray, size: int, back: bool = False) -> np.ndarray:
    """Steps added up to windows of ``size`` words, which end with their text. Each doubling adds the windows so far to those right behind."""
    out, reach = sums, 1
    while reach < size // STEP:
        out, reach = _doubled(out, text, reach, back), 2 * reach
    return out


def _summed(rows: np.ndarray, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and for each the sum of the rows ``at``; equal keys stand together.

    Rows of a key are added up in chunks, one row of every chunk at a time, then the sums of the chunks in the same way.
    """
    while True:
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.diff(np.append(first, len(key)))
        chunks = -(-n // CHUNK)
        number = np.arange(int(chunks.sum())) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        size = np.minimum(CHUNK, np.repeat(n, chunks) - number * CHUNK)
        order = np.argsort((CHUNK - size).astype(np.uint8), kind="stable")  # the longest first
        begin = (np.repeat(first, chunks) + number * CHUNK)[order]
        longer = len(begin) - np.cumsum(np.bincount(size, minlength=CHUNK + 1))
        out = np.take(rows, at[begin], axis=0)
        more = np.empty((min(TILE, len(begin)), rows.shape[1]), rows.dtype)
        for lo in range(0, int(longer[1]), TILE):
            for k in range(1, CHUNK):
                m = min(int(longer[k]) - lo, TILE)
                if m <= 0:
                    break
                np.take(rows, at[begin[lo : lo + m] + k], axis=0, out=more[:m], mode="clip")
                out[lo : lo + m] += more[:m]
        if len(begin) == len(first):
            return key[begin], out
        key, rows, at = np.repeat(key[first], chunks), out, np.argsort(order)


def size_of(length: int) -> tuple[int, int]:
    """Size of the windows that an item of so many words is compared in, and the step of the text's windows."""
    return next(((size, step) for least, size, step in SIZES if length >= least), (length, 1))


def long_windows(length: int) -> list[int]:
    """Where the windows of an item of so many words begin: spread over it, with all remainders by STEP, so that one begins where a step of the text does."""
    n = max(STEP, -(-(length - WINDOW) // WINDOW) + 1)
    even = [k * (length - WINDOW) // (n - 1) for k in range(n)]
    return [x - (x - k) % STEP for k, x in enumerate(even)]


def _each_word_vectors(w: tokens.Words, term_rows: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sums of the rows of whole windows of ``size`` words that begin at every word, piece by piece: vectors, text and first word of each."""
    for lo in range(0, max(len(w.key) - size + 1, 0), PIECE):
        hi = min(lo + PIECE, len(w.key) - size + 1)
        rows = term_rows[terms(w.key[lo : hi + size - 1])]
        out = sum(rows[k : k + hi - lo] for k in range(size))
        at = lo + np.flatnonzero(w.text[lo:hi] == w.text[lo + size - 1 : hi + size - 1])
        yield out[at - lo], w.text[at], at


def range_pass(texts: DataFrame, idf: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """A^T (A thin) over all passages of the texts of ``coded``, where row p of A is the TF-IDF of passage p: one pass, summed per task and then over tasks."""
    shared = texts.sparkSession.sparkContext.broadcast((idf.astype(np.float32), (idf[:, None] * thin).astype(np.float32)))
    width = thin.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, rows = shared.value
        total = np.zeros((TERMS, width), np.float32)
        for b in batches:
            for _, term, ends in _coded_groups(b.column("terms")):
                if not len(term):
                    continue
                text, at, _, length = _steps(ends)
                back = np.empty((len(at), width), np.float32)
                for lo in range(0, len(at), TILE):
                    some = slice(max(lo - REACH, 0), lo + TILE + REACH)
                    windows = _added(_step_sums(term, at[some], length[some], rows), text[some], WINDOW)
                    # A word lies in the windows that begin up to REACH steps before it: their vectors are added up per step.
                    back[lo : lo + TILE] = _added(windows, text[some], WINDOW, back=True)[lo - some.start :][:TILE]
                order = np.argsort(term, kind="stable")
                step = np.repeat(np.arange(len(at)), length)
                some, found = _summed(back, step[order], term[order])
                total[some] += found
        total *= idf[:, None]
        packed = total.reshape(TERMS // TOGETHER, -1)
        used = np.flatnonzero(packed.any(1))
        ends = np.arange(len(used) + 1) * packed.itemsize * packed.shape[1]
        buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(packed[used])]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.BinaryArray.from_buffers(pa.binary(), len(used), buffers)], ["block", "v"])

    found = texts.select("terms").mapInArrow(multiply, "block long, v binary")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for block, v in zip(b.column("block").to_pylist(), b.column("v").to_pylist()):
                row = np.frombuffer(v, np.float32)
                total[block] = total[block] + row if block in total else row.astype(np.float64)
        packed = np.array(list(total.values()), np.float32).tobytes() if total else b""
        yield pa.RecordBatch.from_arrays([pa.array([np.array(list(total), np.int64).tobytes()], pa.binary()), pa.array([packed], pa.binary())], ["block", "v"])

    out = np.zeros((TERMS // TOGETHER, TOGETHER * width))
    for r in found.repartition(8, "block").mapInArrow(add, "block binary, v binary").toLocalIterator():
        at = np.frombuffer(r["block"], np.int64)
        out[at] = np.frombuffer(r["v"], np.float32).reshape(-1, TOGETHER * width)
    return out.reshape(TERMS, width)


def singular_vectors(texts: DataFrame, idf: np.ndarray, rank: int = RANK, extra: int = EXTRA, seed: int = 5) -> np.ndarray:
    """The first right singular vectors of the TF-IDF of all passages, each divided by its singular value: TERMS x rank.

    One pass turns a random thin matrix towards the row space (a power step in itself), a second one on its orthonormal basis Q gives
    A^T A Q, whose small projection Q^T A^T A Q is solved exactly.
    """
    rng = np.random.default_rng(seed)
    thin = range_pass(texts, idf, rng.normal(size=(TERMS, rank + extra)))
    q, _ = np.linalg.qr(thin)
    small = q.T @ range_pass(texts, idf, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    first = np.argsort(-values)[:rank]
    return q @ vectors[:, first] / np.sqrt(np.maximum(values[first], max(1e-9 * values.max(), 1e-12)))


def lcs_ends(item: list[int], text: list[int]) -> tuple[int, int, int]:
    """Length of a longest common subsequence, and first and last matched place in ``text``; bit-parallel (Hyyro 2004)."""

    def rows(a, b):
        places: dict[int, int] = {}
        for i, x in enumerate(a):
            places[x] = places.get(x, 0) | 1 << i
        full, v, reached, best = (1 << len(a)) - 1, (1 << len(a)) - 1, -1, 0
        for j, x in enumerate(b):
            u = v & places.get(x, 0)
            v = ((v + u) | (v - u)) & full
            now = len(a) - v.bit_count()
            if now > best:
                best, reached = now, j
        return best, reached

    best, last = rows(item, text)
    if not best:
        return 0, -1, -1
    _, back = rows(item[::-1], text[: last + 1][::-1])
    return best, last - back, last


class Items:
    """The benchmark in latent space: unit vectors of windows, and the words and answer of every item."""

    def __init__(self, ids: list[int], values: pa.Array, idf: np.ndarray, basis: np.ndarray):
        self.ids, self.keys, self.answers = ids, [], []
        parts: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        self.rows = (idf[:, None] * basis).astype(np.float32)
        for w in tokens.words(values, _NOT_WORD):
            cut = _ends(w)
            for i in range(w.n_texts):
                key = w.key[cut[i] : cut[i + 1]]
                self.keys.append(key.tolist())
                rare = np.argsort(-idf[terms(key)], kind="stable")[: max(1, len(key) // 4)]
                self.answers.append(set(key[rare].tolist()))
            lengths = np.diff(cut)
            long = np.flatnonzero(lengths >= SIZES[0][0])
            places = [np.array(long_windows(n)) for n in lengths[long].tolist()]
            text = np.repeat(long, [len(x) for x in places])
            at = cut[text] + np.concatenate([*places, np.zeros(0, np.int64)])
            term = terms(w.key)
            found = sum((self.rows[term[at + k]] for k in range(WINDOW)), np.zeros((len(at), self.rows.shape[1]), np.float32))
            parts.setdefault(SIZES[0][1:], []).append((found, text + w.first))
            # Of short items all windows: one of them begins where a step of the text does.
            for size, step in {size_of(n) for n in lengths.tolist() if 0 < n < SIZES[0][0]}:
                mine = np.array([size_of(n) == (size, step) for n in lengths.tolist()])
                for found, text, _ in _each_word_vectors(w, self.rows, size):
                    parts.setdefault((size, step), []).append((found[mine[text]], text[mine[text]] + w.first))
        self.sets = [frozenset(k) for k in self.keys]
        #: The distinct words of all items, and where those of each begin.
        self.words = np.array([x for k in self.sets for x in k], np.uint64)
        self.cut = np.cumsum([0, *map(len, self.sets)])
        #: Words of a text that have one check of an item in common.
        self.strides = np.array([max(WINDOW, len(k) // 2) for k in self.keys], np.int64)
        #: By size and step: unit vectors of the windows, and their items.
        self.windows = {k: (_unit(np.concatenate([v for v, _ in x])), np.concatenate([o for _, o in x])) for k, x in parts.items()}

    def passages(self, w: tokens.Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Unit vectors, text and first word of a text's windows, with the vectors and owners of the items' windows of that size."""
        term, (of, begin, _, length) = terms(w.key), _steps(_ends(w))
        for lo in range(0, len(begin), TILE):
            some, mine = slice(lo, lo + TILE + REACH), slice(lo, lo + TILE)
            wide, done = {STEP: _step_sums(term, begin[some], length[some], self.rows)}, STEP
            for size in sorted(size for size, step in self.windows if step == STEP):
                while done < size:
                    wide[2 * done], done = _doubled(wide[done], of[some], done // STEP), 2 * done
            for (size, step), (own, owner) in self.windows.items():
                if len(own) and step == STEP:
                    yield _unit(wide[size][:TILE]), of[mine], begin[mine], own, owner
        for (size, step), (own, owner) in self.windows.items():
            if len(own) and step != STEP:
                for vectors, text, at in _each_word_vectors(w, self.rows, size):
                    yield _unit(vectors), text, at, own, owner

    def candidates(self, w: tokens.Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Item, text, first word and cosine of every window that is like one of an item, in order, about ``PIECE`` at once."""
        found, n = [], 0
        for vectors, text, at, own, owner in self.passages(w):
            for lo in range(0, len(own), BLOCK):
                some = own[lo : lo + BLOCK]
                for row in range(0, len(vectors), ROWS):
                    cosines = vectors[row : row + ROWS] @ some.T
                    like = cosines >= COSINE
                    hit = np.flatnonzero(like.any(1))
                    near, column = np.nonzero(like[hit])
                    window = row + hit[near]
                    found.append((owner[lo + column], text[window], at[window], cosines[hit[near], column]))
                    n += len(window)
                    if n >= PIECE:
                        yield tuple(np.concatenate(x) for x in zip(*found))
                        found, n = [], 0
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))

    def enough(self, item: np.ndarray, text: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Whether the whole text has so many of the item's words that the check can hold in a part of it; ``inside`` has all marks in order."""
        pairs, which = np.unique(text * len(self.sets) + item, return_inverse=True)
        text, item = np.divmod(pairs, len(self.sets))
        n = np.diff(self.cut)[item]
        first = np.cumsum(n) - n
        words = self.words[np.repeat(self.cut[item] - first, n) + np.arange(int(n.sum()))]
        marks = _marks(words, np.repeat(text, n))
        there = inside[np.minimum(np.searchsorted(inside, marks), len(inside) - 1)] == marks
        return (np.add.reduceat(there, first, dtype=np.int64) >= 0.6 * n)[which]

    def find(self, values: pa.Array) -> Iterator[tuple[int, int, float, float]]:
        """(text, item, covered, cosine) of every item that a text contains, each once."""
        for w in tokens.words(values, _NOT_WORD, AT_ONCE):
            ends, inside = _ends(w).tolist(), np.sort(_marks(w.key, w.text))
            best: dict[tuple[int, int], tuple[float, float]] = {}
            tried: set[tuple[int, int, int]] = set()
            for item, text, at, cosine in self.candidates(w):
                use = self.enough(item, text, inside)
                # Windows next to each other look at the same words: one check for every half length of the item.
                part = at[use] // self.strides[item[use]]
                for i, t, part, cosine in zip(item[use].tolist(), text[use].tolist(), part.tolist(), cosine[use].tolist()):
                    if (i, t, part) in tried:
                        continue
                    tried.add((i, t, part))
                    length = len(self.keys[i])
                    start = part * int(self.strides[i]) - length - WINDOW
                    around = w.key[max(ends[t], start) : min(ends[t + 1], start + 3 * (length + WINDOW))].tolist()
                    covered = self.check(i, around)
                    if covered >= COVERED:
                        pair = (w.first + t, i)
                        best[pair] = max(best.get(pair, (0.0, 0.0)), (covered, cosine))
            for (t, item), (covered, cosine) in best.items():
                yield t, item, covered, cosine

    def check(self, item: int, around: list[int]) -> float:
        """The share of the item's words in a longest common subsequence that lies close together and holds the answer; else 0."""
        words = self.keys[item]
        if len(self.sets[item].intersection(around)) < 0.6 * len(self.sets[item]):
            return 0.0
        length, first, last = lcs_ends(words, around)
        if length < COVERED * len(words):
            return 0.0
        if last - first + 1 > 1.5 * len(words) + 4:  # a stray match far off: look at stretches of the item's size
            size = len(words) + len(words) // 4 + 4
            starts = range(0, max(len(around) - size, 0) + max(1, len(words) // 4), max(1, len(words) // 4))
            length, start = max((lcs_ends(words, around[k : k + size])[0], -k) for k in starts)
            first, last = -start, -start + size - 1
            if length < COVERED * len(words):
                return 0.0
        if len(self.answers[item].intersection(around[first : last + 1])) < ANSWER * len(self.answers[item]):
            return 0.0
        return length / len(words)


def _marks(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One number for a word of a text: the number of the text, then 40 bits of the word."""
    return text.astype(np.uint64) << np.uint64(40) | key >> np.uint64(24)


def _unit(vectors: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return (vectors / np.maximum(size, 1e-9)[:, None]).astype(np.float32, copy=False)


class Fitted:
    """The latent space, and the benchmark dealt over ``passes``; only the items of one pass are ever in the driver."""

    def __init__(self, idf: np.ndarray, basis: np.ndarray, rows: DataFrame, passes: int):
        self.idf, self.basis, self.rows, self.passes = idf, basis, rows, passes

    def items(self, k: int) -> Items:
        mine = self.rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(self.passes)) == k).collect()
        mine = sorted(((r["id"], r["t"]) for r in mine), key=str)
        return Items([i for i, _ in mine], pa.array([t for _, t in mine], pa.string()), self.idf, self.basis)


def fit(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> Fitted:
    """The latent space of all passages of all texts. Items that are null or have no words find nothing; a repeated row of the benchmark is one item."""
    rows = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_key).cast("long").alias("id"), F.col(item_text).alias("t")).distinct()
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    texts = coded(docs, text)
    frequency, total = document_frequency(texts)
    idf = (np.log((1 + total) / (1 + frequency)) + 1e-3) ** POWER
    return Fitted(idf, singular_vectors(texts, idf), rows, max(1, -(-n // PASS_ITEMS), -(-size // PASS_BYTES)))


def leaks(docs: DataFrame, fitted: Fitted, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, item_id, covered (share of the item's words), cosine: one row per row of ``docs`` and item it contains.

    Null and empty texts contain nothing; null keys and repeated rows are searched like others; other columns are not read.
    """
    rows, kind = docs.select(F.col(key).alias("k"), F.col(text).alias("t")), dict(docs.dtypes)[key]

    def found_in_pass(k: int) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(fitted.items(k))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = list(shared.value.find(b.column("t")))
                at = pa.array([x[0] for x in found], pa.int64())
                ids = pa.array([shared.value.ids[x[1]] for x in found], pa.int64())
                numbers = [pa.array([x[k] for x in found], pa.float64()) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays([b.column("k").take(at), ids, *numbers], [key, "item_id", "covered", "cosine"])

        return rows.mapInArrow(search, f"`{key}` {kind}, item_id long, covered double, cosine double")

    # Of several passes each is written before the next one's items are made.
    if fitted.passes == 1:
        return found_in_pass(0)
    return reduce(DataFrame.union, [common.stored(found_in_pass(k), f"leaks-{k}") for k in range(fitted.passes)])


def clean(docs: DataFrame, fitted: Fitted, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns as they are."""

    def after_pass(docs: DataFrame, k: int) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(fitted.items(k))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                use = np.ones(b.num_rows, bool)
                use[[x[0] for x in shared.value.find(b.column(at))]] = False
                yield b.filter(pa.array(use))

        rows = common.by_place(docs)
        return rows.mapInArrow(keep, rows.schema).toDF(*docs.columns)

    at = docs.columns.index(text)

    for k in range(fitted.passes):
        docs = after_pass(docs, k) if k == fitted.passes - 1 else common.stored(after_pass(docs, k), f"clean-{k}")
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return leaks(docs, fit(docs, common.table(spark, sf_dir, "benchmark")))


QUERIES = {"op6_decontamination": op6_decontamination}
#: The latent space has no SQL form; the query is tested against a comparison of every item with every text.
ORACLES: dict[str, str] = {}
