"""Words of a batch of texts as numpy arrays: where they stand and a 64-bit hash of each.

Works on the bytes of an Arrow column without a Python object per word or per text. Memory is bounded by the batch: texts are taken in
groups of about ``GROUP`` bytes, a longer text by itself, and hashed in pieces of ``PIECE`` bytes cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP, PIECE = 1 << 20, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space parts words, all else belongs to them.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All but letters and bytes of longer characters part words.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[97:123] = NOT_LETTER[65:91] = NOT_LETTER[128:] = False


@dataclass
class Words:
    """Words of the texts ``first`` to ``last - 1`` of a batch, in order."""

    first: int
    last: int
    text: np.ndarray  # of each word, counted from ``first``
    key: np.ndarray  # uint64
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray  # the lower-cased bytes that start and end point into

    @property
    def n_texts(self) -> int:
        return self.last - self.first


def column(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string or binary column; null is empty."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    values = values.fill_null("" if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else b"")
    large = values.cast(pa.large_binary())
    _, offsets, data = large.buffers()
    if not len(large):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[large.offset : large.offset + len(large) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def groups(at: np.ndarray, most: int = GROUP) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text stands alone."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


_powers: list[np.ndarray] = []


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        up = np.full(max(n, PIECE) + 1, _BASE)
        down = np.full(max(n, PIECE) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0], _powers[1]


def _keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of data[start:end] for every word, from one running sum per piece."""
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + PIECE, "right")))
        a, b = int(start[lo]), int(end[hi - 1])
        up, down = _powers_to(b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        out[lo:hi] = mixed((total[e] - total[s]) * down[s])
        lo = hi
    return out


def spans(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every word of the texts that ``offsets`` cuts ``data`` into; no word crosses the end of a text."""
    inside = ~parts[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))


def taken(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of the words only, one word after the other."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    return data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]


def numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for every word, equal for equal words only, and the words that the numbers stand for."""
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=at[1:])
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(taken(data, start, end))])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def words(values: pa.Array, parts: np.ndarray = BLANK, most: int = GROUP) -> Iterator[Words]:
    """The words of every text of a column, group by group; groups cover all texts, those without words included."""
    raw, at = column(values)
    with np.errstate(over="ignore"):
        for lo, hi in groups(at, most):
            data = LOWER[raw[at[lo] : at[hi]]]
            start, end, text = spans(data, at[lo : hi + 1] - at[lo], parts)
            yield Words(lo, hi, text, _keys(data, start, end), start, end, data)
