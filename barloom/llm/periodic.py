"""Periodic runs of words: online sparse dynamic programming over diagonals.

A diagonal is a lag d; its match length at word i counts how many words up to i equal the word d before them. An earlier occurrence of
word i at distance d lengthens diagonal d by one; a diagonal that is not lengthened ends there, and if it has matched long enough it
is emitted as a run at once.

All pairs of equal words would be too many (a word repeated n times has n^2 / 2 of them), so the occurrences are taken on scales, none
of which loses a run. A run of period q and at least 3 q words holds, at lag q, matches of 2 q words in a row, hence matches of whole
stretches of w words for the power of two w with w / 2 < q <= w. On scale w the "words" are stretches of w words, and among the earlier
occurrences of a stretch only the *nearest* can be the lag of a run of that scale:

* Let the run have smallest period q. A stretch of w >= q words inside it that recurs at a distance d < q would make the word of one period equal to
  a rotation of itself, so d would be a multiple of the smallest period. Hence the nearest earlier occurrence inside a run is at q exactly.
* So every position lengthens at most one diagonal per scale, and a diagonal that ends with ``3 q`` words is a run of smallest period q:
  with a smaller period its last stretch would have had a nearer occurrence. It is maximal for the same reason.

A stretch that occurs once in its text takes no part in larger scales, which leaves few positions after the first scales of an ordinary
text. Work is O(n log n) per scale with at most log2(n) scales, memory O(n) of one text, whatever repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 24, 3
#: Bytes of texts that are searched at once; a longer text by itself.
GROUP = 1 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, strongest struct<start: long, length: long, period: long>, collapsed string"


def diagonals(at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position, last position and lag of every diagonal, from the lag that each position (ascending) lengthens."""
    ends = np.ones(len(at), bool)
    ends[:-1] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
    last = np.flatnonzero(ends)
    first = np.concatenate(([0], last[:-1] + 1)).astype(np.int64)
    return at[first[: len(last)]], at[last], lag[last]


def runs(numbers: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of a sequence, by start, then period.

    ``numbers`` may hold several texts in a row as long as no number occurs in two of them; ``longest`` is the length of the longest.
    ``times`` is at least 3: with two periods the nearest occurrence need not be the period.
    """
    if times < 3 or least < 1:
        raise ValueError("a run has three periods at least")
    found = []
    position, number, w = np.arange(len(numbers)), numbers, 1
    while len(position) and times * (w // 2 + 1) <= longest:
        order = np.argsort(number, kind="stable")
        p, same = position[order], number[order][1:] == number[order][:-1]
        lag = p[1:] - p[:-1]
        use = same & (lag > w // 2) & (lag <= w)
        at, d = p[1:][use], lag[use]
        by_place = np.argsort(at)
        first, last, q = diagonals(at[by_place], d[by_place])
        length = last - first + w + q
        good = length >= np.maximum(least, times * q)
        found.append((first[good] - w + 1 - q[good], length[good], q[good]))
        # The next scale: stretches of 2 w words, both halves of which occur more than once.
        again = np.zeros(len(p), bool)
        again[1:] |= same
        again[:-1] |= same
        rank = np.cumsum(np.concatenate(([0], ~same)))
        place = np.argsort(p[again])
        p, rank = p[again][place], rank[again][place]
        half = np.searchsorted(p, p - w)
        both = p[np.minimum(half, len(p) - 1)] == p - w if len(p) else np.zeros(0, bool)
        position, number = p[both], rank[half[both]] * (int(rank.max(initial=0)) + 1) + rank[both]
        w *= 2
    start, length, period = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; of equals that of the smallest start, then period."""
    return max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, n_texts: int) -> pa.Array:
    """The words of every text, with one space between them."""
    size = end - start + 1
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    size[last] -= 1
    out = np.full(int(size.sum()), 0x20, np.uint8)
    spaces = (np.cumsum(size) - 1)[~last]
    letters = np.ones(len(out), bool)
    letters[spaces] = False
    out[letters] = tokens.taken(data, start, end)
    at = np.concatenate(([0], np.cumsum(np.bincount(text, weights=size, minlength=n_texts)))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(n_texts, pa.py_buffer(at), pa.py_buffer(out)).cast(pa.string())


def searched(values: pa.Array, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """For texts ``lo`` to ``hi`` of a column: n_words, runs, strongest, collapsed."""
    raw, at = tokens.column(values)
    for lo, hi in tokens.groups(at, GROUP):
        n = hi - lo
        data = raw[at[lo] : at[hi]]
        start, end, text = tokens.spans(data, at[lo : hi + 1] - at[lo])
        count = np.bincount(text, minlength=n)
        begin = np.cumsum(count) - count
        word, kinds = tokens.numbers(data, start, end)
        s, length, q = runs(text * max(len(kinds), 1) + word, int(count.max(initial=0)), least, times)
        of = text[s]
        # Words after the first period of a run go, wherever runs overlap.
        step = np.zeros(len(word) + 1, np.int64)
        np.add.at(step, s + q, 1)
        np.add.at(step, s + length, -1)
        kept = np.cumsum(step[:-1]) == 0
        collapsed = joined(data, start[kept], end[kept], text[kept], n)
        rows = pa.StructArray.from_arrays([pa.array(s - begin[of]), pa.array(length), pa.array(q)], fields=list(_RUN))
        cut = np.searchsorted(of, np.arange(n + 1))
        lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows)
        best = [None] * n
        triples = list(zip((s - begin[of]).tolist(), length.tolist(), q.tolist()))
        for i in np.unique(of):
            best[i] = dict(zip(("start", "length", "period"), strongest(triples[cut[i] : cut[i + 1]])))
        yield lo, hi, [pa.array(count), lists, pa.array(best, _RUN), collapsed]


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per row: key, n_words, runs (start, length, period; by start, then period), strongest, collapsed.

    Words are parted by white space, compared byte by byte and numbered from 0. A run is a stretch with smallest period q that cannot be
    lengthened, of at least ``least`` words and ``times`` periods. ``collapsed`` holds the words that stand in the first period of every run
    they belong to, or in none, with one space between them. ``strongest`` is the run of the greatest length / period.

    A null or empty text has no words, no runs (an empty list), a null ``strongest`` and an empty ``collapsed``. Null and repeated keys and repeated rows
    are kept as they come; an empty table gives no rows; other columns, whatever their names, are not read. Texts are searched whole.
    """
    rows = docs.select(common.named(key).alias("k"), common.named(text).cast("string").alias("t"))
    schema = common.schema(f"k {rows.schema['k'].dataType.simpleString()}, {RESULT}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, columns in searched(b.column("t"), least, times):
                yield pa.RecordBatch.from_arrays([b.column("k").slice(lo, hi - lo), *columns], schema.names)

    return rows.mapInArrow(run, schema).select(F.col("k").alias(key), *schema.names[1:])


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): a tenth of the texts, by crc32 of the key, repeats one stretch of its words up to its end.

    With h the crc32 of the key as text and g = h div 10, the words of a text with h % 10 = 0 from number a = g % n on repeat with
    p = 1 + (n - a) div (3 + g % 8). A null key counts as the empty text.
    """
    h = F.crc32(F.coalesce(common.named(key).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(common.named(key).alias(key), common.named(text).alias("_t"), h.alias("_h"))
    found = F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("_t", F.lit(f"({common.WORD})"), F.lit(1)))
    rows = rows.withColumn("_w", found)
    g = F.expr("_h div 10")
    rows = rows.withColumns({"_a": F.when(F.size("_w") > 0, g % F.size("_w")), "_by": 3 + g % 8})
    rows = rows.withColumn("_p", F.expr("1 + (size(_w) - _a) div _by"))
    planted = F.array_join(F.expr("transform(sequence(0L, cast(size(_w) AS long) - 1), i -> _w[cast(if(i < _a, i, _a + (i - _a) % _p) AS int)])"), " ")
    return rows.select(common.named(key), F.when(F.size("_w") > 0, planted).otherwise(F.col("_t")).alias("text"))


def digest(runs: Column) -> Column:
    """SHA-256 of the runs, one line of start, length and period each."""
    line = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.sha2(F.array_join(line, ""), 256)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse(with_planted_runs(common.table(spark, sf_dir, "documents")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        digest(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
#: In SQL every pair of equal words of a document would be a row; the query is tested against a plain search instead.
ORACLES: dict[str, str] = {}
