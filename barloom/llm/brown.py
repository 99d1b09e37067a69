"""Language-model scores from Brown's class-based bigrams.

Words. The ``TOP`` most frequent words have a class each by exchange clustering; every rarer word, and one never seen, belongs to the unit of
its last two bytes, which has a class like a word. The end of a text has a class of its own, and stands before the first word as well.

Classes. The exchange algorithm (Kneser and Ney 1993, Martin et al. 1998) moves a word to the class with the greatest gain in the
likelihood of the class bigrams. It goes in two steps, both over counts from all training texts:

1. The core: the ``OWN`` most frequent words, the units of endings for all others, and the end. Their pairs are at most UNITS^2 counts,
   whatever the corpus, and are exchanged in one place until the passes are over.
2. All other words of the vocabulary, as a distributed pass (Uszkoreit and Brants 2008): each word's neighbours are counted by class, the
   words are dealt over the tasks with these counts, and each moves to its best class in the class bigrams of the core. Only class
   numbers come back, and the class bigrams are counted anew.

Model. P(word | last) = P(class | class of last) P(word | class): class transitions are interpolated with class frequencies; in its class a
word has (count + 0.5) / (sum of these), and so has a unit of an ending, by the count of its words outside the vocabulary. Among those
a word has (count + 0.5) / (total + 0.5 (distinct + 1)), which leaves room for one unknown word, as the base does. The probabilities of all
words after a history sum to 1.

Counts of the long tail are joined: per text and distinct tail word one row of two numbers. Counts and classes of the vocabulary
travel with the tasks, at most ``TOP`` of them (about 10 MB).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Words that have a class of their own and travel with the tasks, and of these the core.
TOP, OWN = 524_288, 1_024
#: Units for the other words, by their last two bytes; one more unit is the end.
ENDINGS = 512
UNITS = OWN + ENDINGS + 1
CLASSES, PASSES = 32, 4
END_KEY = -1  # stands for the end of a text among word keys
_WEIGHT = 16.0  # of the class frequencies in a transition
#: Counts of a word's neighbours: class after it, class before it, itself after it. Counts that a task holds at once.
SLOTS, HELD = 2 * CLASSES + 1, 500_000
#: Bytes of texts that are taken at once.
GROUP = 1 << 20
#: Words whose gains are worked out at once.
AT_ONCE = 64


def endings(words: tokens.Words) -> np.ndarray:
    """A number below ENDINGS from the last two bytes of every word."""
    last = words.data[words.end - 1].astype(np.uint64)
    before = np.where(words.end - 1 > words.start, words.data[np.maximum(words.end - 2, 0)], 0).astype(np.uint64)
    with np.errstate(over="ignore"):
        return (tokens.mixed(last * np.uint64(256) + before) % np.uint64(ENDINGS)).astype(np.int64)


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(key, ending, n): every word of all texts, counted in every task first; the end of each text is key END_KEY."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ends, counts = [np.array([END_KEY])], [np.array([0])], [np.array([b.num_rows])]
            for w in tokens.words(b.column(0), most=GROUP):
                key, at, n = np.unique(w.key.view(np.int64), return_index=True, return_counts=True)
                keys.append(key)
                ends.append(endings(w)[at])
                counts.append(n)
            key, at, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            total = np.bincount(where, np.concatenate(counts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate(ends)[at]), pa.array(total)], ["key", "ending", "n"])

    return texts.select(text).mapInArrow(count, "key long, ending long, n long").groupBy("key").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words with their counts, sorted by key, the core unit of each (-1 outside the core), and their endings."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, unit: np.ndarray, ending: np.ndarray):
        self.keys, self.counts, self.unit, self.ending = keys, counts, unit.astype(np.int16), ending.astype(np.int16)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key

    def places(self, w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
        return self.find(w.key.view(np.int64))

    def units(self, w: tokens.Words) -> np.ndarray:
        """Core units of all tokens in order, ends included."""
        at, known = self.places(w)
        unit = np.where(known, self.unit[at] if len(self.unit) else -1, -1)
        return with_ends(w, np.where(unit < 0, OWN + endings(w), unit), UNITS - 1)


def with_ends(w: tokens.Words, values: np.ndarray, end: int) -> np.ndarray:
    """One value per word, and ``end`` after each text."""
    out = np.full(len(values) + w.n_texts, end)
    out[np.arange(len(values)) + w.text] = values
    return out


class Classes:
    """The class of every vocabulary word and of the unit of every ending."""

    def __init__(self, vocabulary: Vocabulary, label: np.ndarray, of_ending: np.ndarray):
        self.vocabulary, self.label, self.of_ending = vocabulary, label.astype(np.int16), of_ending.astype(np.int64)

    def of_words(self, w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, place in the vocabulary and whether there, of all words."""
        at, known = self.vocabulary.places(w)
        own = self.label[at].astype(np.int64) if len(self.label) else 0
        return np.where(known, own, self.of_ending[endings(w)]), at, known


def pairs(texts: DataFrame, text: str, vocabulary: Vocabulary) -> DataFrame:
    """(pair, n): neighbouring units of all training texts, pair = first * UNITS + second."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS * UNITS, np.int64)
        for b in batches:
            for w in tokens.words(b.column(0), most=GROUP):
                unit = shared.value.units(w)
                # The end of the text before stands for the start.
                last = np.concatenate(([UNITS - 1], unit[:-1]))
                code, n = np.unique(last * UNITS + unit, return_counts=True)
                total[code] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return texts.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _plogp(x: np.ndarray) -> np.ndarray:
    """x log x of counts, 0 for 0."""
    return x * np.log(np.maximum(x, 1))


def best_class(table: np.ndarray, right: np.ndarray, left: np.ndarray, own: float) -> int:
    """The class (the last one excepted) that gains most by taking in a word which ``table`` does not hold.

    right, left: how often a class follows or precedes the word, itself (``own``) left out.
    """
    # Cells of row c and column c, and the two margins. What other classes get back in their margins is the same for every c.
    row, col = table.sum(1) + left, table.sum(0) + right
    gain = (_plogp(table + right) - _plogp(table)).sum(1) + (_plogp(table + left[:, None]) - _plogp(table)).sum(0)
    diagonal = np.diag(table)
    gain -= _plogp(diagonal + right) + _plogp(diagonal + left) - 2 * _plogp(diagonal)
    gain += _plogp(diagonal + right + left + own) - _plogp(diagonal)
    out_u, in_u = right.sum() + own, left.sum() + own
    gain -= _plogp(row + out_u) - _plogp(row) + _plogp(col + in_u) - _plogp(col)
    return int(np.argmax(gain[:-1]))


def best_classes(table: np.ndarray, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """``best_class`` of many words at once, each taken out of ``table``, which holds it in class ``old``.

    after, before: words x classes, how often a class follows or precedes each word, itself included.
    """
    place, every = np.arange(len(old)), np.arange(table.shape[0])
    right, left = after.copy(), before.copy()
    right[place, old] -= own
    left[place, old] -= own
    without = np.repeat(table[None], len(old), 0)
    without[place, old] -= right
    without[place, :, old] -= left
    without[place, old, old] -= own
    np.maximum(without, 0, out=without)  # a table from another labelling never gives a negative count
    held = _plogp(without)
    gain = (_plogp(without + right[:, None]) - held).sum(2) + (_plogp(without + left[:, :, None]) - held).sum(1)
    row, col = without.sum(2) + left, without.sum(1) + right
    diagonal, held = without[:, every, every], held[:, every, every]
    gain -= _plogp(diagonal + right) + _plogp(diagonal + left) - 2 * held
    gain += _plogp(diagonal + right + left + own[:, None]) - held
    out_u, in_u = (right.sum(1) + own)[:, None], (left.sum(1) + own)[:, None]
    gain -= _plogp(row + out_u) - _plogp(row) + _plogp(col + in_u) - _plogp(col)
    return np.argmax(gain[:, :-1], 1)


def move(table: np.ndarray, c: int, right: np.ndarray, left: np.ndarray, own: float) -> None:
    """Add a word's counts to class c; negative counts take it out."""
    table[c] += right
    table[:, c] += left
    table[c, c] += own


def exchange(counts: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """The class of every unit. Units without counts stay in the last class; the end keeps a class of its own."""
    counts = counts.astype(np.float64)
    n = len(counts)
    size = counts.sum(1) + counts.sum(0)
    order = np.argsort(-size, kind="stable")
    order = order[(size[order] > 0) & (order != n - 1)]
    movable = classes - 1
    label = np.full(n, movable - 1)
    label[order] = np.arange(len(order)) % movable
    label[n - 1] = movable
    member = np.zeros((n, classes))
    member[np.arange(n), label] = 1
    after, before = counts @ member, counts.T @ member  # of a unit: followed by / preceded by a class
    table = member.T @ after
    for _ in range(passes):
        moved = 0
        for u in order:
            old, own = label[u], counts[u, u]
            right, left = after[u].copy(), before[u].copy()
            right[old] -= own
            left[old] -= own
            move(table, old, -right, -left, -own)
            new = best_class(table, right, left, own)
            move(table, new, right, left, own)
            if new != old:
                moved += 1
                label[u] = new
                after[:, old] -= counts[:, u]
                after[:, new] += counts[:, u]
                before[:, old] -= counts[u]
                before[:, new] += counts[u]
        if not moved:
            break
    return label


def neighbours(texts: DataFrame, text: str, classes: Classes) -> DataFrame:
    """(place, slots, n): classes beside the vocabulary words outside the core, summed in every task, one row per task and word."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def grouped(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        place = code // SLOTS
        cut = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        ends = np.append(cut, len(code)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in ((code % SLOTS).astype(np.int8), n.astype(np.int32))]
        return pa.RecordBatch.from_arrays([pa.array(place[cut].astype(np.int32)), *lists], ["place", "slots", "n"])

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        code, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
        return code, np.bincount(where, np.concatenate([n for _, n in held]), len(code)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for w in tokens.words(b.column(0), most=GROUP):
                label, at, known = shared.value.of_words(w)
                whole = with_ends(w, label, CLASSES - 1)
                here = np.arange(len(label)) + w.text
                mine = known & (shared.value.vocabulary.unit[at] < 0) if len(at) else known
                place = at[mine] * SLOTS
                after, before = whole[here[mine] + 1], whole[here[mine] - 1]  # before the first word stands the end of the last text
                again = np.zeros(len(label), bool)
                again[:-1] = (w.key[1:] == w.key[:-1]) & (w.text[1:] == w.text[:-1])
                code = np.concatenate((place + after, place + CLASSES + before, at[mine & again] * SLOTS + 2 * CLASSES))
                held.append(np.unique(code, return_counts=True))
                size += len(held[-1][0])
                if size > HELD:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > HELD // 2 and size:
                        yield grouped(*held[0])
                        held, size = [], 0
        if size:
            yield grouped(*summed(held))

    return texts.select(text).mapInArrow(count, "place int, slots array<tinyint>, n array<int>")


def assigned(counts: DataFrame, classes: Classes, table: np.ndarray) -> DataFrame:
    """(pair, n): place and best class of every word that ``neighbours`` has counts of, given the class bigrams that hold it in its present class."""
    shared = counts.sparkSession.sparkContext.broadcast((classes.label, table.astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, table = shared.value
        carried, rest = -1, np.zeros(SLOTS)

        def chosen(place: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            own = v[:, 2 * CLASSES]
            parts = [slice(k, k + AT_ONCE) for k in range(0, len(place), AT_ONCE)]
            best = [best_classes(table, label[place[p]], v[p, :CLASSES], v[p, CLASSES : 2 * CLASSES], own[p]) for p in parts]
            return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(np.concatenate([np.zeros(0, np.int64), *best]))], ["pair", "n"])

        for b in batches:
            slots = b.column("slots")
            place = b.column("place").to_numpy()
            words, index = np.unique(place, return_inverse=True)
            code = np.repeat(index, np.diff(slots.offsets.to_numpy())) * SLOTS + slots.flatten().to_numpy()
            sums = np.bincount(code, b.column("n").flatten().to_numpy(), len(words) * SLOTS).reshape(-1, SLOTS)
            if carried >= 0:  # the word that the batch before ended with
                if len(words) and words[0] == carried:
                    sums[0] += rest
                else:
                    words, sums = np.insert(words, 0, carried), np.insert(sums, 0, rest, 0)
            if len(words):
                carried, rest = int(words[-1]), sums[-1]
                yield chosen(words[:-1].astype(np.int64), sums[:-1])
        if carried >= 0:
            yield chosen(np.array([carried]), rest[None])

    return counts.repartition("place").sortWithinPartitions("place").mapInArrow(run, "pair long, n long")


def class_pairs(texts: DataFrame, text: str, classes: Classes) -> np.ndarray:
    """How often each class follows each, over all training texts: CLASSES^2 numbers per task."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            for w in tokens.words(b.column(0), most=GROUP):
                label = with_ends(w, shared.value.of_words(w)[0], CLASSES - 1)
                total += np.bincount(np.concatenate(([CLASSES - 1], label[:-1])) * CLASSES + label, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["pair", "n"])

    out = np.zeros(CLASSES * CLASSES)
    for r in texts.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


def tails(words: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Per ending: occurrences and number of the words outside the vocabulary."""
    shared = words.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(ENDINGS), np.zeros(ENDINGS)
        for b in batches:
            key, ending, times = (b.column(c).to_numpy() for c in ("key", "ending", "n"))
            tail = ~shared.value.find(key)[1]
            n += np.bincount(ending[tail], times[tail], ENDINGS)
            v += np.bincount(ending[tail], minlength=ENDINGS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENDINGS)), pa.array(n.astype(np.int64)), pa.array(v.astype(np.int64))], ["ending", "n", "v"])

    total, distinct = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in words.mapInArrow(count, "ending long, n long, v long").groupBy("ending").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        total[r["ending"]], distinct[r["ending"]] = r["n"], r["v"]
    return total, distinct


class Model:
    """Logarithms to base 10 of the parts of the model."""

    def __init__(self, classes: Classes, table: np.ndarray, tail_total: np.ndarray, tail_distinct: np.ndarray, total: int, distinct: int, ends: int):
        self.classes = classes
        frequency = (table.sum(0) + 0.5) / (table.sum() + 0.5 * CLASSES)
        self.transition = np.log10((table + _WEIGHT * frequency) / (table.sum(1, keepdims=True) + _WEIGHT))
        counts = classes.vocabulary.counts
        mass = np.bincount(classes.label, counts + 0.5, CLASSES) + np.bincount(classes.of_ending, tail_total + 0.5, CLASSES)
        mass = np.log10(np.maximum(mass, 0.5))
        self.count_log = np.log10(counts + 0.5)
        #: Of a vocabulary word in its class, and of the unit of an ending in its; the end is all of its class.
        self.word = self.count_log - mass[classes.label]
        self.ending = np.log10(tail_total + 0.5) - mass[classes.of_ending]
        self.tail_room = np.log10(tail_total + 0.5 * (tail_distinct + 1))
        self.total, self.ends = total, ends
        self.room = np.log10(total + 0.5 * (distinct + 1))

    def text_sums(self, w: tokens.Words) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known, sums of log10(count + 0.5) over frequent words and end, model score without the tail's counts; and tail words."""
        label, at, known = self.classes.of_words(w)
        whole = with_ends(w, label, CLASSES - 1)
        ends = np.cumsum(np.bincount(w.text, minlength=w.n_texts) + 1) - 1
        first = np.concatenate(([0], ends[:-1] + 1))
        step = self.transition[np.concatenate(([CLASSES - 1], whole[:-1])), whole]
        at = np.where(known, at, 0)
        ending = endings(w)
        word = self.word[at] if len(self.word) else np.zeros(len(at))
        count_log = self.count_log[at] if len(self.word) else np.zeros(len(at))
        n = w.n_texts
        per_text = lambda x: np.bincount(w.text, x, n)
        total = np.add.reduceat(step, first) + per_text(np.where(known, word, self.ending[ending] - self.tail_room[ending]))
        n_tokens = np.bincount(w.text, minlength=n) + 1
        n_known = per_text(known).astype(np.int64) + (self.ends > 0)
        base = per_text(np.where(known, count_log, 0.0)) + np.log10(self.ends + 0.5) - n_tokens * self.room
        return n_tokens, n_known, base, total, ~known


def fit(training: DataFrame, text: str = "text") -> tuple[Model, DataFrame]:
    """The model of the texts of ``training``, and the counts of their words (key, n)."""
    counts = common.stored(word_counts(training, text), "brown-counts")
    words = counts.where(F.col("key") != END_KEY)
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), F.coalesce(F.sum(F.when(F.col("key") == END_KEY, F.col("n"))), F.lit(0)).alias("ends")).first()
    # At most TOP rows of three numbers come to the driver.
    top = words.select(F.col("key").alias("pair"), (F.col("n") * ENDINGS + F.col("ending")).alias("n"), F.col("n").alias("_n")).orderBy(F.desc("_n"), "pair").limit(TOP)
    top = top.select("pair", "n").mapInArrow(_packed, "pair binary, n binary").collect()
    keys, n = (np.frombuffer(b"".join(r[c] for r in top), np.int64) for c in ("pair", "n"))
    rank = np.lexsort((keys, -(n // ENDINGS)))
    keys, n = keys[rank], n[rank]
    unit = np.where(np.arange(len(keys)) < OWN, np.arange(len(keys)), -1)
    order = np.argsort(keys)
    vocabulary = Vocabulary(keys[order], n[order] // ENDINGS, unit[order], n[order] % ENDINGS)
    table = np.zeros(UNITS * UNITS)
    for r in pairs(training, text, vocabulary).coalesce(16).mapInArrow(_packed, "pair binary, n binary").toLocalIterator():
        table[np.frombuffer(r["pair"], np.int64)] = np.frombuffer(r["n"], np.int64)
    table = table.reshape(UNITS, UNITS)
    core = exchange(table)
    label = core[np.where(vocabulary.unit < 0, OWN + vocabulary.ending, vocabulary.unit)]
    classes = Classes(vocabulary, label, core[OWN : OWN + ENDINGS])
    if len(keys) > OWN:
        member = np.zeros((UNITS, CLASSES))
        member[np.arange(UNITS), core] = 1
        label = label.copy()
        rows = assigned(neighbours(training, text, classes), classes, member.T @ table @ member)
        # Two numbers per word of the vocabulary at most; taken at once, since an iterator would run one partition after the other.
        for r in rows.mapInArrow(_packed, "pair binary, n binary").collect():
            label[np.frombuffer(r["pair"], np.int64)] = np.frombuffer(r["n"], np.int64)
        classes = Classes(vocabulary, label, classes.of_ending)
    tail_total, tail_distinct = tails(words, vocabulary)
    return Model(classes, class_pairs(training, text, classes), tail_total, tail_distinct, int(whole["n"]), int(whole["v"]), int(whole["ends"])), words


def score(docs: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score per row, learning from the texts of ``training``.

    A null or empty text is its end alone. Null keys and repeated rows are scored like others; other columns are not read. Without training
    texts nothing is known and both scores are those of unknown words.
    """
    spark = docs.sparkSession
    model, words = fit(training, text)
    shared = spark.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in tokens.words(b.column("t"), most=GROUP):
                n_tokens, n_known, base, total, tail = shared.value.text_sums(w)
                word, text_of, n = _per_text(w.key[tail], w.text[tail], w.n_texts)
                ends = np.searchsorted(text_of, np.arange(w.n_texts + 1)).astype(np.int32)
                part = b.slice(w.first, w.n_texts)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (word.view(np.int64), n.astype(np.int32))]
                numbers = [pa.array(n_tokens.astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(total)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("k"), *numbers, *lists], names)

    names = ["row", key, "n_tokens", "n_known", "base", "total", "words", "times"]
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"), F.col(text).alias("t"))
    kind = dict(docs.dtypes)[key]
    scored = common.stored(
        numbered.mapInArrow(sums, f"row long, `{key}` {kind}, n_tokens long, n_known long, base double, total double, words array<bigint>, times array<int>"),
        "brown-sums",
    )
    # Frequent words never meet in this join, so no key is hot: a tail word is rarer than the TOP most frequent.
    tail = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("key"), F.col("x.times").alias("times"))
    found = tail.join(words.select("key", "n"), "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("logs"), F.sum("times").alias("seen")
    )
    size_of = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    both = scored.select("row", key, "n_tokens", "n_known", "base", "total", size_of("times").alias("tail")).join(found, "row", "left")
    seen, logs = F.coalesce("seen", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    unseen_log = (F.col("tail") - seen) * F.lit(float(np.log10(0.5)))
    return both.select(
        key, "n_tokens", (F.col("n_known") + seen).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs + unseen_log).alias("base_score"), (F.col("total") + logs + unseen_log).alias("score"),
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data = [[b.column(c).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()] for c in ("pair", "n")]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in data], ["pair", "n"])


def _per_text(key: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of every text with their counts, ordered by text."""
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return key[at], text[at], np.diff(np.append(at, len(key)))


def in_training(key: Column) -> Column:
    return common.fold(key, 5) != 1


def op10_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = score(docs, docs.where(in_training(F.col("doc_id"))))
    return found.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op10_brown": op10_brown}
#: The clustering has no SQL form; counts and base scores are tested against a plain loop, the model by its sums and held-out likelihood.
ORACLES: dict[str, str] = {}
