"""Near-duplicates by SimHash, searched with a generalised pigeonhole (Qin et al. 2018).

1. Fingerprints. Every text becomes 64 bits: a bit is set where more than half of its shingle hashes have it. Texts with one fingerprint
   become one class, so exact copies cost one row per task from here on.
2. Partitions. The correlation of the 64 bits over all classes groups bits that go together, so that one partition carries the
   redundancy and the others stay selective.
3. Thresholds. If two fingerprints differ in at most r bits, then for any thresholds that sum up to r - m + 1 over m partitions, some
   partition differs in at most its threshold (-1: not probed). For every fingerprint, dynamic programming picks the thresholds with the
   fewest estimated candidates and probes, from exact counts of the partition values.
4. Probe and verify. A fingerprint probes all values within its threshold; whole fingerprints are compared inside (partition, value)
   buckets. Buckets are dealt in blocks of bounded size, and a block returns a forest of links, never all pairs.
5. Components by repeated minimum over links with pointer jumping, in a table of linked classes only.

Nothing is capped: a bucket of any size is compared block by block.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

BITS, RADIUS, SHINGLE = 64, 3, 3
#: Bits per partition: the counts of all values of a partition stay within 2^16 numbers.
PARTS = 4
WIDTH = BITS // PARTS
#: Fingerprints in one block of a bucket.
BLOCK = 2_048


# ---- fingerprints


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """64 bits of a word list; 0 without words."""
    if not words:
        return 0
    text, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [h(text, 42)]
    else:
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[:-1]]
        hashes = [h(text[a : b - 1], 42) for a, b in zip(starts, ends[shingle - 1 :])]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int32)
    return int((counts * 2 > len(hashes)).astype(np.uint64) @ (np.uint64(1) << np.arange(BITS, dtype=np.uint64)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint as a signed long, over whole texts; a null text is empty."""
    lower = bytes(tokens.LOWER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint((t or b"").translate(lower).split(), shingle) for t in (x.as_py() for x in b.column("t"))]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("k"), fp], [key, "fp"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, f"`{key}` long, fp long")


# ---- partitions and thresholds


def bit_sums(classes: DataFrame) -> np.ndarray:
    """How many fingerprints have bit i and bit j set: 65 x 64 numbers, the last row for single bits and [64, 64] for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1))
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            bits = np.concatenate((bits, np.ones((len(bits), 1), np.float32)), 1)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.astype(np.int64).ravel())], ["place", "n"])

    found = classes.select("fp").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((BITS + 1) ** 2)
    for r in found:
        out[r["place"]] = r["n"]
    return out.reshape(BITS + 1, BITS + 1)


def partitions(sums: np.ndarray) -> np.ndarray:
    """The bits of each partition: each starts with the strongest correlation left and takes in the bits that go with it most."""
    n = max(sums[-1, -1], 1)
    mean = sums[-1, :BITS] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    strength = np.abs(sums[:BITS, :BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    left, out = list(range(BITS)), []
    for _ in range(PARTS):
        own = strength[np.ix_(left, left)]
        group = [left[int(own.sum(1).argmax() if len(left) == WIDTH else np.unravel_index(own.argmax(), own.shape)[0])]]
        while len(group) < WIDTH:
            rest = [b for b in left if b not in group]
            group.append(rest[int(strength[np.ix_(rest, group)].sum(1).argmax())])
        left = [b for b in left if b not in group]
        out.append(sorted(group))
    return np.array(out)


def values_of(fp: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The value of every partition, one column each."""
    out = np.zeros((len(fp), len(parts)), np.int64)
    for p, bits in enumerate(parts):
        for k, bit in enumerate(bits):
            out[:, p] |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def masks_within(radius: int) -> np.ndarray:
    """All changes of at most ``radius`` bits of a partition."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(WIDTH), r)], np.int64)


def value_counts(classes: DataFrame, parts: np.ndarray) -> np.ndarray:
    """How many fingerprints have each value of each partition: PARTS x 2^WIDTH exact numbers, a proven bound for the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, 1 << WIDTH), np.int64)
        for b in batches:
            values = values_of(b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), parts)
            for p in range(PARTS):
                total[p] += np.bincount(values[:, p], minlength=1 << WIDTH)
        flat = total.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["place", "n"])

    found = classes.select("fp").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(PARTS << WIDTH, np.int64)
    packed = found.groupBy((F.col("place") % 64).alias("g")).agg(F.collect_list(F.struct("place", "n")).alias("x"))
    for row in packed.toLocalIterator():
        for place, n in row["x"]:
            out[place] = n
    return out.reshape(PARTS, 1 << WIDTH)


def estimates(counts: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """[partition, threshold + 1, value]: candidates plus probes of a value at each threshold from -1 to ``radius`` - PARTS + 1 + PARTS - 1."""
    most = radius - PARTS + 1 + (PARTS - 1)
    out = np.zeros((PARTS, most + 2, 1 << WIDTH))
    at = np.arange(1 << WIDTH)
    for p in range(PARTS):
        near, done = np.zeros(1 << WIDTH), 0
        masks = masks_within(most)
        for t in range(most + 1):
            upto = len(masks_within(t))
            for m in masks[done:upto]:
                near += counts[p][at ^ m]
            done = upto
            out[p, t + 1] = near + upto
    return out


def allocate(values: np.ndarray, costs: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Thresholds per fingerprint and partition that sum up to radius - PARTS + 1 at the least cost, by dynamic programming."""
    most = costs.shape[1] - 2
    goal = radius - PARTS + 1 + PARTS  # thresholds counted from -1
    best = np.full((len(values), goal + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((PARTS, len(values), goal + 1), np.int8)
    for p in range(PARTS):
        cost = costs[p][:, values[:, p]]
        new = np.full_like(best, np.inf)
        for total in range(goal + 1):
            for t in range(min(total, most + 1) + 1):
                now = best[:, total - t] + cost[t]
                better = now < new[:, total]
                new[better, total] = now[better]
                choice[p, better, total] = t
        best = new
    out = np.zeros((len(values), PARTS), np.int64)
    left = np.full(len(values), goal)
    for p in reversed(range(PARTS)):
        out[:, p] = choice[p, np.arange(len(values)), left]
        left = left - out[:, p]
    return out - 1


# ---- probe and verify


def forest(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest fingerprint of its group) that connect what pairs of a and b within ``radius`` connect."""
    both, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    at_a, at_b = at[: len(a)], at[len(a) :]
    rows, cols = [], []
    for lo in range(0, len(a), 512):
        i, j = np.nonzero(np.bitwise_count(a[lo : lo + 512, None] ^ b[None, :]) <= radius)
        rows.append(at_a[lo + i])
        cols.append(at_b[j])
    i, j = np.concatenate(rows), np.concatenate(cols)
    use = i != j
    i, j = i[use], j[use]
    label = np.arange(len(both))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(both)))
    return both[moved], both[label[moved]]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between different fingerprints whose components are those of all pairs within ``radius``."""
    parts = partitions(bit_sums(classes))
    counts = value_counts(classes, parts)
    costs = estimates(counts, radius).astype(np.float32)
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast((counts, costs))  # 2^WIDTH numbers per partition and threshold, whatever the input

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, costs = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 4_096):
                fp = b.column("fp").slice(lo, 4_096).to_numpy(zero_copy_only=False)
                values = values_of(fp.view(np.uint64), parts)
                thresholds = allocate(values, costs, radius)
                out: list[tuple[np.ndarray, ...]] = []

                def add(rows, part, value, probing):
                    n = len(rows)
                    blocks = -(-counts[part][value] // BLOCK)
                    own = (fp[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                    if probing:  # to every block of the bucket, in portions of about a block as well
                        keep = blocks > 0
                        rows, value, blocks, own = rows[keep], value[keep], blocks[keep], own[keep]
                        times = np.repeat(np.arange(len(rows)), blocks)
                        block = np.arange(len(times)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                        rows, value, portion = rows[times], value[times], (own // 7919 % np.maximum(blocks, 1))[times]
                        out.append((np.full(len(rows), part), value, block, portion, np.ones(len(rows), np.int64), fp[rows]))
                    else:  # into its block, for every portion of probes
                        times = np.repeat(np.arange(n), blocks)
                        portion = np.arange(len(times)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                        block = own % np.maximum(blocks, 1)
                        out.append((np.full(len(times), part), value[times], block[times], portion, np.zeros(len(times), np.int64), fp[rows[times]]))

                everyone = np.arange(len(fp))
                for p in range(PARTS):
                    add(everyone, p, values[:, p], False)
                    for t in range(thresholds[:, p].max() + 1):
                        rows = np.flatnonzero(thresholds[:, p] >= t)
                        for mask in masks_within(t)[len(masks_within(t - 1)) if t else 0 :]:
                            add(rows, p, values[rows, p] ^ mask, True)
                columns = [pa.array(np.concatenate([x[k] for x in out])) for k in range(6)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "value", "block", "portion", "probing", "fp"])

    schema = "part long, value long, block long, portion long, probing long, fp long"
    dealt = classes.select("fp").mapInArrow(probe, schema)
    bucket = ["part", "value", "block", "portion"]
    ordered = dealt.repartition(*bucket).sortWithinPartitions(*bucket, "probing", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive bucket by bucket; a bucket may go on in the next batch."""
        held: pa.Table | None = None
        for b in itertools.chain(batches, [None]):
            now = pa.Table.from_batches([b]) if b is not None else None
            rows = now if held is None else held if now is None else pa.concat_tables([held, now])
            if rows is None or not rows.num_rows:
                continue
            keys = np.stack([rows.column(c).to_numpy() for c in bucket], 1)
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            cut = int(change[-1]) if len(change) else 0
            end = rows.num_rows if b is None else cut
            held = rows.slice(end)
            if end:
                yield _verified(keys[:end], rows.column("probing").to_numpy()[:end], rows.column("fp").to_numpy()[:end], radius)

    return ordered.mapInArrow(verify, "a long, b long").distinct()


def _verified(keys: np.ndarray, probing: np.ndarray, fp: np.ndarray, radius: int) -> pa.RecordBatch:
    begins = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
    sizes = np.diff(begins)
    members = np.add.reduceat(probing == 0, begins[:-1])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    unsigned = fp.view(np.uint64)
    # Small buckets together: member i of a bucket against row i + shift, for every shift up to the size.
    small = sizes <= 64
    in_small = np.repeat(small, sizes)
    at, bucket = np.flatnonzero(in_small), np.repeat(np.arange(len(sizes)), sizes)[in_small]
    for shift in range(1, int(sizes[small].max(initial=1))):
        i, j = at[:-shift], at[shift:]
        near = (bucket[:-shift] == bucket[shift:]) & (probing[i] == 0) & (probing[j] == 1)
        i, j = i[near], j[near]
        hit = (np.bitwise_count(unsigned[i] ^ unsigned[j]) <= radius) & (fp[i] != fp[j])
        found.append((np.maximum(fp[i[hit]], fp[j[hit]]), np.minimum(fp[i[hit]], fp[j[hit]])))
    for k in np.flatnonzero(~small & (members > 0) & (members < sizes)):
        a, b = fp[begins[k] : begins[k] + members[k]], fp[begins[k] + members[k] : begins[k + 1]]
        high, low = forest(a.view(np.uint64), b.view(np.uint64), radius)
        found.append((high.view(np.int64), low.view(np.int64)))
    a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    both = np.unique(np.stack((a, b), 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])


# ---- components


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root): every node of a link with the smallest node of its component.

    Each round writes a table: a node's root and the roots of its neighbours are lowered to the least of them, then every root points to
    its root's root. Minima combine in every task before the shuffle, so a node with very many links is no burden.
    """
    both = common.stored(edges.union(edges.select("b", "a")).toDF("node", "other").distinct(), f"{purpose}-links")
    roots = common.stored(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), f"{purpose}-0")
    for turn in itertools.count(1):
        near = both.join(roots.select(F.col("node").alias("other"), F.col("root").alias("other_root")), "other")
        lowest = near.groupBy("node").agg(F.min("other_root").alias("low"))
        hooked = roots.join(lowest, "node").select("node", "root", F.least("root", "low").alias("low"))
        # The root of a node learns what its members have found.
        of_root = hooked.groupBy(F.col("root").alias("node")).agg(F.min("low").alias("heard"))
        lowered = hooked.join(of_root, "node", "left").select("node", "root", F.least("low", F.coalesce("heard", "low")).alias("new"))
        jumped = lowered.join(lowered.select(F.col("node").alias("new"), F.col("new").alias("next")), "new", "left")
        after = common.stored(jumped.select("node", "root", F.least("new", F.coalesce("next", "new")).alias("new")), f"{purpose}-{turn}")
        changed = after.where("new < root").limit(1).count()
        roots = after.select("node", F.col("new").alias("root"))
        if not changed:
            return roots


def rooted(marked: DataFrame, radius: int = RADIUS, more: DataFrame | None = None) -> DataFrame:
    """(fp, root): every fingerprint of ``marked`` with the smallest one that links of at most ``radius`` bits, or of ``more`` (a, b), reach."""
    classes = common.stored(marked.select("fp").distinct(), "simhash-classes")
    found = links(classes, radius) if more is None else links(classes, radius).union(more)
    found = components(common.stored(found, "simhash-links"), "simhash")
    return classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """key, fp, component_id: the smallest key that links of at most ``radius`` bits reach, one row per row.

    Texts without words have fingerprint 0 and link like others. A row whose key is null keeps its fingerprint and takes part in links; its
    component is the smallest key that is not null, or null. Repeated rows stay repeated. Other columns are not read.
    """
    marked = common.stored(fingerprints(docs, key, text, shingle), "simhash")
    classes = common.stored(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-classes")
    found = components(common.stored(links(classes, radius), "simhash-links"), "simhash")
    labelled = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = labelled.join(ids, "root").select("fp", "component_id")
    return marked.join(by_class, "fp").select(key, "fp", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash": op8_simhash}
#: XXH64 has no SQL form here; the query is tested against a plain loop over all pairs.
ORACLES: dict[str, str] = {}
