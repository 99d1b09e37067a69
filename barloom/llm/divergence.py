"""How the sources of a language differ in their use of terms: a K-squared quadtree over the matrix of groups and terms.

A group is a (language, source). Each language keeps the terms that enough of its documents hold; counts become shares in parts of
``SCALE``, with two added to every count, and two groups differ at a term by floor((p - q)^2 / (p + q)). Two reports follow: for every group
its distance to each other source of its language, summed over all kept terms, and the terms that it uses most above its language.

1. Count. Words of whole texts are numbered and counted batch by batch, summed by (language, term, source), and cut to the kept terms.
2. Blocks. The matrix of a language is cut into blocks of about ``COLUMNS`` terms and ``ROWS`` sources by hash, so one language, source or
   term, however frequent, is spread evenly. A task gets two row blocks of one column block, and all rows by name, empty ones too.
3. Tree. Each block is a K-squared tree: its levels hold the Morton codes of the quadrants that have any count, down to the single cells.
4. Joint traversal. Pairs of quadrants (rows of one group, rows of the other, same columns) are walked from the top. Where both are empty,
   all their cells have the share of a zero count, which is one number per group: such columns are only counted, and priced at the end by
   one multiplication. Other pairs are split, down to the cells, where shares are compared one by one.

All sums are exact: shares by long division in whole numbers, distances in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

#: A term is kept if at least so many documents of the language hold it; ranks of the terms of a group.
IN_DOCUMENTS, TOP = 10, 10
#: Parts of one, and what is added to every count.
SCALE, ADDED = 1_000_000_000, 2
#: Terms and sources of a block, about.
COLUMNS, ROWS = 512, 64
#: Bytes of texts that are counted at once.
GROUP = 8 << 20


# ---- counts


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, summed within batches only, from (lang, source, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, source = b.column("lang").dictionary_encode(), b.column("source").dictionary_encode()
            n_sources = max(len(source.dictionary), 1)
            group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
            raw, at = tokens.column(b.column("t"))
            for lo, hi in tokens.groups(at, GROUP):
                data = tokens.LOWER[raw[at[lo] : at[hi]]]
                start, end, text = tokens.spans(data, at[lo : hi + 1] - at[lo], tokens.NOT_LETTER)
                if not len(start):
                    continue
                term, kinds = tokens.numbers(data, start, end)
                held, times = np.unique(text * len(kinds) + term, return_counts=True)
                # Rows of one term come together, which the shuffle's compression likes.
                cell = (held % len(kinds)) * (int(group.max()) + 1) + group[lo + held // len(kinds)]
                order = np.argsort(cell, kind="stable")
                cell = cell[order]
                first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
                n, documents = np.add.reduceat(times[order], first), np.diff(np.append(first, len(cell)))
                g, k = cell[first] % (int(group.max()) + 1), cell[first] // (int(group.max()) + 1)
                columns = [lang.dictionary.take(pa.array(g // n_sources)), source.dictionary.take(pa.array(g % n_sources)), kinds.take(pa.array(k)).cast(pa.large_string()).cast(pa.string()), pa.array(n), pa.array(documents)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_cells(docs: DataFrame, least: int = IN_DOCUMENTS) -> DataFrame:
    """(lang, term, source, n, all_n) of the kept terms; all_n: occurrences in the whole language.

    Summed by (lang, term, source) first, in every task before the shuffle, so a frequent term comes as one row per source when its rows are put side by side.
    """
    cells = counted(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    cells = cells.withColumns({"held": F.sum("docs").over(same), "all_n": F.sum("n").over(same)})
    return cells.where(F.col("held") >= least).select("lang", "term", "source", "n", "all_n")


# ---- shares and distances


def shares(count: np.ndarray, whole: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + ADDED) / (whole + ADDED * terms)), by long division in base 1000: exact up to totals of 9 * 10^15."""
    by = np.maximum(whole + ADDED * terms, 1)
    q, rest = np.divmod(count + ADDED, by)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, by)
        q = q * 1000 + more
    return q + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


# ---- the tree


def interleaved(x: np.ndarray) -> np.ndarray:
    """The bits of x with a zero before each."""
    x = x.astype(np.int64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << shift)) & mask
    return x


def morton(row: np.ndarray, column: np.ndarray) -> np.ndarray:
    return (interleaved(row) << 1) | interleaved(column)


class Tree:
    """A K-squared tree (K = 2) of the cells with a count: per level, sorted, the Morton codes of the quadrants that hold any."""

    def __init__(self, row: np.ndarray, column: np.ndarray, height: int):
        code = morton(row, column)
        self.order = np.argsort(code)
        self.levels = [code[self.order]]
        for _ in range(height):
            self.levels.append(np.unique(self.levels[-1] >> 2))

    def find(self, level: int, row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each quadrant holds any count, and its place in the level."""
        codes, code = self.levels[level], morton(row, column)
        if not len(codes):
            return np.zeros(len(code), bool), np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return codes[at] == code, at


def between(row: np.ndarray, column: np.ndarray, share: np.ndarray, zero: np.ndarray, n_columns: int, split: int | None = None) -> np.ndarray:
    """Distances of all pairs of rows, summed over the columns: a matrix of which the part above the diagonal counts.

    ``row``, ``column``, ``share``: the cells with a count; ``zero``: the share of a zero count in each row. With ``split``, only pairs of a row
    before it and a row from it on are compared.
    """
    n = len(zero)
    height = max(int(np.ceil(np.log2(max(n, 2)))), 1)
    tree = Tree(row, column, height)
    by_code = share[tree.order]
    empty, total = np.zeros((n, n), np.int64), np.zeros(n * n)
    # All columns under the top quadrants of the rows; one pair of row quadrants, which is split like any other.
    c = np.arange(-(-n_columns >> height))
    a, b = np.zeros_like(c), np.zeros_like(c)
    for level in range(height, -1, -1):
        in_a, at_a = tree.find(level, a, c)
        in_b, at_b = tree.find(level, b, c)
        nothing = ~in_a & ~in_b
        if nothing.any():
            side = ((n - 1) >> level) + 1
            width = np.minimum(1 << level, n_columns - (c[nothing] << level))
            count = np.bincount(a[nothing] * side + b[nothing], weights=width, minlength=side * side).astype(np.int64).reshape(side, side)
            empty += count.repeat(1 << level, 0).repeat(1 << level, 1)[:n, :n]
        a, b, c, in_a, in_b, at_a, at_b = (x[~nothing] for x in (a, b, c, in_a, in_b, at_a, at_b))
        if level:
            step = np.arange(8)
            a, b, c = ((2 * x[:, None] + (step >> k & 1)).ravel() for k, x in enumerate((a, b, c)))
            low = level - 1
            real = (a <= b) & (b << low < n) & (c << low < n_columns)
            if split is not None:
                real &= (a << low < split) & (((b + 1) << low) > split)
            elif not low:
                real &= a < b
            a, b, c = a[real], b[real], c[real]
        else:
            p, q = zero[a].copy(), zero[b].copy()
            p[in_a], q[in_b] = by_code[at_a[in_a]], by_code[at_b[in_b]]
            # Sums of at most 2^53 stay exact as floats: a column adds at most 2 * SCALE + 2.
            total = np.bincount(a * n + b, weights=distance(p, q), minlength=n * n)
    return total.astype(np.int64).reshape(n, n) + empty * distance(zero[:, None], zero[None, :])


def block_report(cells: dict[str, np.ndarray], rows: dict[str, np.ndarray], split: int | None, top: int) -> tuple[list, list]:
    """(row, row, distance) for both directions of every pair, and (row, column, excess) of the terms of each row above its language.

    cells: row, column, n, all_n. rows: whole, terms, all_whole, in_block (columns of the block, those without a cell here included). ``top`` bounds the terms of a row, ties to the smaller column; 0: no terms.
    """
    n, n_columns = len(rows["whole"]), int(rows["in_block"].max(initial=0))
    column, r = cells["column"], cells["row"]
    whole, terms = rows["whole"], rows["terms"]
    share = shares(cells["n"], whole[r], terms[r])
    pairs, words = [], []
    if n > 1:
        zero = shares(np.zeros(n, np.int64), whole, terms)
        d = between(r, column, share, zero, n_columns, split) if n_columns else np.zeros((n, n), np.int64)
        a, b = np.triu_indices(n, 1)
        if split is not None:
            a, b = a[(a < split) & (b >= split)], b[(a < split) & (b >= split)]
        pairs = [np.concatenate((a, b)), np.concatenate((b, a)), np.tile(d[a, b], 2)]
    if top and len(r):
        q = shares(cells["all_n"], rows["all_whole"][r], terms[r])
        over = share > q
        r, column, value = r[over], column[over], distance(share[over], q[over])
        order = np.lexsort((column, -value, r))
        r, column, value = r[order], column[order], value[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        words = [r[place < top], column[place < top], value[place < top]]
    return pairs, words


# ---- the audit


def blocks(cells: DataFrame, groups: DataFrame, columns: int, rows: int) -> DataFrame:
    """Cells, and all sources by name, dealt over (lang, block, i, j): column block and a pair of row blocks, i <= j.

    groups: lang, source, whole, terms, all_whole. A cell goes to as many tasks as its language has row blocks.
    """
    of_lang = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.count(F.lit(1)).alias("sources"))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / columns)).cast("long")
    n_rows = F.greatest(F.lit(1), F.ceil(F.col("sources") / rows)).cast("long")
    of_lang = of_lang.select("lang", n_blocks.alias("_blocks"), n_rows.alias("_rows"))
    whole = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), "whole", "terms", "all_whole")
    headers = whole.join(of_lang, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    of_block = F.pmod(F.xxhash64("term"), "_blocks").alias("block")
    in_block = cells.select("lang", "term").distinct().join(of_lang, "lang").groupBy("lang", of_block).agg(F.count(F.lit(1)).alias("in_block"))
    headers = headers.join(in_block, ["lang", "block"], "left").na.fill(0, ["in_block"])
    inside = cells.join(of_lang, "lang").select(
        "lang", "source", "term", F.col("n").alias("whole"), F.lit(0).cast("long").alias("terms"), F.col("all_n").alias("all_whole"),
        "_blocks", "_rows", of_block, F.lit(0).cast("long").alias("in_block"),
    )
    own = F.pmod(F.xxhash64("source"), "_rows")
    every = headers.select(*inside.columns).union(inside).withColumn("own", own)
    every = every.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)))
    return every.select("lang", "source", "term", "whole", "terms", "all_whole", "in_block", "block", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def audited(dealt: DataFrame, top: int) -> DataFrame:
    """(lang, source, part, item, value) of every task: parts of pair distances, and each task's best terms."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        i, j = key[2].as_py(), key[3].as_py()
        head = t.filter(pc.is_null(t.column("term")))
        body = t.filter(pc.is_valid(t.column("term")))
        # Rows of the first row block, then of the second; columns by term, so a smaller column is a smaller term.
        named = head.sort_by([("own", "ascending"), ("source", "ascending")])
        source = named.column("source").combine_chunks()
        split = None if i == j else int((named.column("own").to_numpy() == i).sum())
        terms = body.column("term").combine_chunks().cast(pa.binary()).unique().sort()
        cells = {
            "row": pc.index_in(body.column("source").combine_chunks(), source).to_numpy(zero_copy_only=False).astype(np.int64),
            "column": pc.index_in(body.column("term").combine_chunks().cast(pa.binary()), terms).to_numpy(zero_copy_only=False).astype(np.int64),
            "n": body.column("whole").to_numpy(),
            "all_n": body.column("all_whole").to_numpy(),
        }
        rows = {k: named.column(k).to_numpy() for k in ("whole", "terms", "all_whole", "in_block")}
        pairs, words = block_report(cells, rows, split, top if i == j else 0)
        out = []
        for part, found, items in (("pair", pairs, source), ("term", words, terms.cast(pa.string()))):
            if found:
                n = len(found[0])
                out.append(pa.table([pa.array([key[0].as_py()] * n, pa.string()), source.take(pa.array(found[0])), pa.array([part] * n, pa.string()), items.take(pa.array(found[1])), pa.array(found[2], pa.int64())], names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], x) for x in kinds], names)

    names, kinds = ["lang", "source", "part", "item", "value"], [pa.string()] * 4 + [pa.int64()]

    return dealt.groupBy("lang", "block", "i", "j").applyInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = IN_DOCUMENTS, top: int = TOP, columns: int = COLUMNS, rows: int = ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: every other source of the group's language and the distance to it, over all kept terms; all ranks. Part ``term``: kept terms
    that the group has and whose share is above that of its language; the first ``top`` ranks. Ranks from 1, by value descending, then
    item by its UTF-8 bytes.

    A null text, language or source counts as an empty one. A group that occurs, if only in texts without terms, is in the report; a language
    without kept terms has distances of 0. Repeated rows count as often as they come. An empty table gives no rows; other columns, whatever
    their names, are not read. Terms are runs of letters A-Z, in lower case, and characters beyond ASCII, of whole texts.
    """
    given = docs.select(*[F.coalesce(common.named(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "t"))])
    cells = common.stored(kept_cells(given, least), "audit-cells")
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    of_lang = cells.groupBy("lang", "term").agg(F.max("all_n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("all_whole"))
    groups = given.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = common.stored(groups.na.fill(0, ["whole", "terms", "all_whole"]), "audit-groups")
    found = common.stored(audited(blocks(cells, groups, columns, rows), top), "audit-blocks")
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.unionByName(terms.select(*pairs.columns))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"))


QUERIES = {"op12_source_divergence": op12_source_divergence}
ORACLES = {
    "op12_source_divergence": r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
sized AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
grps AS (SELECT g.lang, g.source, coalesce(s.v, 0)::HUGEINT AS v, coalesce(c.n, 0)::HUGEINT AS n, coalesce(s.n, 0)::HUGEINT AS all_n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sized s ON s.lang = g.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cells GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (g.all_n + 2 * g.v) AS q
  FROM grps g JOIN kept k ON k.lang = g.lang LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
report AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM report)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 10"""
}
