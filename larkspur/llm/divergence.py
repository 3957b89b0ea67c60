"""Source divergence audit by one-hot level products.

How far the word use of two sources of a language differs is a sum over the language's terms of a price that
depends on nothing but how often each source has the term. So the sum needs no list of terms: the joint table
of the two sources, how many terms have this count here and that count there, is enough. All joint tables of
all pairs are one matrix product: a row per term, an indicator column per (source, count level), and the
transpose of the matrix times the matrix.

The matrix is cut into blocks of rows with at most ``COLUMNS`` columns (a term with more levels than that is
cut by columns), multiplied in float32, which is exact as no entry passes ``ROWS``. Terms come sorted by how
often they occur, so a block has few levels. Level zero is not stored: what is not in a joint table follows
from the margins, which are the diagonal of the product. Blocks are priced by column expressions and summed
per pair of sources, so no table of levels is shuffled; ``joint_tables`` gives the tables themselves.

Counts are made per pass of text, per task, then per (language, source, term); a term's row holds a count per
source that has it, so nothing grows with the occurrences of a hot term or with the documents of a hot
source. Joins with the table of sources are broadcast by measured size only.

* null text, language or source: the empty string. Rows count one by one, whatever their id.
* a group without terms, or a language without kept terms, still has its pairs (value 0 without kept terms).
* an empty table gives an empty result; a source alone in its language has no pairs.
* terms of any length are kept whole; memory follows the longest single text, about fifty bytes for a byte of it.
* ties in value are ordered by the item's bytes. Columns are chosen by name; others are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import join_small, joined, passes
from larkspur.session import cut_lineage

#: Columns and rows of a block of the matrix; entries of a product are at most ROWS, which float32 holds exactly.
COLUMNS, ROWS = 1024, 8192
#: Matrix entries that a task gathers before it cuts blocks, and bytes of text of one pass.
ENTRIES, BYTES = 1 << 17, 4 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _tally(batch: list[bytes], group: np.ndarray, groups: int) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents of every (group, term) of one pass."""
    data, text_starts, _ = joined(batch)
    data = _LOWER[data]
    inside = _LETTER[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    doc = np.searchsorted(text_starts, first, side="right") - 1
    offsets = np.zeros(len(first) + 1, np.int64)
    np.cumsum(last - first, out=offsets[1:])
    terms = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    pair, n = np.unique(terms.indices.to_numpy().astype(np.int64) * len(batch) + doc, return_counts=True)
    both, at, docs = np.unique(pair // len(batch) * groups + group[pair % len(batch)], return_inverse=True, return_counts=True)
    total = np.bincount(at, n, len(both)).astype(np.int64)
    return both % groups, terms.dictionary.take(pa.array(both // groups)), total, docs


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        langs, sources = (rows.column(i).dictionary_encode() for i in (0, 1))
        width = max(len(sources.dictionary), 1)
        pairs, number = np.unique(langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy(), return_inverse=True)
        lang, source = langs.dictionary.take(pa.array(pairs // width)).cast(pa.string()), sources.dictionary.take(pa.array(pairs % width)).cast(pa.string())
        at = 0
        for batch in passes(rows.column(2), BYTES):
            group, terms, n, docs = _tally(batch, number[at : at + len(batch)], len(pairs))
            at += len(batch)
            where = pa.array(group)
            yield pa.record_batch([lang.take(where), source.take(where), terms.cast(pa.string()), pa.array(n), pa.array(docs, pa.int64())], schema=_COUNTS)
        none = pa.array(np.zeros(len(pairs), np.int64))
        yield pa.record_batch([lang, source, pa.nulls(len(pairs), pa.string()), none, none], schema=_COUNTS)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs of every term; a null term stands for the group itself."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kind = "lang string, source string, term string, n long, docs long"
    return texts.mapInArrow(_count, kind).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, size: str, kinds: str) -> Column:
    """1 + floor(10^9 * (n + 2) / (size + 2 * kinds)), exact; null without kinds."""
    over = f"CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(19,0))"
    return F.expr(f"CASE WHEN {kinds} > 0 THEN 1 + ({over}) div CAST({size} + 2 * {kinds} AS DECIMAL(19,0)) END")


def price(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 1.1 * 10^9, so the square fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


class Audit:
    """Kept terms, groups and levels of a table of documents; written once and read by every part of the audit."""

    def __init__(self, docs: DataFrame, least_docs: int = 10):
        counts = cut_lineage(term_counts(docs), "term-counts")
        per_term = (
            counts.where(F.col("term").isNotNull())
            .groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("levels"))
            .where(F.col("docs") >= least_docs)
            .drop("docs")
        )
        #: lang, term, total and levels (source, n) of the kept terms
        self.terms = cut_lineage(per_term, "kept-terms")
        flat = self.terms.select("lang", "term", "total", F.inline("levels"))
        langs = self.terms.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_size"))
        sizes = flat.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("present"))
        groups = counts.where(F.col("term").isNull()).select("lang", "source")
        groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
        #: lang, source, size, present (kept terms it has), kinds and lang_size of its language, share of an absent term
        self.groups = cut_lineage(groups.withColumn("none", share("0L", "size", "kinds")), "groups")
        #: lang, term, total, source, n, p and p of an absent term
        self.levels = (
            join_small(flat, self.groups, ["lang", "source"], "term")
            .withColumn("p", share("n", "size", "kinds"))
            .select("lang", "term", "total", "source", "n", "p", "none", "kinds", "lang_size")
        )

    def blocks(self) -> DataFrame:
        """Joint tables of blocks of terms: lang, source_a, n_a, p_a, none_a, the same with _b, and the number of terms.

        source_a is before source_b; rows with the source itself on both sides are its margins.
        """
        entries = self.levels.select("lang", "total", "term", "source", "n", "p", "none")
        sorted_ = entries.repartition(F.col("lang"), F.col("term")).sortWithinPartitions("lang", "total", "term")
        side = "source_{0} string, n_{0} long, p_{0} long, none_{0} long"
        return sorted_.mapInArrow(_products, f"lang string, {side.format('a')}, {side.format('b')}, terms long")

    def joint_tables(self) -> DataFrame:
        """How many terms have count n_a in source_a and n_b in source_b, both above zero, for all pairs in a language."""
        keys = ["lang", "source_a", "n_a", "source_b", "n_b"]
        return self.blocks().where("source_a <> source_b").groupBy(keys).agg(F.sum("terms").alias("terms"))

    def pairs(self) -> DataFrame:
        """lang, source, item (another source) and value: the price summed over all kept terms."""
        blocks = cut_lineage(_priced(self.blocks()), "priced-blocks")
        inner = blocks.where("source_a <> source_b").select("lang", F.col("source_a").alias("x"), F.col("source_b").alias("y"), F.col("value").alias("inner"))
        margins = blocks.where("source_a = source_b").select("lang", F.col("source_a").alias("x"), "p_a", "terms")
        other = self.groups.select("lang", F.col("source").alias("y"), F.col("none").alias("none_y"))
        alone = (
            join_small(margins, other, ["lang"], "p_a")
            .where("x <> y")
            .groupBy("lang", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
            .agg(F.sum(F.col("terms") * price("p_a", "none_y")).alias("alone"))
        )
        one, two = (
            self.groups.select("lang", "kinds", F.col("source").alias(c), F.col("none").alias(f"none_{c}"), F.col("present").alias(f"present_{c}"))
            for c in ("x", "y")
        )
        absent = F.expr("kinds - present_x - present_y") * price("none_x", "none_y")
        both = join_small(one, two.drop("kinds"), ["lang"], "x").where("x < y").join(inner, ["lang", "x", "y"], "left").join(alone, ["lang", "x", "y"], "left")
        value = F.coalesce(absent, F.lit(0)) + F.coalesce("inner", F.lit(0)) + F.coalesce("alone", F.lit(0))
        ways = F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item")))
        return both.select("lang", F.inline(ways), value.alias("value"))

    def words(self, top: int = 10) -> DataFrame:
        """lang, source, item (a term the source has more of than its language), value and rank, to ``top``."""
        found = self.levels.withColumn("q", share("total", "lang_size", "kinds")).where("p > q")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return (
            found.select("lang", "source", F.col("term").alias("item"), price("p", "q").alias("value"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top)
        )


def _priced(blocks: DataFrame) -> DataFrame:
    """Blocks summed: the inner part of each pair of sources (value), and the margins of each source (p_a, terms)."""
    gain = price("p_a", "p_b") - price("p_a", "none_b") - price("none_a", "p_b") + price("none_a", "none_b")
    same = F.col("source_a") == F.col("source_b")
    level = F.when(same, F.col("p_a"))
    value = F.when(~same, F.col("terms") * gain)
    return blocks.groupBy("lang", "source_a", "source_b", level.alias("p_a")).agg(F.sum(value).alias("value"), F.sum("terms").alias("terms"))


def products(row: np.ndarray, column: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries above and on the diagonal of the product of a 0/1 matrix's transpose with it, from its ones.

    ``row`` is sorted. Rows are halved until a block has few enough columns; a single row is cut by columns.
    """
    out = []
    open_ = [(0, len(row))]
    while open_:
        a, b = open_.pop()
        used, place = np.unique(column[a:b], return_inverse=True)
        rows = row[b - 1] - row[a] + 1 if b > a else 0
        if rows > 1 and (len(used) > COLUMNS or rows > ROWS):
            middle = int(np.searchsorted(row, row[a] + (rows + 1) // 2))
            open_ += [(a, middle), (middle, b)]
            continue
        for i in range(0, len(used), COLUMNS):
            left = _dense(row[a:b], place, i, rows)
            for j in range(i, len(used), COLUMNS):
                table = left.T @ (left if i == j else _dense(row[a:b], place, j, rows))
                x, y = np.nonzero(np.triu(table) if i == j else table)
                out.append((used[i + x], used[j + y], table[x, y].astype(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(part) for part in zip(*out))


def _dense(row: np.ndarray, place: np.ndarray, first: int, rows: int) -> np.ndarray:
    mine = (place >= first) & (place < first + COLUMNS)
    block = np.zeros((rows, int(min(COLUMNS, place.max() + 1 - first))), np.float32)
    block[row[mine] - row[0], place[mine] - first] = 1
    return block


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the rows of one partition, which holds every entry of its terms, sorted by term."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= ENTRIES:
            table = pa.Table.from_batches(waiting).combine_chunks()
            new = _new_term(table)
            cut = int(np.flatnonzero(new)[-1])
            if cut:
                yield from _of_table(table.slice(0, cut))
                waiting = table.slice(cut).to_batches()
                size = table.num_rows - cut
    if size:
        yield from _of_table(pa.Table.from_batches(waiting).combine_chunks())


def _new_term(table: pa.Table) -> np.ndarray:
    """Whether a row begins a term."""
    new = np.ones(table.num_rows, bool)
    codes = [table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "term")]
    new[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0)
    return new


def _of_table(table: pa.Table) -> Iterator[pa.RecordBatch]:
    langs = table.column("lang").combine_chunks().dictionary_encode()
    row = np.cumsum(_new_term(table)) - 1
    number = langs.indices.to_numpy()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        a, b = int(np.searchsorted(number, k)), int(np.searchsorted(number, k, side="right"))  # numbered as they come
        part = table.slice(a, b - a)
        names, source = np.unique(np.array(part.column("source").to_pylist(), object), return_inverse=True)
        n, p, none = (part.column(c).to_numpy() for c in ("n", "p", "none"))
        levels, level = np.unique(n, return_inverse=True)
        keys, first, column = np.unique(source * len(levels) + level, return_index=True, return_inverse=True)
        x, y, terms = products(row[a:b], column, len(keys))
        sides = []
        for at in (first[x], first[y]):
            sides += [pa.array(names[source[at]], pa.string()), pa.array(n[at]), pa.array(p[at]), pa.array(none[at])]
        columns = [pa.array([lang] * len(x), pa.string()), *sides, pa.array(terms)]
        fields = [f"{c}_{s}" for s in "ab" for c in ("source", "n", "p", "none")]
        yield pa.record_batch(columns, names=["lang", *fields, "terms"])


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources by divergence, and the terms a source has most beyond its language."""
    built = Audit(docs, least_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = built.pairs().withColumn("rank", F.row_number().over(order))
    words = cut_lineage(built.words(top), "divergent-words")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(words.withColumn("part", F.lit("term")).select(columns))
