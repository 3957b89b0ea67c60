"""Phrase collocation mining over count streams kept in prefix and in suffix order.

Phrases are counted order by order. The texts are read once per order; a phrase of m words is counted only
where both phrases of m - 1 words in it are frequent, as no phrase is more frequent than its parts. Whether
they are is asked of a bit sieve of bounded size, which may let a rare phrase pass (its count then says so)
and never stops a frequent one. Each order gives a stream of exact counts (language, phrase, n), written to
the shared folder.

The streams are then laid out twice, by what a phrase begins with and by what it ends with, and merged in
lockstep (sort-merge joins, no hash table is built or probed):

* first and last parts: every cut of a phrase meets the count of its first part in prefix order and that of
  its last part in suffix order;
* extensions: a phrase meets the largest count of the phrases one word longer that begin (or end) with it. A
  longer phrase with enough of the occurrences holds one of these with as many, so one step is enough.

What is shipped to tasks is the sieve, at most ``SIEVE_BITS`` bits; a fuller one lets more rare phrases pass.
A frequent word is summed per pass of text, per task and then per key, so no task sees its occurrences. Rows
in the joins are kinds of phrases, not occurrences. Each order is a job that runs when ``mine`` is called.

* null text: empty; null language: ``und``. Rows count one by one: repeats, and rows without an id, as others.
* an empty table, or one without a frequent phrase, gives an empty result.
* a word of any length is kept whole; memory follows the longest single text, about sixty bytes for a byte of it.
* languages and phrases compare by their bytes; equal scores and counts are ordered by the phrase.
* columns are chosen by name; others are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import counted, join_small, joined, mixed, passes, word_hashes
from larkspur.session import cut_lineage

#: The largest sieve, and the bits of it per frequent phrase as long as it is smaller.
SIEVE_BITS, BITS_PER_PHRASE = 1 << 26, 16
#: Bytes of text of one numpy pass.
BYTES = 4 << 20

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

class Words(NamedTuple):
    """Words of some texts: bytes with one space after each word, where words begin and end, the piece and text of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    text: np.ndarray

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)


def words_of(batch: list[bytes]) -> Words:
    """Pieces and words of texts in lower case (A-Z)."""
    data, text_starts, _ = joined(batch)
    data = _LOWER[data]
    kind = _KIND[data]
    inside = kind == _WORD
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    lengths = last - first
    ends = np.cumsum(lengths + 1) - 1
    # a word's bytes and the sign after it, which becomes the space
    keep = inside.copy()
    keep[last] = True  # every text is closed by a mark, so a sign follows every word
    packed = data[keep]
    packed[ends] = 0x20
    return Words(packed, ends - lengths, ends, counted(kind == _BREAK)[first], np.searchsorted(text_starts, first, side="right") - 1)


def gram_hashes(words: np.ndarray, order: int, salt: np.ndarray) -> np.ndarray:
    """A 64-bit number of the ``order`` words that begin at each word; ``salt`` is that of the language."""
    size = max(len(words) - order + 1, 0)
    out = words[:size] ^ salt[:size]
    for j in range(1, order):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + words[j : size + j])
    return out


def _salts(langs: pa.Array) -> np.ndarray:
    """A number per language name."""
    w = [np.uint64(int.from_bytes(x.encode()[:8].ljust(8, b"\1"), "little") ^ len(x)) for x in langs.to_pylist()]
    return mixed(np.array(w, np.uint64) + np.uint64(0x9E3779B97F4A7C15)) if w else np.zeros(0, np.uint64)


class Sieve(NamedTuple):
    """Bits of the frequent phrases of one order; two bits a phrase."""

    words: np.ndarray
    order: int

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        a = mixed(hashes)
        return a & np.uint64(bits - 1), (a >> np.uint64(32)) & np.uint64(bits - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes, len(self.words) * 64):
            found &= self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1
        return found


def _tally(batch: list[bytes], langs: pa.DictionaryArray, order: int, sieve: Sieve | None) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Language numbers, phrases and exact counts of one pass, and the number of words per language."""
    w = words_of(batch)
    number = langs.indices.to_numpy().astype(np.int64)
    names = len(langs.dictionary)
    lang = number[w.text]
    size = max(len(w.starts) - order + 1, 0)
    at = np.arange(size)
    if order > 1:
        good = w.piece[:size] == w.piece[order - 1 :]
        part = sieve.holds(gram_hashes(w.hashes(), order - 1, _salts(langs.dictionary)[lang]))
        at = at[good & part[:size] & part[1 : size + 1]]
    begin, end = w.starts[at], w.ends[at + order - 1]
    offsets = np.zeros(len(at) + 1, np.int64)
    np.cumsum(end - begin, out=offsets[1:])
    letters = w.data[np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])]
    phrases = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    both, n = np.unique(phrases.indices.to_numpy().astype(np.int64) * names + lang[at], return_counts=True)
    return both % names, phrases.dictionary.take(pa.array(both // names)), n, np.bincount(lang, minlength=names)


_ROW = "lang string, phrase string, n long"
_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _counter(order: int, sieve: Sieve | None) -> Callable:
    """Counts per pass of text; with order 1 also the number of words of a language, beside a null phrase."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            langs, at = rows.column(0), 0
            for batch in passes(rows.column(1), BYTES):
                part = langs.slice(at, len(batch)).dictionary_encode()
                at += len(batch)
                lang, phrases, n, words = _tally(batch, part, order, sieve)
                names = part.dictionary.cast(pa.string())
                yield pa.record_batch([names.take(pa.array(lang)), phrases.cast(pa.string()), pa.array(n, pa.int64())], schema=_ARROW)
                if order == 1:
                    yield pa.record_batch([names, pa.nulls(len(names), pa.string()), pa.array(words, pa.int64())], schema=_ARROW)

    return count


def phrase_counts(docs: DataFrame, order: int, sieve: Sieve | None = None) -> DataFrame:
    """lang, phrase, n of the phrases of ``order`` words whose two longest parts pass the sieve, over all texts.

    With order 1 there is no sieve, and rows with a null phrase hold the number of words of each language.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_counter(order, sieve), _ROW).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def build_sieve(frequent: DataFrame, order: int, count: int) -> Sieve:
    """A sieve of ``count`` frequent phrases (lang, phrase); its bits are set and merged on the executors."""
    bits = 1 << min(max(count * BITS_PER_PHRASE - 1, 4095).bit_length(), SIEVE_BITS.bit_length() - 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            langs, at = rows.column(0), 0
            for batch in passes(rows.column(1), BYTES):
                part = langs.slice(at, len(batch)).dictionary_encode()
                at += len(batch)
                w = words_of(batch)
                salt = _salts(part.dictionary)[part.indices.to_numpy()][w.text]
                first = np.searchsorted(w.text, np.arange(len(batch)))
                found = np.concatenate(Sieve.places(gram_hashes(w.hashes(), order, salt)[first], bits))
                yield pa.record_batch([pa.array(np.unique(found).astype(np.int64))], names=["at"])

    at = frequent.select("lang", "phrase").mapInArrow(places, "at long")
    merged = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("set"))
    table = merged.toArrow()  # bits / 64 rows at most
    out = np.zeros(bits // 64, np.int64)
    out[table["word"].to_numpy()] = table["set"].to_numpy()
    return Sieve(out.view(np.uint64), order)


def count_streams(docs: DataFrame, least: int = 100, longest: int = 5) -> DataFrame:
    """lang, phrase, n, m of every phrase of 1 to ``longest`` words that occurs ``least`` times or more.

    Rows with a null phrase hold the number of all words of a language.
    """
    streams, sieve = [], None
    for order in range(1, longest + 1):
        frequent = F.col("phrase").isNull() | (F.col("n") >= least)
        stream = cut_lineage(phrase_counts(docs, order, sieve).where(frequent), f"phrases-{order}")
        streams.append(stream.withColumn("m", F.lit(order)))
        known = stream.where(F.col("phrase").isNotNull())
        count = known.count()
        if count == 0:
            break
        if order < longest:
            sieve = build_sieve(known, order, count)
    out = streams[0]
    for stream in streams[1:]:
        out = out.unionByName(stream)
    return out


#: floor(1000 * a * n / (l * r)), exact: the products are decimals of up to 38 digits. As a is at most l and r, the
#: quotient is at most 1000 * n / a and fits a long.
SCORE = (
    "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(18,0)))"
    " div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
)


def cuts(streams: DataFrame, phrases: DataFrame) -> DataFrame:
    """The phrases (lang, phrase, a, m) once per cut k, with the counts of the part before (l) and after it (r)."""
    words = F.split("phrase", " ")
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).withColumns(
        {"head": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("m")), " ")}
    )
    known = streams.where(F.col("phrase").isNotNull())
    first = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    last = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    return cut.join(first.hint("merge"), ["lang", "head"]).join(last.hint("merge"), ["lang", "rest"]).drop("head", "rest")


def extensions(streams: DataFrame, by_first: bool) -> DataFrame:
    """lang, phrase and the largest count of a phrase one word longer that begins (else: ends) with it."""
    from_word = 1 if by_first else 2
    part = F.array_join(F.slice(F.split("phrase", " "), F.lit(from_word), F.col("m") - 1), " ")
    longer = streams.where(F.col("phrase").isNotNull() & (F.col("m") > 2)).select("lang", part.alias("phrase"), "n")
    return longer.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def mine(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases of 2 to ``longest`` words that occur ``least`` times or more in pieces between punctuation, less
    those of which a longer one holds ``share`` percent, scored at their weakest cut (the first of equals).
    """
    streams = count_streams(docs, least, longest)
    phrases = streams.where(F.col("phrase").isNotNull() & (F.col("m") > 1)).select("lang", "phrase", F.col("n").alias("a"), "m")
    for by_first in (True, False):
        longer = extensions(streams, by_first).hint("merge")
        phrases = phrases.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).drop("longer")
    sizes = streams.where(F.col("phrase").isNull()).select("lang", "n")
    scored = join_small(cuts(streams, phrases), sizes, ["lang"], "phrase").withColumn("score", F.expr(SCORE))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        weakest.select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
