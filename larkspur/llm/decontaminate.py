"""Benchmark decontamination: passages of a text within a small edit distance of a benchmark item.

Words are the symbols: lower case, white space and punctuation of any script between them; in scripts without
blanks every character is a word. A text holds an item
of L words if some run of its words is at most ``floor((1 - similarity) * L)`` insertions, deletions and
substitutions away from it.

1. Items are grouped into classes of similar length; a window is tried at every word of every text.
2. A run that starts at a window and matches has at most so many words that no item knows, and of an item
   cut into one piece more than the edits allowed it holds a piece unchanged. Windows with more such words,
   or with no piece near, are passed over. These are bounds, so nothing is lost.
3. The CGK embedding walks each window: at step j it writes the current word and moves on if a random bit
   of (j, word) says so. Windows and items a small edit distance apart mostly write the same words. A walk
   moves half a word a step, so it takes two steps for each word of an item.
4. Bit-sampling: each table keys the words written at a few random steps of the whole walk or of one of
   its halves. The number of tables follows from the target recall. Equal keys give candidates (exact copies
   meet in every table).
5. Candidates are verified by the exact edit distance of the item to the best run near the window.

Texts are read once, where they lie, without a shuffle. Items travel in blocks of bounded size; a larger
benchmark takes more passes over the texts.

* null or empty text or item: no words, no match. Null doc_id or item_id: carried as null.
* repeated items give one match each, repeated rows one result each; of equally close runs the first wins.
* empty tables give an empty result. A very long text is read piece by piece; its word numbers (4 bytes
  each) are held together. Extra columns are not looked at, and ``clean`` returns them unchanged.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from larkspur.llm.common import counted, fresh, passes, pieces

SIMILARITY = 0.8
#: Words a key samples, random walks, and the share of steps at which a walk writes the item's word. At the
#: distance limit, edits at the head, the tail or spread, 15 to 100 words, the share was 0.40 to 0.94 on average and
#: 0.18 to 0.33 for the worst item of a hundred at its best window, edits at the head or spread; tests/llm measures the recall that follows.
SAMPLED, WALKS, AGREEMENT, RECALL = 3, 16, 0.25, 0.99
#: Words of a piece of an item that are compared.
PIECE = 5
#: Characters of items that travel with one pass over the texts; a task holds about 25 bytes of index for each, and a kilobyte an item.
BLOCK_CHARS = 16 << 20

_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
# Bytes that begin letters of alphabets only; where any other lead byte stands, the text is read by characters.
_OTHER = re.compile(rb"[\xc2\xcb-\xcf\xd4-\xf4]|\xc3[\x97\xb7]")
#: Scripts written without blanks between words, by code point (fixed values): Thai and Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


class _Signs(dict):
    """What a character becomes between words: itself, a blank, nothing, or a word of its own; filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        kind = unicodedata.category(char)
        if char.isalnum() or kind[0] == "M":
            out = f" {char} " if any(a <= code <= b for a, b in _UNSPACED) else char
        else:
            out = "" if kind == "Cf" else " "
        self[code] = out
        return out


_SIGNS = _Signs()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BINS = 1024
_LOW = np.uint64(0xFFFF)


def tables(recall: float = RECALL, agreement: float = AGREEMENT, sampled: int = SAMPLED) -> int:
    """Tables needed so that a match meets its item in one of them with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sampled))


def split_words(raw: bytes) -> list[bytes]:
    """Words of a text that is in lower case already: letters, digits and marks between white space and signs of any script.

    Characters of scripts without blanks are words of their own; invisible formatting signs are left out.
    """
    if _OTHER.search(raw):
        raw = raw.decode().translate(_SIGNS).encode()
    return raw.translate(_WORDS).split()


def allowed(length: int, similarity: float) -> int:
    return int((1 - similarity) * length + 1e-9)


def _bits(step: int, symbols: np.ndarray) -> np.ndarray:
    """The random bit of (step, word) for each word number (multiply and shift)."""
    odd = (step * 0x9E3779B1 + 0x85EBCA6B) & 0xFFFFFFFF | 1
    add = (step * 0xC2B2AE35 + 0x27D4EB2F) & 0xFFFFFFFF
    return (symbols.view(np.uint32) * np.uint32(odd) + np.uint32(add)) >> np.uint32(31)


def _samples(rng: np.random.Generator, steps: int, count: int) -> list[np.ndarray]:
    """The steps of every table: in turn from the whole walk, its first and its second half, so no part goes without."""
    parts = ((0, steps), (0, steps // 2), (steps // 2, steps))
    chosen = [parts[table // WALKS % len(parts)] for table in range(count)]
    return [np.sort(a + rng.choice(b - a, min(SAMPLED, b - a), replace=False)) for a, b in chosen]


def _grams(symbols: np.ndarray, size: int) -> np.ndarray:
    """A number for the ``size`` words from every place on; equal words give equal numbers."""
    out = np.zeros(max(len(symbols) - size + 1, 0), np.uint64)
    for k in range(size):
        out ^= symbols[k : k + len(out)].astype(np.uint64)
        out *= _ODD
        out ^= out >> np.uint64(29)
    return out


class _Class(NamedTuple):
    """Items of similar length: sampled steps, and per table the keys in order and the items that have them."""

    shortest: int
    longest: int
    samples: list[np.ndarray]
    keyed: list[tuple[np.ndarray, np.ndarray]]
    #: by words in a piece: the numbers of the pieces in order, and for every low end whether some piece has it
    parts: dict[int, tuple[np.ndarray, np.ndarray]]


class Index:
    """The benchmark items of one block, keyed for search. Sizes follow the block, not the texts."""

    def __init__(self, texts: list[bytes], similarity: float = SIMILARITY, recall: float = RECALL, seed: int = 7):
        self.similarity = similarity
        words = [split_words(t) for t in texts]
        self.vocabulary: dict[bytes, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws], np.int64) for ws in words]
        self.unknown = len(self.vocabulary)
        by_class: dict[int, list[int]] = defaultdict(list)
        for i, item in enumerate(self.items):
            if len(item):
                by_class[int(math.log(len(item)) / math.log(1.15))].append(i)
        # For every item which hashed words it has: a bound on what a run can share with it.
        self.has = np.zeros((max(len(self.items), 1), _BINS), bool)
        for i, item in enumerate(self.items):
            self.has[i, item % _BINS] = True
        # Words that no item has stand between texts, so that no walk runs from one into the next.
        self.gap = 2 * max(map(len, self.items), default=0) + 1
        rng = np.random.default_rng(seed)
        self.classes = []
        for _, members in sorted(by_class.items()):
            lengths = [len(self.items[i]) for i in members]
            low, high = min(lengths), max(lengths)
            samples = _samples(rng, 2 * low, tables(recall))
            padded = np.full((len(members), high + self.gap), self.unknown, np.int32)
            for row, i in enumerate(members):
                padded[row, : len(self.items[i])] = self.items[i]
            keyed = []
            for keys in self._keys(padded.ravel(), np.arange(len(members)) * padded.shape[1], samples):
                order = np.argsort(keys, kind="stable")
                keyed.append((keys[order], np.array(members, np.int32)[order]))
            self.classes.append(_Class(low, high, samples, keyed, self._parts(members)))

    def _parts(self, members: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """The pieces of items, one more than the edits allowed: an edit touches one piece at most, so one stays whole."""
        numbers: dict[int, set[int]] = defaultdict(set)
        for i in members:
            item, count = self.items[i], allowed(len(self.items[i]), self.similarity) + 1
            cuts = [len(item) * k // count for k in range(count + 1)]
            for a, b in zip(cuts, cuts[1:]):
                size = min(b - a, PIECE)
                numbers[size].add(int(_grams(item[a : a + size], size)[0]))
        out = {}
        for size, found in numbers.items():
            known = np.array(sorted(found), np.uint64)
            low = np.zeros(1 << 16, bool)
            low[(known & _LOW).astype(np.int64)] = True
            out[size] = known, low
        return out

    def _keys(self, symbols: np.ndarray, at: np.ndarray, samples: list[np.ndarray]) -> list[np.ndarray]:
        """The key of every window in every table: the sampled steps of its CGK walk."""
        keys = [np.zeros(len(at), np.uint64) for _ in samples]
        for walk in range(WALKS):
            wanted: dict[int, list[int]] = defaultdict(list)
            for table in range(walk, len(samples), WALKS):
                for step in samples[table]:
                    wanted[int(step)].append(table)
            place = at.copy()
            for step in range(max(wanted, default=-1) + 1):
                here = symbols[place]
                for table in wanted.get(step, ()):
                    keys[table] ^= here.astype(np.uint64) + np.uint64(step << 40)
                    keys[table] *= _ODD
                    keys[table] ^= keys[table] >> np.uint64(29)
                place += _bits(step * WALKS + walk, here)
        return keys

    def numbers(self, raw: bytes) -> np.ndarray:
        """A text's words as numbers; words that no item has share one."""
        get, unknown = self.vocabulary.get, self.unknown
        parts = [np.array([get(w, unknown) for w in split_words(p)], np.int32) for p in pieces(raw)]
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def search(self, batch: list[bytes]) -> list[dict[int, tuple[int, int, int]]]:
        """For every text its matches: item -> (distance, first word, word after the last)."""
        each = [self.numbers(raw) for raw in batch]
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in batch]
        lengths = np.array([len(e) for e in each], np.int64)
        if not lengths.sum():
            return found
        gap = np.full(self.gap, self.unknown, np.int32)
        symbols = np.concatenate([x for e in each for x in (e, gap)])
        begins = np.cumsum(lengths + self.gap) - lengths - self.gap
        ends = begins + lengths
        foreign = counted(symbols == self.unknown)
        grams = {size: _grams(symbols, size) for size in {n for group in self.classes for n in group.parts}}
        doc, item, at = [], [], []
        for group in self.classes:
            least, most = group.shortest - allowed(group.shortest, self.similarity), allowed(group.longest, self.similarity)
            starts = np.flatnonzero(foreign[least:] - foreign[: len(foreign) - least] <= most)
            owner = np.searchsorted(begins, starts, side="right") - 1
            fits = starts + least <= ends[owner]
            starts, owner = starts[fits], owner[fits]
            whole = np.zeros(len(symbols), bool)
            for size, (known, has_low) in group.parts.items():
                maybe = np.flatnonzero(has_low[(grams[size] & _LOW).astype(np.int64)])
                found_at = np.minimum(np.searchsorted(known, grams[size][maybe]), len(known) - 1)
                whole[maybe[known[found_at] == grams[size][maybe]]] = True
            parts_before = counted(whole)
            first, after = np.maximum(starts - most, 0), np.minimum(starts + group.longest + 2 * most, len(symbols))
            near = parts_before[after] > parts_before[first]
            starts, owner = starts[near], owner[near]
            for low in range(0, len(starts), 1 << 14):
                s, o = starts[low : low + (1 << 14)], owner[low : low + (1 << 14)]
                pairs = [np.zeros(0, np.int64)]
                for keys, (known, members) in zip(self._keys(symbols, s, group.samples), group.keyed):
                    left = np.searchsorted(known, keys)
                    hit = np.flatnonzero(known[np.minimum(left, len(known) - 1)] == keys)
                    left, many = left[hit], np.searchsorted(known, keys[hit], side="right") - left[hit]
                    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    pairs.append(np.repeat(hit, many) * len(self.items) + members[np.repeat(left, many) + nth])
                both = np.unique(np.concatenate(pairs))
                if len(both):
                    w, i = np.divmod(both, len(self.items))
                    w, i = self._near(symbols, s, w, i)
                    doc += o[w].tolist()
                    item += i.tolist()
                    at += s[w].tolist()
        for low in range(0, len(doc), 4096):
            part = slice(low, low + 4096)
            for d, i, hit in zip(doc[part], item[part], self._verify(symbols, begins, ends, doc[part], item[part], at[part])):
                if hit and (i not in found[d] or hit < found[d][i]):
                    found[d][i] = hit
        return found

    def _near(self, symbols: np.ndarray, starts: np.ndarray, w: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that can match: a run of at most L + k words beside the window must have L - k words of the item."""
        sizes = np.array([len(self.items[x]) for x in i.tolist()])
        slack = np.array([allowed(n, self.similarity) for n in sizes.tolist()])
        width = int((sizes + 3 * slack).max())
        kept = np.zeros(len(w), bool)
        for low in range(0, len(w), 1 << 14):
            part = slice(low, low + (1 << 14))
            places = np.clip((starts[w[part]] - slack[part])[:, None] + np.arange(width), 0, len(symbols) - 1)
            words = symbols[places]
            shared = self.has[i[part, None], words % _BINS] & (words != self.unknown)
            sums = np.zeros((len(words), width + 1), np.int32)
            np.cumsum(shared, axis=1, out=sums[:, 1:])
            run = np.minimum(sizes[part] + slack[part], width)[:, None]
            ends = np.minimum(np.arange(width + 1) + run, width)
            kept[part] = (np.take_along_axis(sums, ends, 1) - sums).max(1) >= sizes[part] - slack[part]
        return w[kept], i[kept]

    def _verify(self, symbols, begins, ends, doc, item, at) -> list[tuple[int, int, int] | None]:
        """The closest run to the item near each candidate window, where it is close enough (Sellers' recurrence)."""
        lengths = np.array([len(self.items[i]) for i in item])
        slack = np.array([allowed(n, self.similarity) for n in lengths])
        low = np.maximum(np.array(at) - slack, begins[doc])
        high = np.minimum(np.array(at) + lengths + 2 * slack, ends[doc])
        width, depth, m = int((high - low).max()), int(lengths.max()), len(item)
        places = low[:, None] + np.arange(width)
        text = np.where(places < high[:, None], symbols[np.minimum(places, len(symbols) - 1)], -1)
        words = np.full((m, depth), -2, np.int64)
        for row, i in enumerate(item):
            words[row, : lengths[row]] = self.items[i]
        # Cost and start of the best run that ends before column j, packed in one number so that minima keep both.
        kind, shift = (np.int32, 15) if depth + width < 1 << 15 else (np.int64, 31)
        unit = kind(1 << shift)
        columns = np.arange(width + 1, dtype=kind)
        rise = columns * unit
        text, words = text.astype(kind), words.astype(kind)
        now = np.broadcast_to(columns, (m, width + 1)).copy()
        last = np.zeros_like(now)
        for k in range(depth):
            nxt = np.empty_like(now)
            nxt[:, 0] = (k + 1) * unit
            np.add(now[:, :-1], (text != words[:, k : k + 1]) * unit, out=nxt[:, 1:])
            now += unit
            np.minimum(nxt[:, 1:], now[:, 1:], out=nxt[:, 1:])
            nxt -= rise
            np.minimum.accumulate(nxt, axis=1, out=nxt)
            nxt += rise
            now = nxt
            done = lengths == k + 1
            if done.any():
                last[done] = now[done]
        last[:, 1:][places >= high[:, None]] = np.iinfo(kind).max
        best = last.argmin(1)
        out: list[tuple[int, int, int] | None] = []
        for row in range(m):
            cost, start = divmod(int(last[row, best[row]]), 1 << shift)
            base = int(low[row] - begins[doc[row]])
            out.append((cost, base + start, base + int(best[row])) if cost <= slack[row] else None)
        return out


def _blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[Row]]:
    """The items in blocks of about ``limit`` characters, one block on the driver at a time."""
    size = benchmark.select(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = size // limit + 1
    items = benchmark.select("item_id", "text").where(F.length("text") > 0)
    for b in range(blocks):
        rows = (items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b) if blocks > 1 else items).collect()
        yield sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))


def _lowered(text: str) -> bytes:
    return pc.utf8_lower(pa.scalar(text)).as_py().encode()


def match_column(text: Column, items: list[Row], id_type: DataType, similarity: float = SIMILARITY) -> Column:
    """Matches of one text with a block of items: item_id, distance, words of the item, first and after-last word."""
    raw, ids = [_lowered(r["text"]) for r in items], [r["item_id"] for r in items]
    id_kind = to_arrow_type(id_type)

    @F.arrow_udf(f"array<struct<item_id: {id_type.simpleString()}, distance: int, item_words: int, first_word: int, last_word: int>>")
    def matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(raw, similarity)
        kind = None
        for texts in batches:
            out = []
            for batch in passes(pc.utf8_lower(texts)):
                for found in index.search(batch):
                    out.append(
                        [
                            {"item_id": ids[i], "distance": d, "item_words": len(index.items[i]), "first_word": a, "last_word": b}
                            for i, (d, a, b) in sorted(found.items())
                        ]
                    )
            kind = kind or pa.list_(
                pa.struct(
                    [("item_id", id_kind), *[(n, pa.int32()) for n in ("distance", "item_words", "first_word", "last_word")]]
                )
            )
            yield pa.array(out, kind)

    return matches(text)


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, distance, similarity and the run of words, one row per text and item it holds."""
    id_type = benchmark.schema["item_id"].dataType
    out = None
    for items in _blocks(benchmark):
        found = docs.select("doc_id", F.explode(match_column(F.col("text"), items, id_type, similarity)).alias("m")).select(
            "doc_id",
            "m.item_id",
            "m.distance",
            (1 - F.col("m.distance") / F.col("m.item_words")).alias("similarity"),
            "m.first_word",
            "m.last_word",
        )
        out = found if out is None else out.unionAll(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no benchmark item, with their columns as they are."""
    id_type = benchmark.schema["item_id"].dataType
    kept = docs
    for items in _blocks(benchmark):
        flag = fresh(kept, "_held")
        kept = kept.withColumn(flag, F.size(match_column(F.col("text"), items, id_type, similarity))).where(F.col(flag) == 0).drop(flag)
    return kept
