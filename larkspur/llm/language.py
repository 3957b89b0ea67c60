"""Language identification by the nearest centroid.

A text becomes the normalised TF-IDF vector of its letter n-grams (one to three letters, with the word's
edges, hashed to ``DIMS`` places). Each language has several centroids, found by spherical k-means; the
text gets the language of the centroid with the largest cosine. A text whose cosine lies below what the
texts of that language reach is marked ``rejected``: its language is a guess, and its score is halved.

Fitted on a bounded sample of documents with a language outside the held-out fold: equal shares of
``SAMPLE_ROWS`` for the languages, ``SAMPLE_LEAST`` rows of each at least, so a rare language is learned like a
common one. Whole texts are classified, where they lie, without a shuffle.

* null text, empty text, or one without a letter: ``und`` with score 0. Null languages are not learned from.
* null doc_id: not learned from, classified like any other; repeated rows each on its own.
* an empty table gives an empty result; if no language is known, every text is ``und`` with score 0.
* a very long text is read piece by piece: the memory is that of its counts. Columns go by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import held_out, learnable

#: For fitting only: rows of all languages, rows of a language at least (twice as many at most), characters of a row.
SAMPLE_ROWS, SAMPLE_LEAST, SAMPLE_CHARS = 2000, 300, 20_000
FOLDS, HELD_OUT_FOLD = 5, 0
DIMS = 1 << 13
CENTROIDS = 4
#: Share of a language's own sample texts that lie below its rejection distance.
REJECTED = 0.002
PIECE = 1 << 20

_MIX = np.uint32(0x9E3779B1)


def _letters() -> np.ndarray:
    """For every code point of the basic plane whether it is a letter."""
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(1 << 16)), np.uint8).astype(bool)


_LETTER: np.ndarray | None = None


def _points(text: str) -> np.ndarray:
    """Code points of a lower-case text with everything but letters as 0, edges included."""
    global _LETTER
    if _LETTER is None:
        _LETTER = _letters()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.zeros(len(points) + 2, np.uint32)
    letter = _LETTER[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        letter[high] = [chr(p).isalpha() for p in points[high].tolist()]
    out[1:-1] = np.where(letter, points, 0)
    return out


def _hashed(values: np.ndarray) -> np.ndarray:
    return (values * _MIX) >> np.uint32(32 - DIMS.bit_length() + 1)


def counts(text: str) -> np.ndarray | None:
    """N-grams per hashed place; None without a letter. ``text`` is in lower case."""
    total = np.zeros(DIMS, np.int64)
    any_letter = False
    for at in range(0, max(len(text), 1), PIECE):
        # one more character on either side: every n-gram is counted at its middle letter, in one piece
        p = _points(text[max(at - 1, 0) : at + PIECE + 1])
        p = p[1 if at else 0 : len(p) - (1 if at + PIECE < len(text) else 0)]
        if not p[1:-1].any():
            continue
        any_letter = True
        a, b, c = p[:-2], p[1:-1], p[2:]
        pair = (a * np.uint32(31) + b) * np.uint32(0x85EBCA6B) + np.uint32(1)
        triple = (pair ^ (c + np.uint32(7))) * np.uint32(0xC2B2AE35) + np.uint32(2)
        total += np.bincount(_hashed(b[b > 0]), minlength=DIMS)
        total += np.bincount(_hashed(pair[(a > 0) | (b > 0)]), minlength=DIMS)
        total += np.bincount(_hashed(triple[b > 0]), minlength=DIMS)
    return total if any_letter else None


class Model(NamedTuple):
    languages: tuple[str, ...]
    idf: np.ndarray
    #: centroid vectors (rows) and the language of each
    centroids: np.ndarray
    owner: np.ndarray
    #: least cosine per language
    floor: np.ndarray

    def vector(self, n: np.ndarray) -> np.ndarray:
        v = n * self.idf
        return v / max(np.linalg.norm(v), 1e-12)

    def best(self, n: np.ndarray) -> tuple[int, float, float]:
        """Language, cosine, and probability among the languages."""
        cosines = self.centroids @ self.vector(n)
        by_language = np.full(len(self.languages), -1.0)
        np.maximum.at(by_language, self.owner, cosines)
        at = int(by_language.argmax())
        odds = np.exp(20 * (by_language - by_language[at]))
        return at, float(by_language[at]), float(odds[at] / odds.sum())


def _clusters(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means from the texts farthest from one another; unit rows."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(rounds):
        owner = (x @ centres.T).argmax(1)
        sums = np.stack([x[owner == i].sum(0) if (owner == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(rows: list[tuple[str, str]], centroids: int = CENTROIDS) -> Model:
    """A model from (text, language) rows. Equal rows in equal order give equal models."""
    texts = pc.utf8_lower(pa.array([text for text, _ in rows], pa.large_string())).to_pylist()
    found = [(n.astype(np.float32), lang) for text, (_, lang) in zip(texts, rows) if (n := counts(text)) is not None]
    languages = tuple(sorted({lang for _, lang in found}))
    if not found:
        return Model((), np.zeros(DIMS), np.zeros((0, DIMS)), np.zeros(0, np.int64), np.zeros(0))
    x = np.stack([f[0] for f in found])
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    y = np.array([languages.index(lang) for _, lang in found])
    parts = [_clusters(x[y == k], centroids) for k in range(len(languages))]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    floor = np.array([np.quantile((x[y == k] @ parts[k].T).max(1), REJECTED) for k in range(len(parts))])
    return Model(languages, idf, np.vstack(parts), owner, floor)


def learned(docs: DataFrame) -> Model:
    """A model from a sample with a share of its own for every language, so that a rare one is learned too."""
    known = docs.where(F.col("lang").isNotNull() & learnable(F.col("doc_id"), FOLDS, HELD_OUT_FOLD)).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return fit([])
    each = max(SAMPLE_ROWS // len(sizes), SAMPLE_LEAST)
    marks = [F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, each / n) * (1 << 30)))]
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    sample = known.where(place < F.create_map(*marks)[F.col("lang")]).limit(2 * each * len(sizes))
    rows = sample.select(F.substring("text", 1, SAMPLE_CHARS).alias("text"), "lang").where(F.col("text").isNotNull()).collect()
    return fit(sorted((r["text"], r["lang"]) for r in rows))


def predict_column(text: Column, model: Model) -> Column:
    """lang_pred, score and rejected of a text."""

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            lang, score, rejected = [], [], []
            for value in pc.utf8_lower(texts):
                n = counts(value.as_py() or "")
                if n is None or not model.languages:
                    at, p, far = None, 0.0, True
                else:
                    at, cosine, p = model.best(n)
                    far = cosine < model.floor[at]
                lang.append("und" if at is None else model.languages[at])
                score.append(p / 2 if far else p)
                rejected.append(bool(far))
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["lang_pred", "score", "rejected"],
            )

    return predicted(text)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document."""
    done = docs.select("doc_id", predict_column(F.col("text"), model or learned(docs)).alias("p"))
    return done.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"), "p.lang_pred", "p.score", "p.rejected")
