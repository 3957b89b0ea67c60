"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad from counts of its characters and words and from the same
counts of the lines before and after it. Forward-backward gives each line's probability of being good;
their mean, weighted by the lines' lengths, is the document's quality, which a logistic curve maps to the
label probability.

Fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``) that may be learned from; a line takes its
document's label. Scores use the text and nothing else, and every text is scored as a whole.

* null text: empty. A text without a line with a word has quality 0 and thus the lowest score.
* null labels are not learned from; a doc_id with several labels counts once for each.
* null doc_id and repeated rows: scored on their own. An empty table gives an empty result; without labels
  the score is one half for every text.
* a very long text is scored in one piece, about fifty bytes of memory per byte. Columns go by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm import chains
from larkspur.llm.common import bounded_sample, counted, held_out, joined, learnable, logistic, passes, sigmoid, word_hashes

#: Labelled rows (twice as many at most) and characters of a row, for fitting only.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 50_000
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.7

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>{}[]\\^~_=+@", np.uint8)] = True
_END = np.zeros(256, bool)
_END[np.frombuffer(b".!?\"'", np.uint8)] = True


def lines(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with a word, its length in bytes without white space, and the lines of each text."""
    data, starts, _ = joined(batch)
    breaks = np.flatnonzero(data == 10)
    begin = np.append(0, breaks[:-1] + 1)
    space = _SPACE[data]

    def per_line(flags: np.ndarray) -> np.ndarray:
        sums = counted(flags)
        return sums[breaks] - sums[begin]

    size = per_line(~space)
    kept = size > 0
    upper, lower, digit = per_line(_UPPER[data]), per_line(_LOWER[data]), per_line(_DIGIT[data])
    symbol, shout, high = per_line(_SYMBOL[data]), per_line(data == 33), per_line(data >= 128)
    # Words, and words that equal the one before or the one two before.
    edge = np.zeros(len(data) + 1, np.int8)
    edge[1:] = ~space
    step = np.diff(edge)
    word_at = np.flatnonzero(step == 1)
    # every text ends with a line break, so each word has an end
    word_size = np.flatnonzero(step == -1) - word_at
    words = np.bincount(np.searchsorted(breaks, word_at), minlength=len(breaks))
    keys = word_hashes(data, word_at, word_at + word_size)
    again, of = np.zeros(len(keys), bool), np.searchsorted(starts, word_at, side="right")
    again[1:] = (keys[1:] == keys[:-1]) & (of[1:] == of[:-1])
    again[2:] |= (keys[2:] == keys[:-2]) & (of[2:] == of[:-2])
    repeats = np.bincount(np.searchsorted(breaks, word_at[again]), minlength=len(breaks))
    last = np.zeros(len(breaks), np.uint8)
    last_word = np.searchsorted(word_at, breaks) - 1
    has = last_word >= 0
    last[has] = data[(word_at + word_size - 1)[last_word[has]]]
    owner = np.searchsorted(starts, begin, side="right") - 1

    begin, breaks, size, owner, words = begin[kept], breaks[kept], size[kept], owner[kept], words[kept]
    raw = data.tobytes()
    seen: set[tuple[int, bytes]] = set()
    double = np.zeros(len(begin), bool)
    for i, (d, a, b) in enumerate(zip(owner.tolist(), begin.tolist(), breaks.tolist())):
        mark = (d, raw[a:b])
        double[i] = mark in seen
        seen.add(mark)
    per = np.maximum(size, 1)
    letters = np.maximum((upper + lower + high)[kept], 1)
    by_word = np.maximum(words, 1)
    symbols, shouts = symbol[kept] / by_word, shout[kept] / by_word
    capitals, again_share, mean = upper[kept] / letters, repeats[kept] / by_word, per / by_word
    own = np.stack(
        [
            words < 4, words < 12, words > 60, words > 300,
            symbols > 0.02, symbols > 0.1, symbols > 0.5, shouts > 0.1, shouts > 0.5,
            capitals > 0.2, capitals > 0.5, digit[kept] / per > 0.2,
            mean < 3, mean > 9, mean > 15, again_share > 0.1, again_share > 0.4,
            _END[last[kept]], double, np.minimum(size, 1) * (symbols == 0),
        ],
        1,
    ).astype(np.float32)
    same_before = np.append(False, owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, bool)
    same_after = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[~same_before], after[~same_after] = 0, 0
    alone = np.stack([~same_before, ~same_after, np.ones(len(owner), bool)], 1).astype(np.float32)
    return np.hstack([own, before, after, alone]), size, np.bincount(owner, minlength=len(batch))


class Model(NamedTuple):
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    curve: np.ndarray


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def qualities(batch: list[bytes], model: Model) -> np.ndarray:
    """Length-weighted mean over the lines of the probability that a line is good; 0 without lines."""
    x, size, count = lines(batch)
    good = chains.marginals(x @ model.weights, count, model.trans, model.start)[:, 1]
    owner = np.repeat(np.arange(len(batch)), count)
    return np.bincount(owner, good * size, len(batch)) / np.maximum(np.bincount(owner, size, len(batch)), 1)


def scores(batch: list[bytes], model: Model) -> np.ndarray:
    return sigmoid(_log_odds(qualities(batch, model)) * model.curve[0] + model.curve[1])


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """The random field on three quarters of the rows, the curve on the rest; without rows scores are one half."""
    x0, *_ = lines([b""])
    flat = Model(np.zeros((x0.shape[1], 2)), np.zeros((2, 2)), np.zeros(2), np.zeros(2))
    if not texts:
        return flat
    rest = np.arange(len(texts)) % 4 == 3 if len(texts) >= 40 else np.ones(len(texts), bool)
    use = ~rest if len(texts) >= 40 else rest
    x, _, count = lines([t for t, u in zip(texts, use) if u])
    weights, trans, start = chains.fit(x, np.repeat(labels[use], count), count, 2, rounds=100)
    model = Model(weights, trans, start, flat.curve)
    q = qualities([t for t, r in zip(texts, rest) if r], model)
    curve = logistic(_log_odds(q)[:, None], labels[rest], l2=1e-2)
    return model._replace(curve=curve)


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int, fold: int) -> list[tuple[bytes, int]]:
    """A bounded sample of texts with their labels, outside the held-out fold. Texts stay where they lie: the sampled ids are sent to them."""
    known = labels.where(F.col(label).isNotNull() & learnable(F.col("doc_id"), folds, fold)).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = bounded_sample(known, "doc_id", rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.length("text") <= SAMPLE_CHARS).limit(2 * rows).collect()
    return sorted((r["text"].encode(), r["label"]) for r in found)


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled(docs, labels, "quality", SAMPLE_ROWS, FOLDS, HELD_OUT_FOLD)
    order = np.random.default_rng(3).permutation(len(rows))
    return fit([rows[i][0] for i in order], np.array([rows[i][1] for i in order], np.int64))


def score_column(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [scores(batch, model) for batch in passes(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted of every document."""
    scored = docs.select("doc_id", score_column(F.col("text"), model or learned(docs, labels)).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
