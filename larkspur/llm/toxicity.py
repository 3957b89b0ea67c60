"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches.

A text is folded first: lower case, look-alike letters of other scripts, accents and full-width forms
to plain letters, and digits or signs that stand for letters inside words (``1d10t``, ``tr@sh``). One pass
of the automaton then finds every lexicon word that stands alone and every exception phrase; words inside
an exception phrase do not count. The sum of the weights, normalised by the length of the text, goes
through a logistic curve.

The lexicon starts from a short general list. Labelled rows outside the held-out fold, at most twice
``SAMPLE_ROWS``, add the words whose share in toxic texts is far above the one in others, and the phrases
around a lexicon word that occur mostly in harmless texts; a word counts once per set of neighbours, so
copies of one text do not make its words toxic. The lexicon is data of bounded size; texts are scored
whole, where they lie, without a shuffle.

* null or empty text: no matches; the score of a text without matches. Null doc_id, repeated rows: each
  row on its own. Null labels are not learned from. An empty table gives an empty result; without labels the
  general list and a fixed curve remain.
* a very long text is folded and scanned in overlapping pieces, with the result of the whole. Columns go by name.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import held_out, logistic, sigmoid
from larkspur.llm.quality_crf import labelled

SAMPLE_ROWS = 3000
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.3
#: Characters of a text that are folded and scanned at once.
PIECE = 1 << 18

#: General lexicon with weights (folded, in the languages of the corpus; fixed values), and phrases in which its words are harmless.
GENERAL = {
    "idiot": 2.0, "idiots": 2.0, "moron": 2.5, "morons": 2.5, "imbecile": 2.5, "stupid": 2.0, "dumb": 1.5, "loser": 2.0, "losers": 2.0,
    "scum": 2.5, "scumbag": 3.0, "trash": 1.5, "garbage": 1.0, "worthless": 2.0, "pathetic": 2.0, "disgusting": 2.0, "clown": 1.5, "clowns": 1.5,
    "vermin": 2.5, "filth": 2.0, "filthy": 1.5, "freak": 1.5, "pig": 1.0, "bastard": 3.0, "bitch": 3.0, "asshole": 3.0, "shit": 2.0, "fuck": 3.0,
    "fucking": 3.0, "crap": 1.5, "retard": 3.0, "whore": 3.0, "slut": 3.0, "dickhead": 3.0, "jerk": 1.5, "degenerate": 2.0, "parasite": 1.5, "hate": 1.0,
    "dummkopf": 2.0, "trottel": 2.0, "arschloch": 3.0, "scheiße": 2.0, "scheisse": 2.0, "hurensohn": 3.0, "wichser": 3.0, "abschaum": 2.5, "vollidiot": 2.5, "schlampe": 3.0,
    "connard": 3.0, "connasse": 3.0, "salope": 3.0, "merde": 2.0, "abruti": 2.0, "cretin": 2.0, "encule": 3.0, "batard": 2.5, "pute": 3.0, "ordure": 1.5,
    "idiota": 2.0, "idiotas": 2.0, "imbecil": 2.5, "estupido": 2.0, "estupida": 2.0, "gilipollas": 3.0, "cabron": 3.0, "puta": 3.0, "mierda": 2.0, "escoria": 2.5, "pendejo": 2.5,
}
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash collection", "trash bag", "garbage collector", "garbage collection", "garbage truck", "clown fish",
    "circus clown", "pond scum", "soap scum", "guinea pig", "pig iron", "hate crime law", "rocket scientist not idiot", "stupid mistake of mine",
    "dumb terminal", "dumb waiter", "jerk chicken", "sore loser rule", "control freak accident", "parasite infection", "host parasite",
)

#: Letters of other scripts that look like plain ones (fixed values).
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m",
    "т": "t", "в": "b", "н": "h", "г": "r", "ո": "n", "ս": "u", "օ": "o", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "γ": "y", "η": "n", "ω": "w", "σ": "o", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɡ": "g", "ɑ": "a", "ƅ": "b", "ɩ": "i",
}
#: Digits and signs that stand for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}
# One of them beside a letter on either side, inside a word.
_STAND_IN = re.compile(r"(?<=[a-z])[0-9@$!|]+(?=[a-z])|(?<![0-9a-z@$!|])[0-9@$]+(?=[a-z])|(?<=[a-z])[013457]+(?![0-9a-z@$!|.:,])")
_ZERO_WIDTH = dict.fromkeys(map(ord, "\u200b\u200c\u200d\u2060\ufeff\u00ad"))


class _Fold(dict):
    """Character table for ``str.translate``: filled from look-alikes and Unicode decompositions as characters turn up."""

    def __missing__(self, code: int):
        char = chr(code)
        plain = LOOK_ALIKES.get(char)
        if plain is None:
            parts = unicodedata.normalize("NFKD", char)
            plain = "".join(LOOK_ALIKES.get(c, c) for c in parts.lower() if not unicodedata.combining(c)) or (char if len(parts) == 1 and not unicodedata.combining(char) else "")
        self[code] = plain
        return plain


_FOLD = _Fold(_ZERO_WIDTH)


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    return _STAND_IN.sub(lambda m: "".join(STAND_INS.get(c, c) for c in m[0]), text)


class Lexicon(NamedTuple):
    words: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]


def automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, weight in lexicon.words.items():
        found.add_word(word, (len(word), weight))
    for phrase in lexicon.exceptions:
        found.add_word(phrase, (len(phrase), None))
    found.make_automaton()
    return found


def _pieces(text: str) -> Iterator[str]:
    """Pieces cut before white space, so that no word is split and each is folded as within the whole."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(" ", at + 1, at + PIECE), text.rfind("\n", at + 1, at + PIECE))
        if cut <= at:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def _weights(folded: str, found: ahocorasick.Automaton, first: int, last: int) -> list[float]:
    """Weights of the words that begin at ``first`` or later and before ``last``, stand alone and in no exception phrase."""
    spans, phrases = [], []
    for end, (size, weight) in found.iter(folded):
        start = end - size + 1
        if (start and folded[start - 1].isalpha()) or (end + 1 < len(folded) and folded[end + 1].isalpha()):
            continue
        if weight is None:
            phrases.append((start, end))
        elif first <= start < last:
            spans.append((start, end, weight))
    if not phrases:
        return [w for _, _, w in spans]
    phrases.sort()
    starts = [a for a, _ in phrases]
    reach = list(accumulate((b for _, b in phrases), max))  # the farthest end of the phrases so far
    return [w for a, b, w in spans if not (k := bisect_right(starts, a)) or reach[k - 1] < b]


def matches(text: str, found: ahocorasick.Automaton) -> tuple[float, int, int]:
    """Summed weight, number of matched words, number of words of a text.

    A long text is read in pieces; each begins with the end of the one before, so that a phrase is seen
    whole wherever a cut falls, and a word is counted in the piece in which all that may cover it is seen.
    """
    if len(text) <= PIECE:
        folded = fold(text)
        weights = _weights(folded, found, 0, len(folded))
        return math.fsum(weights), len(weights), len(folded.split())
    longest = found.get_stats()["longest_word"] + 1 if len(found) else 0
    weights = []
    words, kept, done = 0, "", 0
    pieces = _pieces(text)
    piece = next(pieces)
    while piece is not None:
        following = next(pieces, None)
        folded = fold(piece)
        words += len(folded.split())
        folded = kept + folded
        last = max(len(folded) - longest, done) if following is not None else len(folded)
        weights += _weights(folded, found, done, last)
        cut = max(last - longest, 0)
        kept, done, piece = folded[cut:], last - cut, following
    return math.fsum(weights), len(weights), words


def measures(text: str, found: ahocorasick.Automaton) -> tuple[float, float]:
    """Damped weight, and weight per hundred words (damped): both zero without a match."""
    total, _, words = matches(text, found)
    return math.log1p(total), math.log1p(100 * total / (words + 20))


def score(text: str, found: ahocorasick.Automaton, curve: tuple[float, float, float]) -> float:
    a, b = measures(text, found)
    return float(sigmoid(np.array(a * curve[0] + b * curve[1] + curve[2])))


_TOKEN = re.compile(r"[^\W\d_]+")


def fit(rows: list[tuple[str, int]], least: int = 4) -> Lexicon:
    """Lexicon and curve from labelled texts."""
    seen: dict[str, set[int]] = defaultdict(set)  # hash of the neighbours, and the label
    texts = [0, 0]
    for text, label in rows:
        label = int(label > 0)
        texts[label] += 1
        tokens = _TOKEN.findall(fold(text))
        last: dict[str, int] = {}
        for i, w in enumerate(tokens):
            last.setdefault(w, i)
        for w, i in last.items():
            beside = " ".join(tokens[max(0, i - 1) : i] + tokens[i + 1 : i + 2])
            seen[w].add(zlib.crc32(beside.encode()) << 1 | label)
    words = dict(GENERAL)
    for w, contexts in seen.items():
        toxic = sum(c & 1 for c in contexts)
        other = len(contexts) - toxic
        if len(w) < 3 or toxic < least:
            continue
        # Shares per text of a kind, smoothed; the lower end of the toxic one against the other.
        low = max(toxic - 1.5 * math.sqrt(toxic), 0.5) / (texts[1] + 1)
        ratio = math.log(low / ((other + 0.5) / (texts[0] + 1)))
        if ratio > 2.5:
            words[w] = max(words.get(w, 0.0), min(ratio, 4.0) - 0.5)
        elif w in words and other > 3 * toxic * max(texts[0], 1) / max(texts[1], 1):
            del words[w]  # harmless here
    phrases: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for text, label in rows:
        tokens = _TOKEN.findall(fold(text))
        for a, b in {(a, b) for a, b in zip(tokens, tokens[1:]) if a in words or b in words}:
            phrases[f"{a} {b}"][int(label > 0)] += 1
    learned = tuple(sorted(p for p, (harmless, toxic) in phrases.items() if harmless >= 3 and harmless > 10 * toxic))
    lexicon = Lexicon(words, EXCEPTIONS + learned, (2.5, 0.5, -3.0))
    if texts[0] and texts[1]:
        found = automaton(lexicon)
        x = np.array([measures(text, found) for text, _ in rows])
        w = logistic(x, np.array([float(label > 0) for _, label in rows]), l2=1e-3)
        if w[0] * math.log1p(2) + w[1] * math.log1p(2) > 0:
            lexicon = lexicon._replace(curve=tuple(w.tolist()))
    return lexicon


def learned(docs: DataFrame, labels: DataFrame) -> Lexicon:
    rows = labelled(docs, labels, "toxic", SAMPLE_ROWS, FOLDS, HELD_OUT_FOLD)
    return fit([(raw.decode(), label) for raw, label in rows])


def score_column(text: Column, lexicon: Lexicon) -> Column:
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = automaton(lexicon)
        for texts in batches:
            yield pa.array([score(t.as_py() or "", found, lexicon.curve) for t in texts], pa.float64())

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted of every document."""
    scored = docs.select("doc_id", score_column(F.col("text"), lexicon or learned(docs, labels)).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
