"""Secret scans by a linear-chain conditional random field, beside fixed base patterns.

Tokens of every line are tagged as secret begin, inside or outside. Scores come from the shape of the
token, the words and signs beside it (across line breaks too) and features of the whole file; the best
tags of a line are found by Viterbi. The base patterns are always reported; the tagger adds its spans,
less what lies in a base span, under the kind ``crf``.

The tagger is fitted when a scan is built, from a bounded sample of the documents (``SAMPLE_DOCS``
rows of at most ``SAMPLE_CHARS`` characters, chosen by a hash of the id), whose base spans serve as
labels, and from written-out templates with random values, so that forms the patterns miss are known.
Nothing else is sampled: every text is scanned as a whole.

* null text: empty; empty text: no spans. Null doc_id and repeated rows: each row is scanned on its own.
* an empty table gives an empty result; the tagger then knows the templates only.
* a very long text is scanned in one piece, about forty bytes of memory per byte of text.
* columns are chosen by name; ``redact`` returns the columns of the input and no others.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm import chains
from larkspur.llm.common import bounded_sample, counted, fresh, joined, passes

KINDS = ("assign", "access", "hex", "crf")
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 20_000
MASK = "[SECRET]"

# Base patterns; a match that is too short is dropped after it was found.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_ASSIGN_LEAST, _ACCESS_LEAST, _HEX_LEAST = 6, 20, 24
#: For fitting only: the plain lines taken beside those with secrets, their bytes, the lines asked for words, and the templates.
PLAIN_LINES, LINE_BYTES, WORD_LINES, TEMPLATES = 1500, 2000, 300, 1500
#: What may stand between a base span and an added one of the same value.
_UNBROKEN = re.compile(rb"""[^\s"'`,;&<>(){}\[\]|]{0,64}""")

#: Words that announce a secret, and beginnings of well-known key formats.
KEYWORDS = (*_ASSIGN_WORDS, b"pwd", b"credential", b"private_key", b"access_key", b"bearer", b"auth")
PREFIXES = (b"AKIA", b"ASIA", b"ghp_", b"gho_", b"sk-", b"sk_live_", b"xoxb-", b"xoxp-", b"AIza", b"eyJ", b"glpat-")


def _table(chars: bytes, high: bool = False) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    if high:
        table[128:] = True
    return table


_DIGITS, _UPPER, _LOWER = b"0123456789", bytes(range(65, 91)), bytes(range(97, 123))
_IN_TOKEN = _table(_DIGITS + _UPPER + _LOWER + b"+/_-.~", high=True)
_IS_HEX, _IS_LOWER_HEX = _table(_DIGITS + b"abcdefABCDEF"), _table(_DIGITS + b"abcdef")
_IS_DIGIT, _IS_UPPER, _IS_LOWER, _IS_SIGN, _IS_HIGH = _table(_DIGITS), _table(_UPPER), _table(_LOWER), _table(b"+/_-.~"), _table(b"", True)
_IS_ASSIGN, _IS_QUOTE = _table(b"=:"), _table(b"\"'`")
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((_DIGITS, _UPPER, _LOWER)):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _k + 1


class Tokens(NamedTuple):
    """Tokens of some texts: byte positions, tokens per line, and their features (a list of flag arrays)."""

    starts: np.ndarray
    ends: np.ndarray
    line_lengths: np.ndarray
    features: list[np.ndarray]


def _find_all(data: bytes, words: tuple[bytes, ...]) -> np.ndarray:
    """Where any of the words begins."""
    out = []
    for word in words:
        at = data.find(word)
        while at >= 0:
            out.append(at)
            at = data.find(word, at + 1)
    return np.array(sorted(out), np.int64)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of true flags begin and end."""
    edge = np.zeros(len(flags) + 2, np.int8)
    edge[1:-1] = flags
    step = np.diff(edge)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _shift(flags: np.ndarray, by: int) -> np.ndarray:
    """The flag of the token ``by`` places before (after, if negative)."""
    out = np.zeros(len(flags), bool)
    if by > 0:
        out[by:] = flags[:-by]
    else:
        out[:by] = flags[-by:]
    return out


def tokens(data: np.ndarray, doc_starts: np.ndarray) -> Tokens:
    """Tokens of texts that lie one after the other, each closed by a line break."""
    raw = data.tobytes()
    starts, ends = _runs(_IN_TOKEN[data])
    size = ends - starts

    def per_token(flags: np.ndarray) -> np.ndarray:
        sums = counted(flags)
        return sums[ends] - sums[starts]

    digit, upper, lower = per_token(_IS_DIGIT[data]), per_token(_IS_UPPER[data]), per_token(_IS_LOWER[data])
    sign, high = per_token(_IS_SIGN[data]), per_token(_IS_HIGH[data])
    kinds = _CLASS[data]
    turns = counted(np.append(False, kinds[1:] != kinds[:-1]))
    turns = turns[ends] - turns[np.minimum(starts + 1, ends)]
    letters = upper + lower

    def holding(words: tuple[bytes, ...], low: bool) -> np.ndarray:
        at = _find_all(raw.lower() if low else raw, words)
        flags = np.zeros(len(starts), bool)
        if len(at) and len(starts):
            place = np.searchsorted(starts, at, side="right") - 1
            place = place[place >= 0]
            flags[place] = True
        return flags

    keyword = holding(KEYWORDS, True)
    prefixed = holding(PREFIXES, False)
    # Signs between the token before and this one.
    before = np.append(0, ends[:-1]) if len(ends) else ends
    marks = counted(_IS_ASSIGN[data])
    assigned = marks[starts] > marks[before]
    padded = np.append(data, np.uint8(32))
    quoted = _IS_QUOTE[padded[starts - 1]] & (starts > 0)
    closed = _IS_QUOTE[padded[ends]]
    doc = np.searchsorted(doc_starts, starts, side="right") - 1
    docs = max(len(doc_starts), 1)
    with_key = np.bincount(doc, keyword, docs) > 0
    chars = np.maximum(np.bincount(doc, size, docs), 1)
    many_digits = np.bincount(doc, digit, docs) / chars > 0.1
    much_code = np.bincount(doc, assigned, docs) / np.maximum(np.bincount(doc, minlength=docs), 1) > 0.1
    word = (lower + high == size) | ((upper == 1) & (lower + high == size - 1))
    mixed = (digit > 0) & (letters > 0)
    dense = (size >= 8) & (turns * 4 >= size)
    near_key = _shift(keyword, 1) | (_shift(keyword, 2) & ~_shift(word, 1))
    features = [
        np.ones(len(starts), bool),
        size < 4,
        (size >= 4) & (size < 8),
        (size >= 8) & (size < 16),
        (size >= 16) & (size < 24),
        (size >= 24) & (size < 40),
        size >= 40,
        word,
        (upper == size) & (size > 1),
        digit == size,
        (lower > 0) & (upper > 1),
        mixed,
        mixed & (digit * 5 >= size),
        # second group: signs and formats
        (size >= 8) & mixed & (per_token(_IS_HEX[data]) == size),
        sign > 0,
        (sign * 4 >= size) & (sign > 0),
        dense,
        dense & mixed & (size >= 16),
        high > 0,
        keyword,
        prefixed,
        prefixed & (size >= 16),
        quoted,
        quoted & closed,
        assigned,
        # third group: neighbours and file
        near_key,
        near_key & assigned,
        near_key & mixed,
        near_key & word,
        near_key & quoted,
        _shift(word, 1),
        _shift(word, -1),
        _shift(keyword, -1),
        _shift(mixed, 1) & mixed,
        with_key[doc],
        many_digits[doc],
        much_code[doc],
    ]
    lines = counted(data == 10)[starts]
    edge = np.flatnonzero(np.append(True, lines[1:] != lines[:-1])) if len(lines) else np.zeros(0, np.int64)
    return Tokens(starts, ends, np.diff(np.append(edge, len(starts))), features)


_GROUP = 13  # features per table of a packed model


class Tagger(NamedTuple):
    """Weights packed as one table per group of features, so a token's scores are three lookups."""

    tables: list[np.ndarray]
    trans: np.ndarray
    start: np.ndarray

    def tag(self, t: Tokens) -> np.ndarray:
        emit = np.zeros((len(t.starts), 3), np.float32)
        for table, k in zip(self.tables, range(0, len(t.features), _GROUP)):
            code = np.zeros(len(t.starts), np.int32)
            for bit, flags in enumerate(t.features[k : k + _GROUP]):
                code |= flags.astype(np.int32) << bit
            emit += table[code]
        return chains.viterbi(emit, t.line_lengths, self.trans.astype(np.float32), self.start.astype(np.float32))


OUT, BEGIN, INSIDE = 0, 1, 2


def pack(weights: np.ndarray, trans: np.ndarray, start: np.ndarray) -> Tagger:
    tables = []
    for k in range(0, len(weights), _GROUP):
        part = weights[k : k + _GROUP]
        bits = np.arange(1 << len(part))[:, None] >> np.arange(len(part)) & 1
        tables.append((bits @ part).astype(np.float32))
    return Tagger(tables, trans, start)


def base_spans(raw: bytes, keyed: bool = True, access: bool = True) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, start of the secret itself) of the patterns for assignments and access keys, in bytes."""
    out = []
    if keyed:
        out += [(0, m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(raw) if m.end() - m.start(2) >= _ASSIGN_LEAST]
    if access:
        out += [(1, m.start(), m.end(), m.start()) for m in _ACCESS.finditer(raw) if m.end() - m.start() >= _ACCESS_LEAST]
    return out


def united(base: list[tuple[int, int, int, int]]) -> tuple[list[int], list[int]]:
    """Where the united base spans of a text begin and end, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b, _ in sorted(base, key=lambda s: s[1]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def outside(raw: bytes, begin: int, end: int, base: list[tuple[int, int, int, int]] | tuple[list[int], list[int]]) -> list[tuple[int, int]]:
    """The parts of a span that lie in no base span and hold a token, without white space at their ends.

    A part that nothing breaks off from the base span before it begins where that one ends. ``base`` may be united.
    """
    starts, ends = united(base) if isinstance(base, list) else base
    k = bisect_right(ends, begin)  # the first span that ends after the beginning
    parts, at = [], begin
    if _UNBROKEN.fullmatch(raw, ends[k - 1] if k else begin, begin):
        at = ends[k - 1] if k else begin
    while at < end:
        a = min(starts[k], end) if k < len(starts) else end
        if at < a:
            part = raw[at:a]
            if _IN_TOKEN[np.frombuffer(part, np.uint8)].any():
                parts.append((a - len(part.lstrip()), at + len(part.rstrip())))
        at = max(at, ends[k]) if a < end else end
        k += 1
    return parts


def scan(batch: list[bytes], tagger: Tagger | None) -> tuple[list[list[tuple[int, int, int, int]]], Tokens, np.ndarray]:
    """Spans of every text (kind, start, end, start of the secret; bytes), the tokens and where the texts begin."""
    data, doc_starts, lengths = joined(batch)
    doc_ends = doc_starts + lengths
    raw = data.tobytes()
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in batch]
    keyed = set(np.searchsorted(doc_starts, _find_all(raw.lower(), _ASSIGN_WORDS), side="right").tolist())
    access = set(np.searchsorted(doc_starts, _find_all(raw, (b"AKIA",)), side="right").tolist())
    for d in keyed | access:
        found[d - 1] += base_spans(batch[d - 1], d in keyed, d in access)
    begin, end = _runs(_IS_LOWER_HEX[data])
    long = end - begin >= _HEX_LEAST
    for a, b in zip(begin[long].tolist(), end[long].tolist()):
        d = int(np.searchsorted(doc_starts, a, side="right")) - 1
        at = int(doc_starts[d])
        found[d].append((2, a - at, b - at, a - at))
    t = tokens(data, doc_starts)
    if tagger is not None and len(t.starts):
        tags = tagger.tag(t)
        first = np.flatnonzero(tags == BEGIN)
        if len(first):
            others = np.flatnonzero(tags != INSIDE)
            following = np.searchsorted(others, first, side="right")
            last = np.append(others, len(tags))[following] - 1
            docs = np.searchsorted(doc_starts, t.starts[first], side="right") - 1
            base, of = ([], []), -1
            for d, a, b in zip(docs.tolist(), t.starts[first].tolist(), t.ends[last].tolist()):
                if d != of:  # spans come text by text
                    base, of = united(found[d]), d
                at = int(doc_starts[d])
                found[d] += [(3, x, y, x) for x, y in outside(batch[d], a - at, min(b, int(doc_ends[d])) - at, base)]
    for spans in found:
        spans.sort(key=lambda s: (s[1], s[0]))
    return found, t, doc_starts


def to_code_points(raw: bytes, spans: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The same spans counted in code points."""
    if not spans or raw.isascii():
        return spans
    points = counted((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [(s[0], *(int(points[x]) for x in s[1:])) for s in spans]


# ---- fitting --------------------------------------------------------------------------------------

_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_SECRET_LINES = (
    '{w} password = "{v}" {w}', "{w} {w} api_key: {v} {w}", "secret={v}", "{w} Authorization: Bearer {v}", "{w} {w} token {v} {w} {w}",
    "export ACCESS_KEY='{v}'", "{w} the password is {v} {w} {w}", "pwd: {v}", '"credential": "{v}", {w}', "{w} {w} {k} {w} {w}", "{k}", "{w} private_key {v}",
)
_PLAIN_LINES = (
    "{w} {w} the secret of {w} {w} {w}", "{w} a token of {w} and {w}", "password reset {w} {w}", "{w} {w}.{n}@mail.example.com {w}", "{w} {n} {n}.{n} {w}",
    "{w} 2024-05-{n}T10:{n}:00 {w}", "https://www.example.org/{w}/{n}.html {w}", "{w}: {w} {w} = {n}", "{w} v1.{n}.{n} {w} {w}", "{w} {w} {w}, {w} {w} {w}.",
    "{N} {w} {w}", "{w} 10.{n}.{n}.7 {w}", "{w}-{w} {w}_{w}", "{W} {W} {W}", "tokens: {n} {w}", "auth {w} {w}",
)


def _value(rng: random.Random) -> str:
    kind = rng.randrange(5)
    size = rng.choice((10, 12, 16, 20, 32, 40, 64))
    letters = (_LETTERS, _LETTERS + "+/", _LETTERS[-10:] + "abcdef", _LETTERS[26:], _LETTERS + "_-.")[kind]
    text = "".join(rng.choices(letters, k=size))
    if rng.random() < 0.15:  # a sign inside splits it into two tokens
        text = text[: size // 2] + rng.choice("=$%") + text[size // 2 :]
    return text


def _templates(rng: random.Random, words: list[str], count: int) -> tuple[list[bytes], list[list[tuple[int, int]]]]:
    """Lines with made-up secrets and plain lines that look a little like them; the byte spans of the secrets."""
    lines, spans = [], []
    for i in range(count):
        form = rng.choice(_SECRET_LINES if i % 2 else _PLAIN_LINES)
        out, marked = "", []
        for piece in re.split(r"(\{\w\})", form):
            if piece == "{w}":
                piece = rng.choice(words)
            elif piece == "{W}":
                piece = rng.choice(words).upper()
            elif piece in ("{n}", "{N}"):
                piece = str(rng.randrange(10**2 if piece == "{n}" else 10**16))
            elif piece in ("{v}", "{k}"):
                piece = _value(rng) if piece == "{v}" else rng.choice(PREFIXES).decode() + "".join(rng.choices(_LETTERS, k=24))
                marked.append((len(out.encode()), len((out + piece).encode())))
            out += piece
        lines.append(out.encode())
        spans.append(marked)
    return lines, spans


def fit(texts: list[str], seed: int = 5) -> Tagger:
    """A tagger from texts with their base spans as labels and from templates. Equal texts give equal weights."""
    rng = random.Random(seed)
    lines: list[bytes] = []
    spans: list[list[tuple[int, int]]] = []
    plain: list[bytes] = []
    for text in texts:
        raw = text.encode()
        ((found), *_) = scan([raw], None)[0]
        at = 0
        for line in raw.split(b"\n"):
            inside = [(s[3] - at, s[2] - at) for s in found if at <= s[3] and s[2] <= at + len(line)]
            if inside:
                lines.append(line)
                spans.append(inside)
            elif line.strip():
                plain.append(line)
            at += len(line) + 1
    rng.shuffle(plain)
    plain = [x[:LINE_BYTES] for x in plain[: PLAIN_LINES + 2 * len(lines)]]
    words = sorted({w for x in plain[:WORD_LINES] for w in x.decode(errors="ignore").split()})[:2000] or ["the", "of", "and", "in", "to", "was"]
    made, made_spans = _templates(rng, words, TEMPLATES)
    lines, spans = lines + plain + made, spans + [[] for _ in plain] + made_spans
    data, starts, _ = joined(lines)
    t = tokens(data, starts)
    tags = np.zeros(len(t.starts), np.int64)
    for at, marked in zip(starts, spans):
        for a, b in marked:
            inside = np.flatnonzero((t.starts < at + b) & (t.ends > at + a))
            tags[inside] = INSIDE
            tags[inside[:1]] = BEGIN
    weights, trans, start = chains.fit(
        np.stack(t.features, 1), tags, t.line_lengths, 3, forbidden=((OUT, INSIDE),), not_first=(INSIDE,)
    )
    return pack(weights, trans, start)


def learned(docs: DataFrame) -> Tagger:
    """The tagger for a table of documents, from its bounded sample."""
    rows = bounded_sample(docs.select("doc_id", "text"), "doc_id", SAMPLE_DOCS).where(F.length("text") <= SAMPLE_CHARS).collect()
    return fit(sorted(r["text"] for r in rows))


# ---- on tables ------------------------------------------------------------------------------------


def scan_column(text: Column, tagger: Tagger) -> Column:
    """All spans of a text in code points: array of (kind, start, end, secret_start), by start, then kind."""

    @F.arrow_udf("array<struct<kind: string, start: long, end: long, secret_start: long>>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret_start", pa.int64())]))
        for texts in batches:
            out = []
            for batch in passes(texts):
                for raw, found in zip(batch, scan(batch, tagger)[0]):
                    out.append([dict(zip(("kind", "start", "end", "secret_start"), (KINDS[s[0]], *s[1:]))) for s in to_code_points(raw, found)])
            yield pa.array(out, kind)

    return spans(text)


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id and the spans (kind, start, end, secret_start) of every document."""
    return docs.select("doc_id", scan_column(F.col("text"), tagger or learned(docs)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the base spans and all spans as text, from the result of ``find``."""
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["kind"] != "crf")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    def written(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """The documents with every secret replaced by ``MASK``; ``n_chars``, if there, is set anew where a text changed."""
    tagger = tagger or learned(docs)
    spans = fresh(docs, "_spans")

    @F.arrow_udf("string")
    def masked(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, marks in zip(texts, found):
            text, parts, at, kind = text.as_py(), [], 0, ""
            for s in sorted(marks.as_py(), key=lambda s: s["secret_start"]):
                # what the tagger adds right beside a span is of the same secret
                if s["secret_start"] > at or s["secret_start"] == at and not (parts and "crf" in (kind, s["kind"])):
                    parts += [text[at : s["secret_start"]], MASK]
                if s["end"] >= at:
                    at, kind = s["end"], s["kind"]
            out.append("".join(parts) + text[at:])
        return pa.array(out, pa.string())

    marked = docs.withColumn(spans, scan_column(F.col("text"), tagger))
    dirty = F.size(spans) > 0
    columns = []
    for c in docs.columns:
        column = F.col(f"`{c}`")
        if c == "text":
            column = F.when(dirty, masked(F.when(dirty, F.col("text")).otherwise(F.lit("")), F.col(spans))).otherwise(column).alias(c)
        columns.append(column)
    done = marked.select(*columns, F.col(spans))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        done = done.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
