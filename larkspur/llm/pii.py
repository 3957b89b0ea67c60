"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

A pattern proposes; a rule of the kind (part ranges, number of digits, Luhn, mod 97) rejects a proposal or
confirms it, and the confirmed one starts with the score of its kind. Words that announce the kind within
``NEAR`` bytes before or ``NEAR // 2`` after raise the score, words of other things (version, order, ticket) lower it. The four base
kinds are reported whatever their score; added kinds need ``LEAST`` and touch no base span.

Every pattern is written so that a text is read in time proportional to its length: runs are taken whole
(possessive), a search starts at a run's beginning only, and mail addresses are looked for from their ``@``.
Texts are searched several at a time, one after the other in one buffer; no pattern crosses a line break.

* null text: empty; an empty text has no spans. Rows without an id and repeated rows: each on its own.
* an empty table gives an empty result. A very long text is searched whole, in about twenty bytes for a byte of it.
* two kinds at one place are both reported, in the order of ``KINDS``. Columns go by name; ``redact`` returns
  the columns of the input and no others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import counted, fresh, joined, passes

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone", "birth_date", "passport")
#: Bytes in which an announcing word counts, and the score an added kind needs.
NEAR, LEAST = 48, 0.6

# ---- base kinds -----------------------------------------------------------------------------------

_IN_LOCAL = np.zeros(256, bool)
_IN_LOCAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")] = True
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(rb"[^0-9]+")


def luhn(digits: bytes) -> bool:
    """Whether the digits pass the check sum of payment cards."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d -= 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(value: bytes) -> bool:
    """Whether an account number (letters and digits, country first) has the remainder 1 that its check digits promise."""
    turned = value[4:] + value[:4]
    return int("".join(str(int(chr(c), 36)) for c in turned)) % 97 == 1


def emails(data: bytes, array: np.ndarray) -> Iterator[tuple[int, int]]:
    """Mail addresses, each from the beginning of the run before its ``@``."""
    outside = None
    done = 0
    at = data.find(b"@")
    while at >= 0:
        if at > done and _IN_LOCAL[data[at - 1]]:
            domain = _DOMAIN.match(data, at + 1)
            if domain:
                if outside is None:
                    outside = np.flatnonzero(~_IN_LOCAL[array])
                before = int(np.searchsorted(outside, at)) - 1
                start = max(done, int(outside[before]) + 1 if before >= 0 else 0)
                yield start, domain.end()
                done = domain.end()
        at = data.find(b"@", at + 1)


def base_spans(data: bytes, array: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, in bytes, kind by kind."""
    for a, b in emails(data, array):
        yield 0, a, b
    for m in _IP.finditer(data):
        if all(len(part := x.lstrip(b"0")) < 4 and int(part or b"0") <= 255 for x in m[0].split(b".")):
            yield 1, m.start(), m.end()
    for m in _CARD.finditer(data):
        digits = _NO_DIGIT.sub(b"", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield 2, m.start(), m.end()
    for m in _PHONE.finditer(data):
        if 9 <= len(_NO_DIGIT.sub(b"", m[0])) <= 15:
            yield 3, m.start(), m.end()


# ---- added kinds ----------------------------------------------------------------------------------


class Kind(NamedTuple):
    """A kind beyond the base: what proposes it and its score before the context."""

    name: str
    pattern: re.Pattern
    score: float


#: Lengths of account numbers by country (fixed values).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

ADDED = (
    Kind("iban", re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ ]?[A-Z0-9])"), 0.8),
    Kind("ssn", re.compile(rb"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), 0.4),
    Kind("local_phone", re.compile(rb"(?<![0-9A-Za-z+(.-])\(?[0-9]{2,5}\)?(?:[ /.-]?[0-9]{2,8}){2,4}+(?![0-9A-Za-z])"), 0.3),
    Kind("birth_date", re.compile(rb"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:[0-9]{4}|[0-9]{2}))(?![0-9])"), 0.3),
    Kind("passport", re.compile(rb"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])"), 0.2),
)
#: What follows the country and check digits of an account number, by its length.
_IBAN_REST = {n: re.compile(rb"(?:[ ]?[A-Z0-9]){%d}+(?![A-Za-z0-9])" % (n - 4)) for n in set(IBAN_LENGTHS.values())}

#: Words that announce a kind, and words of numbers that are no personal data, in the languages of the corpus (fixed values).
ANNOUNCE = {
    "email": ("mail", "e-mail", "correo", "courriel", "contact", "kontakt"),
    "ip": ("ip", "address", "adresse", "host", "client", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "mobile", "cell", "fax", "call", "telefon", "handy", "rufnummer", "portable", "teléfono", "telefono", "móvil"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank", "bic"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "local_phone": ("phone", "tel", "telephone", "mobile", "cell", "fax", "call", "telefon", "handy", "rufnummer", "portable", "teléfono", "telefono", "móvil"),
    "birth_date": ("born", "birth", "birthday", "dob", "geboren", "geburtsdatum", "né", "née", "naissance", "nacido", "nacida", "nacimiento"),
    "passport": ("passport", "reisepass", "pass-nr", "passeport", "pasaporte"),
}
OTHER = ("version", "release", "order", "invoice", "ticket", "isbn", "issn", "sku", "section", "chapter", "build", "serial")
UP, DOWN = 0.4, 0.3


def _any_of(words: tuple[str, ...]) -> re.Pattern:
    longest = sorted({w.encode() for w in words}, key=len, reverse=True)
    return re.compile(rb"(?<![a-z0-9\x80-\xff])(?:" + b"|".join(map(re.escape, longest)) + rb")(?![a-z\x80-\xff])")


_ANNOUNCE = [_any_of(ANNOUNCE[k]) for k in KINDS]
_OTHER = _any_of(OTHER)
_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7} | {k.name: k.score for k in ADDED}


def proposals(kind: Kind, data: bytes) -> Iterator[tuple[int, int]]:
    """Where a pattern of an added kind matches; an account number is as long as its country says."""
    for m in kind.pattern.finditer(data):
        if kind.name != "iban":
            yield m.span()
        elif length := IBAN_LENGTHS.get(m[0][:2].decode()):
            if rest := _IBAN_REST[length].match(data, m.end()):
                yield m.start(), rest.end()


def confirmed(kind: str, value: bytes) -> bool:
    """Whether a proposal of an added kind follows the rules of the kind."""
    digits = _NO_DIGIT.sub(b"", value)
    if kind == "iban":
        return mod97(value.replace(b" ", b""))
    if kind == "ssn":  # areas, groups and serials that were never given out
        return digits[:3] not in (b"000", b"666") and digits[:1] != b"9" and digits[3:5] != b"00" and digits[5:] != b"0000"
    if kind == "local_phone":
        return 7 <= len(digits) <= 13
    if kind == "birth_date":
        parts = [int(x) for x in re.split(rb"[./-]", value)]
        year, month, day = (parts[0], parts[1], parts[2]) if b"-" in value else (parts[2], parts[1], parts[0])
        return (1900 <= year <= 2100 or year < 100) and (1 <= month <= 12 and 1 <= day <= 31 or 1 <= day <= 12 and 1 <= month <= 31)
    return True


def score(kind: str, low: bytes, start: int, end: int, first: int, last: int) -> float:
    """The score of a confirmed span in lower-cased bytes, of the text that lies at ``first`` to ``last``: its kind's, and the words of its line nearby."""
    before = low[max(first, start - NEAR) : start].rpartition(b"\n")[2]
    after = low[end : min(last, end + NEAR // 2)].partition(b"\n")[0]
    value = _SCORE[kind]
    announce = _ANNOUNCE[KINDS.index(kind)]
    if announce.search(before) or announce.search(after):
        value += UP
    if _OTHER.search(before):
        value -= DOWN
    return min(max(value, 0.0), 1.0)


def scan(batch: list[bytes]) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, end, score) of every span of each text, in bytes, by start, then kind."""
    array, starts, lengths = joined(batch)
    data = array.tobytes()
    low = data.lower()  # ASCII only: places stay
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in batch]
    base: list[tuple[int, int]] = []

    def place(a: int) -> int:
        return int(np.searchsorted(starts, a, side="right")) - 1

    def rated(kind: int, a: int, b: int, d: int) -> float:
        return score(KINDS[kind], low, a, b, int(starts[d]), int(starts[d] + lengths[d]))

    for kind, a, b in base_spans(data, array):
        d = place(a)
        at = int(starts[d])
        found[d].append((kind, a - at, b - at, rated(kind, a, b, d)))
        base.append((a, b))
    taken = np.array(sorted(base), np.int64).reshape(-1, 2)
    for kind, a, b in _added(data, taken[:, 0], np.maximum.accumulate(taken[:, 1])):
        d = place(a)
        value = rated(kind, a, b, d)
        if value >= LEAST:
            at = int(starts[d])
            found[d].append((kind, a - at, b - at, value))
    for spans in found:
        spans.sort(key=lambda s: (s[1], s[0]))
    return found


def _touches(starts: np.ndarray, reach: np.ndarray, a: int, b: int) -> bool:
    """Whether a span touches one of those with these starts (sorted) and largest ends so far."""
    before = int(np.searchsorted(starts, b)) - 1
    return before >= 0 and bool(reach[before] > a)


def _added(data: bytes, starts: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Confirmed proposals of the added kinds that touch no base span."""
    for kind in ADDED:
        for a, b in proposals(kind, data):
            if confirmed(kind.name, data[a:b]) and not _touches(starts, reach, a, b):
                yield KINDS.index(kind.name), a, b


def to_code_points(raw: bytes, spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """The same spans counted in code points."""
    if not spans or raw.isascii():
        return spans
    points = counted((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [(k, int(points[a]), int(points[b]), v) for k, a, b, v in spans]


# ---- on tables ------------------------------------------------------------------------------------

_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scan_column(text: Column) -> Column:
    """All spans of a text in code points: array of (kind, start, end, score), by start, then kind."""

    @F.arrow_udf("array<struct<kind: string, start: long, end: long, score: double>>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for batch in passes(texts):
                for raw, found in zip(batch, scan(batch)):
                    out.append([dict(zip(("kind", "start", "end", "score"), (KINDS[s[0]], *s[1:]))) for s in to_code_points(raw, found)])
            yield pa.array(out, _SPAN)

    return spans(text)


def find(docs: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end, score) of every document."""
    return docs.select("doc_id", scan_column(F.col("text")).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the base spans and all spans as text, from the result of ``find``."""
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

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


def redact(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The documents with every span of at least this score replaced by its kind in brackets (``[EMAIL]``)."""
    spans = fresh(docs, "_spans")

    @F.arrow_udf("string")
    def masked(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, marks in zip(texts, found):
            text, parts, at = text.as_py(), [], 0
            for s in marks.as_py():
                if s["score"] < least:
                    continue
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
                at = max(at, s["end"])
            out.append("".join(parts) + text[at:])
        return pa.array(out, pa.string())

    marked = docs.withColumn(spans, scan_column(F.col("text")))
    dirty = F.size(spans) > 0
    clean = F.when(dirty, masked(F.when(dirty, F.col("text")).otherwise(F.lit("")), F.col(spans))).otherwise(F.col("text"))
    return marked.select(*[clean.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
