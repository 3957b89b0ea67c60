"""Column functions on text: stripping, counting, hashing, truncation, templates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4

# The characters a string strip or split takes for white space.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space (plain ``trim`` removes only blanks)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def words(text: Column) -> Column:
    """Tokens between runs of white space."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def token_estimate(text: Column, least: int = 1) -> Column:
    """Four characters per token, at least ``least``."""
    return F.greatest(F.lit(least), F.floor(F.length(text) / CHARS_PER_TOKEN)).cast("int")


def content_id(text: Column, source: Column | None = None) -> Column:
    """First 16 hex digits of SHA-256; salt with the source to tell equal texts apart."""
    body = text if source is None else F.concat_ws("\u0000", source, text)
    return F.substring(F.sha2(body, 256), 1, 16)


def truncated(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("...(truncated)"))).otherwise(text)


def compression_ratio(original: Column, compressed: Column) -> Column:
    before, after = token_estimate(original, 0), token_estimate(compressed, 0)
    return F.when(before > 0, after / before).otherwise(F.lit(0.0))


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template with columns; a value is never scanned for further places."""
    pieces, rest = [], template
    while rest:
        at = min((p for p in ((rest.find("{" + n + "}"), n) for n in values) if p[0] >= 0), default=None)
        if at is None:
            pieces.append(F.lit(rest))
            break
        position, name = at
        if position:
            pieces.append(F.lit(rest[:position]))
        pieces.append(values[name])
        rest = rest[position + len(name) + 2 :]
    return F.concat(*pieces)


def word_jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words, case-folded; 0 when both texts are empty."""
    left, right = F.array_distinct(words(F.lower(a))), F.array_distinct(words(F.lower(b)))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right))), F.lit(0.0))


def bucket_100(key: Column) -> Column:
    """Repeatable bucket 0..99 of a key from its MD5 digest."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(100))
