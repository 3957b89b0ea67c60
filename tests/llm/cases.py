"""Rows that every operator must take: nulls, empty and odd texts, ties, repeats, clashing columns."""

from __future__ import annotations

import re
import zlib

SPACE = re.compile(r"[^\x20\x09-\x0D]+")

ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it.", "en", "a", 10),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n \x0b\f\r ", "de", "b", 9),
    (None, "A text without an id that says a few things in one line.", "en", "a", 5),
    (None, None, None, None, None),
    (5, "one two", "fr", "b", 7),
    (5, "one two", "fr", "b", 7),
    (6, "Ünïcödé wörds   ü日本語 \U0001f600 token = \"abcdef123456\" end.", "es", "b", 3),
    (7, "word " * 3000, "en", "a", 15000),
    (8, "<<>>$$$###!!!", "en", "a", 13),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = "fp fingerprint component_id score kept copy mix_key _measures _ballot _rank _times _held spans kind node root m".split()


def odd(spark, extra: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if extra else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def long_text(words: int = 400_000) -> str:
    """A few MB of text without repeats."""
    return " ".join(f"w{(i * 7919) % 1_000_003}" for i in range(words))


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def plain(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
