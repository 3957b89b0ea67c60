"""Splitting documents into chunks with stable ids."""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text as tx


def chunk_fixed(df: DataFrame, text: str, max_length: int = 1000, overlap: int = 200) -> DataFrame:
    """One row per window of ``max_length`` characters, each starting ``max_length - overlap`` after the last.

    Adds ``chunk_index``, ``chunk_start`` and ``chunk``. An empty text has no
    chunks; a short tail that lies inside the overlap is a chunk of its own.
    """
    if overlap >= max_length:
        raise ValueError("overlap must be smaller than max_length")
    step = max_length - overlap

    def joined(blocks: Column) -> Column:
        """Each block with what follows it, up to ``max_length``: linear in the text, which is cut once."""
        return F.transform(
            blocks,
            lambda b, i: F.substring(
                F.concat(b, *[F.coalesce(F.get(blocks, i + k), F.lit("")) for k in range(1, -(-max_length // step))]), 1, max_length
            ),
        )

    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), 0)
    cut = df.select("*", tx.let(blocks, joined).alias("__pieces"))
    return cut.select(*df.columns, F.posexplode("__pieces").alias("chunk_index", "chunk")).select(
        *df.columns, "chunk_index", (F.col("chunk_index") * step).alias("chunk_start"), "chunk"
    )


# Bytes of text that are cut at a time: what Python holds besides the batch that came and the longest text.
CUT_BYTES = 1 << 20


def _in_steps(texts: pa.Array) -> Iterator[slice]:
    """A batch in steps of whole texts, each of ``CUT_BYTES`` or one text."""
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)):
        if i > start and held + size > CUT_BYTES:
            yield slice(start, i)
            start, held = i, 0
        held += int(size)
    if start < len(texts):
        yield slice(start, len(texts))


def _sentence_pieces(text: str, size: int, overlap: int) -> list[tuple[int, str]]:
    out, start, n = [], 0, len(text)
    while start < n:
        end = start + size
        if end < n:
            dot = text.rfind(".", start, end)
            if dot - start > size / 2:
                end = dot + 1
        out.append((start, text[start:end].strip()))
        start = end - overlap
    return out


def chunk_sentence(df: DataFrame, text: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Chunks that end at the last full stop when it lies in the second half of the window.

    Each start depends on the chunk before, so the cut points come from a
    function over one text at a time; the texts of an Arrow batch are cut in steps.
    """
    if overlap * 2 >= size:
        raise ValueError("overlap must be smaller than half the size")

    pieces = pa.list_(pa.struct([("start", pa.int32()), ("chunk", pa.string())]))

    @F.arrow_udf("array<struct<start:int,chunk:string>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for some in _in_steps(texts):
                yield pa.array([[] if t is None else _sentence_pieces(t, size, overlap) for t in texts[some].to_pylist()], pieces)

    return df.select("*", F.posexplode(cut(F.col(text))).alias("chunk_index", "__c")).select(
        *df.columns, "chunk_index", F.col("__c.start").alias("chunk_start"), F.col("__c.chunk").alias("chunk")
    )


# Chunk size, overlap and separators by document type.
SPLITTERS = {
    "plain_text": (1000, 200, ("\n\n", "\n", ". ", " ")),
    "legal": (1500, 300, ("\n\n", "\n", ". ")),
    "faq": (500, 0, ("\n\n",)),
    "code_python": (1500, 50, ("\nclass ", "\ndef ", "\n\tdef ", "\n\n", "\n", " ")),
    "code_js": (1500, 50, ("\nfunction ", "\nconst ", "\nlet ", "\nclass ", "\n\n", "\n", " ")),
    "default": (1000, 200, ("\n\n", "\n", " ", "")),
}


def _pieces(text: str, size: int, separators: tuple[str, ...]) -> list[str]:
    """Cut at the coarsest separator present, and finer only where a part is still too long."""
    if len(text) <= size or not separators:
        return [text] if text else []
    head, finer = separators[0], separators[1:]
    if head == "":
        return [text[i : i + size] for i in range(0, len(text), size)]
    if head not in text:
        return _pieces(text, size, finer)
    parts = text.split(head)
    parts = [p + head for p in parts[:-1]] + parts[-1:]
    return [q for p in parts for q in _pieces(p, size, finer)]


def _packed(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Join neighbouring pieces up to ``size``; each chunk repeats at most ``overlap`` trailing characters."""
    out: list[str] = []
    held: list[str] = []
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            out.append("".join(held))
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.pop(0))
        held.append(piece)
        length += len(piece)
    return out + (["".join(held)] if held else [])


def chunk_recursive(df: DataFrame, text: str, kind: Column) -> DataFrame:
    """Chunks by separators of the document type in column ``kind``."""

    def one(body: str | None, name: str | None) -> list[str]:
        size, overlap, separators = SPLITTERS.get(name, SPLITTERS["default"])
        return _packed(_pieces(body or "", size, separators), size, overlap)

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, kinds in batches:
            for some in _in_steps(texts):
                yield pa.array(map(one, texts[some].to_pylist(), kinds[some].to_pylist()), pa.list_(pa.string()))

    return df.select("*", F.posexplode(cut(F.col(text), kind)).alias("chunk_index", "chunk"))


def chunk_markdown(df: DataFrame, text: str) -> DataFrame:
    """One chunk per section under a level 1 to 3 header, with the header text; text before the first has none."""
    header = r"(?m)^(?=#{1,3} )"
    section = F.col("__s")
    split = df.select("*", F.posexplode(F.split(F.col(text), header)).alias("chunk_index", "__s"))
    return split.where(F.length(tx.strip(section)) > 0).select(
        *df.columns,
        "chunk_index",
        F.nullif(F.regexp_extract(section, r"\A#{1,3} +([^\r\n]*)", 1), F.lit("")).alias("header"),
        tx.strip(F.regexp_replace(section, r"\A#{1,3} [^\r\n]*", "")).alias("chunk"),
    )


def compare_sizes(df: DataFrame, text: str, sizes=(256, 512, 1024), keep: int = 3) -> DataFrame:
    """The first ``keep`` chunks without overlap for each size, as the comparison defines them."""
    sized = df.withColumn("chunk_size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    count = F.least(F.lit(keep), F.ceil(F.length(text) / F.col("chunk_size"))).cast("int")
    picked = sized.select("*", F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1))).alias("chunk_index"))
    return picked.withColumn(
        "chunk", F.substring(F.col(text), F.col("chunk_index") * F.col("chunk_size") + 1, F.col("chunk_size"))
    )


def not_blank(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.length(tx.strip(F.col(text))) > 0)


def ingest(
    df: DataFrame, text: str, source: str, max_length: int = 1000, overlap: int = 200, salt_source: bool = False
) -> DataFrame:
    """Non-blank documents as (chunk_id, source, chunk_index, chunk_start, chunk).

    Equal chunk texts share an id unless the source salts it.
    """
    chunks = chunk_fixed(not_blank(df, text), text, max_length, overlap)
    salt = F.col(source) if salt_source else None
    return chunks.withColumn("chunk_id", tx.content_id(F.col("chunk"), salt)).drop(text)


def decode_references(text: Column) -> Column:
    """All numeric character references and all named ones of HTML; a no-break space becomes a blank."""

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unescape(t).replace("\xa0", " "))

    return decode(text)


def page_text(html: Column) -> Column:
    """Visible text of the ``article`` element, or of the body when there is none."""
    article = F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*?)</article>", 1)
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)</body>", 1)
    inner = F.when(article != "", article).when(body != "", body).otherwise(html)
    inner = F.regexp_replace(inner, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>|<!--.*?-->", "")
    inner = F.regexp_replace(inner, r"(?i)<br\s*/?>|</?(p|div|h[1-6]|li|ul|ol|tr|table|section)\b[^>]*>", "\n")
    inner = F.regexp_replace(inner, r"<[^>]*>", "")
    inner = decode_references(inner)
    return tx.strip(F.regexp_replace(F.regexp_replace(inner, r"[ \t]+", " "), r"\s*\n\s*", "\n"))
