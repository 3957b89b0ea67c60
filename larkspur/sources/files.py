"""File scans: table formats, text corpora and file admission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats in the order they are looked for in a path.
FORMATS = ("parquet", "csv", "json", "delta", "orc")


def format_of(uri: str) -> str:
    """Format from the suffix or a ``/fmt`` path segment; parquet when neither tells."""
    for fmt in FORMATS:
        if uri.endswith(f".{fmt}") or f"/{fmt}/" in uri or uri.endswith(f"/{fmt}"):
            return fmt
    return "parquet"


def read_table(
    spark: SparkSession,
    uri: str,
    fmt: str | None = None,
    infer: bool = True,
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Lazy scan of a file source.

    CSV has a header; ``infer=False`` keeps every CSV value a string, which also
    saves the extra pass that inference makes. Give ``schema`` for large inputs.
    """
    fmt = fmt or format_of(uri)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer and schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(uri)


def describe_source(spark: SparkSession, uri: str, **options) -> DataFrame:
    """(name, type, nullable) with the same options as the scan itself."""
    fields = read_table(spark, uri, **options).schema.fields
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in fields]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean")


def read_corpus(spark: SparkSession, path: str, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Text files below ``path`` as (path, text), and the files that are not valid UTF-8."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length", F.col("content").cast("string").alias("text"))
    valid = F.is_valid_utf8("text")
    good = files.where(valid).select("path", "text")
    bad = files.where(~valid).select("path", "length")
    return good, bad


# Admitted extensions, the type each stands for, and how its files begin (hex).
ADMITTED = {
    "pdf": ("application/pdf", "25504446"),
    "doc": ("application/msword", "D0CF11E0A1B11AE1"),
    "docx": ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", "504B0304"),
    "jpg": ("image/jpeg", "FFD8FF"),
    "jpeg": ("image/jpeg", "FFD8FF"),
    "png": ("image/png", "89504E470D0A1A0A"),
}
MAX_FILE_BYTES = 5 * 1024 * 1024


def file_admission(files: DataFrame, admitted: dict = ADMITTED, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Mark rows of (path, length, content) with the first reason to reject them, or null.

    A ``binaryFile`` scan gives such rows, but leaves out empty files; rows from
    elsewhere may hold them.

    Only the first bytes of a file take part in the type check; a type without a
    known beginning is text and must not hold a NUL byte there.
    """
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.when(F.instr(name, ".") > 0, F.lower(F.substring_index(name, ".", -1)))
    head = F.substring(F.col("content"), 1, 16)
    matches = F.lit(False)
    for kind, (_, magic) in admitted.items():
        begins = F.hex(head).startswith(magic) if magic else F.instr(head.cast("string"), "\u0000") == 0
        matches = F.when(ext == kind, begins).otherwise(matches)
    reason = (
        F.when(ext.isNull(), "no extension")
        .when(~ext.isin(*admitted), "extension not allowed")
        .when(F.col("length") > max_bytes, "too large")
        .when(F.col("length") == 0, "empty")
        .when(~matches, "type does not match extension")
    )
    return files.select("path", "length", ext.alias("extension"), reason.alias("reject_reason"))
