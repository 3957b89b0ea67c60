"""Record cleaning."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import strip
from larkspur.operators.ordered import keep_first, numbered
from larkspur.session import cut_lineage


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip Unicode white space from every string column."""
    return df.select(
        *[strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema]
    )


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with no null in ``columns`` (all by default). NaN is a value here, not a null."""
    names = columns or df.columns
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names]))


def drop_duplicates(df: DataFrame, columns: list[str] | None, order: list[Column]) -> DataFrame:
    """Keep the first row in ``order`` per key.

    Rows are dealt and sorted by two hashes of the key; the key itself, which may be a whole text, is compared only
    where both are equal.
    """
    keys = columns or df.columns
    hashes = {"__h1": F.xxhash64(*keys), "__h2": F.xxhash64(*keys, F.lit(1))}
    return keep_first(df.withColumns(hashes), [*hashes, *keys], order).drop(*hashes)


def schema_warnings(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """What a frame's columns lack or hold in another type than expected (column to type name)."""
    found = dict(df.dtypes)
    return [
        f"column '{name}' is missing" if name not in found else f"column '{name}' is {found[name]}, expected {kind}"
        for name, kind in expected.items()
        if found.get(name) != kind
    ]


def clean(
    df: DataFrame,
    order: list[Column],
    strip_whitespace: bool = True,
    null_columns: list[str] | None = None,
    dedup_columns: list[str] | None = None,
    expected: dict[str, str] | None = None,
) -> DataFrame:
    """Strip, then drop nulls, then keep the first copy. Differences from ``expected`` types are warned of, no more."""
    for line in schema_warnings(df, expected or {}):
        warnings.warn(line, stacklevel=2)
    out = strip_strings(df) if strip_whitespace else df
    if null_columns:
        out = drop_nulls(out, null_columns)
    if dedup_columns:
        out = drop_duplicates(out, dedup_columns, order)
    return out


def scalar_metadata(variant: str) -> Column:
    """Names of the top-level scalar entries of a JSON object column, as a map of texts; the type decides, not the text."""
    entries = F.from_json(F.col(variant), T.MapType(T.StringType(), T.StringType()))
    typed = F.from_json(F.col(variant), T.MapType(T.StringType(), T.VariantType()))
    return F.map_filter(
        entries, lambda k, v: v.isNotNull() & ~F.schema_of_variant(F.element_at(typed, k)).rlike("^(ARRAY|OBJECT)")
    )


def build_features(df: DataFrame, text: str, ts: str, category: str) -> DataFrame:
    """Text length, word count, hour, ISO weekday (1 = Monday) and a dense category code.

    Codes are positions among the distinct categories. These are range-partitioned and
    counted per partition, whatever their names look like; the rows themselves are not sorted.
    """
    distinct = df.select(F.col(category).alias("__cat")).distinct().repartitionByRange("__cat")
    distinct = cut_lineage(distinct.select(F.lit(1).alias("__one"), "__cat", F.spark_partition_id().alias("__range")), "categories")
    codes = numbered(distinct, ["__one"], [F.col("__cat")], F.col("__range"), "__code").select(
        "__cat", (F.col("__code") - 1).cast("int").alias("category_code")
    )
    return (
        df.join(codes, F.col(category).eqNullSafe(F.col("__cat")))
        .drop("__cat")
        .withColumn("text_length", F.length(text))
        .withColumn("word_count", F.size(F.split(F.col(text), " ")))
        .withColumn("hour", F.hour(ts))
        .withColumn("weekday", F.weekday(ts) + 1)
    )
