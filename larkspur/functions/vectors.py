"""Column functions on ``array<float>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scores are rounded so that equal vectors tie exactly and the id decides.
SCORE_DIGITS = 9


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when a norm is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def mean_vectors(df: DataFrame, key: str, vector: str, out: str) -> DataFrame:
    """Component-wise mean per key: one partial vector per key and map task, however many vectors a key has."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    whole = df.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("__v"))
    return whole.groupBy(key).agg(Summarizer.mean(F.col("__v")).alias("__m")).select(key, vector_to_array("__m").alias(out))
