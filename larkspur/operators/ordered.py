"""Order-dependent operators that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark prunes ``row_number() <= n`` before the shuffle up to this n, where the session names no other.
GROUP_LIMIT = 1000


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _unhashable(kind: T.DataType) -> bool:
    text = kind.simpleString()
    return "map<" in text or "variant" in text


def first_n(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None, salt: Column | None = None
) -> DataFrame:
    """The first ``n`` rows of each key in ``order``.

    Up to a limit of the session the planner keeps n rows per key in every map task, so
    a hot key shuffles little. Above it a salted first pass does the same pruning; the
    salt hashes what can be hashed, maps and variants are left out.
    """
    out = rank or "__rank"
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", str(GROUP_LIMIT)))
    if n > limit:
        plain = [F.col(f"`{f.name}`") for f in df.schema if not _unhashable(f.dataType)]
        spread = F.pmod(salt if salt is not None else F.xxhash64(*plain, F.lit(0)), F.lit(256))
        pre = Window.partitionBy(*keys, "__salt").orderBy(*order)
        df = df.withColumn("__salt", spread).withColumn("__pre", F.row_number().over(pre))
        df = df.where(F.col("__pre") <= n).drop("__pre", "__salt")
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col(out) <= n
    )
    return ranked if rank else ranked.drop(out)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return first_n(df, keys, order, 1)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key; partial aggregation leaves one row per key and map task."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*df.columns)


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    bucket: Column,
    value: Column,
    out: str,
    total: str | None = None,
) -> DataFrame:
    """Inclusive prefix sum of ``value`` per key in ``order``.

    ``bucket`` must not decrease along ``order``. Rows are windowed inside
    (key, bucket) only; the bucket sums, one row each, carry the rest. So the
    largest task holds one bucket, never one key.
    """
    base = df.withColumn("__bucket", bucket).withColumn("__value", value)
    group = [*keys, "__bucket"]
    sums = base.groupBy(*group).agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("__sum").over(Window.partitionBy(*keys)))
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumn("__local", F.sum("__value").over(inside))
    kept = [local[c] for c in df.columns]
    extra = [offsets[total]] if total else []
    return local.join(offsets, _null_safe(local, offsets, group)).select(
        *kept, (offsets["__before"] + local["__local"]).alias(out), *extra
    )


def numbered(
    df: DataFrame, keys: list[str], order: list[Column], bucket: Column, out: str, total: str | None = None
) -> DataFrame:
    """1-based position of each row within its key (a prefix sum of ones)."""
    return running_total(df, keys, order, bucket, F.lit(1).cast("bigint"), out, total)


def value_bucket(value: Column) -> Column:
    """Order-preserving bucket of a number, about 0.14 % wide; at most a million buckets exist.

    NaN is the largest value, as in Spark's ordering, and has a bucket of its own, as has either infinity.
    """
    v = value.cast("double")
    far = F.lit(1 << 40)
    finite = F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v)
    return (
        F.when(F.isnan(v), far + 1)
        .when(v == float("inf"), far)
        .when(v == float("-inf"), -far)
        .otherwise((F.signum(finite) * F.floor(F.log2(F.abs(finite) + 1) * 512)).cast("bigint"))
    )


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str, method: str = "cont") -> DataFrame:
    """Exact quantile per key without gathering a key's values in one place.

    Two passes over the rows, neither of which shuffles them: the first counts per
    (key, value bucket) in the map tasks; the second keeps the rows of the one or two
    buckets that hold the wanted ranks, which are then counted by value. A bucket
    that holds very many values is summed in finer ranges, not by one task.
    ``cont`` interpolates, ``nearest`` rounds the position half up, ``index``
    takes the element at ``int(n * q)`` of the sorted values. NaN is the largest value.
    """
    by = keys or ["__all"]
    src = df if keys else df.withColumn("__all", F.lit(1))
    binned = src.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    binned = binned.withColumn("__bin", value_bucket(F.col("__v")))
    upto = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    n = F.col("__total")
    place = {
        "cont": (n - 1) * F.lit(q),
        "nearest": F.floor((n - 1) * F.lit(q) + 0.5),
        "index": F.least(F.floor(n * F.lit(q)), n - 1),
    }[method].cast("double")
    edges = (
        binned.groupBy(*by, "__bin")
        .agg(F.count(F.lit(1)).alias("__in"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
        .withColumn("__upto", F.sum("__in").over(upto))
        .withColumn("__total", F.sum("__in").over(Window.partitionBy(*by)))
        .withColumn("__place", place)
        .withColumn("__start", F.col("__upto") - F.col("__in"))
    )

    def inside(rank: Column, start: Column, end: Column) -> Column:
        return (rank >= start) & (rank < end)

    lo, hi = F.floor("__place"), F.ceil("__place")
    wanted = edges.where(inside(lo, F.col("__start"), F.col("__upto")) | inside(hi, F.col("__start"), F.col("__upto")))
    wide = F.col("__most") > F.col("__least")
    # Never the open end: the largest value falls into the last of the ranges.
    share = F.when(wide & ~F.isnan("__most"), (F.col("__v") - F.col("__least")) / (F.col("__most") - F.col("__least")))
    opened = (
        binned.join(
            wanted.select(*[F.col(k).alias(f"__k_{k}") for k in by], F.col("__bin").alias("__b"), "__start", "__place", "__least", "__most"),
            reduce(
                lambda a, b: a & b,
                [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in by] + [F.col("__bin") == F.col("__b")],
            ),
        )
        .withColumn("__range", F.floor(F.coalesce(share, F.lit(0.0)) * 4096))
        .groupBy(*by, "__bin", "__range", "__v", "__start", "__place")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranged = running_total(opened, [*by, "__bin"], [F.col("__v")], F.col("__range"), F.col("__n"), "__run")
    ranked = ranged.withColumn("__end", F.col("__start") + F.col("__run"))
    first = F.col("__end") - F.col("__n")
    at = lambda rank: F.max(F.when(inside(rank, first, F.col("__end")), F.col("__v")))
    picked = ranked.groupBy(*by).agg(at(lo).alias("__lo"), at(hi).alias("__hi"), F.max("__place").alias("__place"))
    part = F.col("__place") - F.floor("__place")
    value_at = F.when(part == 0, F.col("__lo")).otherwise(F.col("__lo") + (F.col("__hi") - F.col("__lo")) * part)
    return picked.select(*keys, value_at.alias(out))
