"""Schema validation, expectations, profiles and schema differences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names the validator knows.
KNOWN_TYPES = {
    "str": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
}


@dataclass(frozen=True)
class FieldRule:
    name: str
    type: str
    nullable: bool = True


def type_name(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StringType):
        return "str"
    if isinstance(data_type, T.BooleanType):
        return "bool"
    if isinstance(data_type, T.IntegralType):
        return "int"
    if isinstance(data_type, (T.FractionalType,)):
        return "float"
    return data_type.simpleString()


def _wrong_type(df: DataFrame, rule: FieldRule, python_compat: bool) -> Column:
    """True where a present value is not of the declared type; unknown type names pass."""
    if rule.type not in KNOWN_TYPES:
        return F.lit(False)
    have = type_name(df.schema[rule.name].dataType)
    if have == rule.type or (python_compat and have == "bool" and rule.type == "int"):
        return F.lit(False)
    if have == "str":
        return F.col(rule.name).isNotNull() & F.col(rule.name).try_cast(KNOWN_TYPES[rule.type]).isNull()
    if not python_compat and have == "int" and rule.type == "float":
        return F.lit(False)
    return F.col(rule.name).isNotNull()


def row_errors(df: DataFrame, rules: list[FieldRule], record: str, python_compat: bool = False) -> Column:
    """Array of (field, rule, message) found in a row; one projection, no UDF."""
    found = []
    label = F.col(record).cast("string")
    for rule in rules:
        if rule.name not in df.columns:
            missing = not rule.nullable
            tests = [("null", F.lit(missing), "is null but not nullable")]
        else:
            tests = [
                ("null", F.col(rule.name).isNull() & F.lit(not rule.nullable), "is null but not nullable"),
                ("type", _wrong_type(df, rule, python_compat), f"expected {rule.type}"),
            ]
        for kind, failed, text in tests:
            message = F.concat(F.lit("Record "), label, F.lit(f": field '{rule.name}' {text}"))
            found.append(
                F.when(
                    failed,
                    F.struct(F.lit(rule.name).alias("field"), F.lit(kind).alias("rule"), message.alias("message")),
                )
            )
    return F.filter(F.array(*found), lambda e: e.isNotNull())


def validate_schema(
    df: DataFrame, rules: list[FieldRule], record: str, python_compat: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(summary, errors). A record with any error counts once; no rows is valid."""
    checked = df.withColumn("errors", row_errors(df, rules, record, python_compat))
    failed = F.count_if(F.size("errors") > 0)
    total = F.count(F.lit(1))
    summary = checked.agg(
        (failed == 0).alias("is_valid"),
        total.alias("total_records"),
        (total - failed).alias("valid_records"),
        failed.alias("invalid_records"),
    )
    errors = checked.select(F.col(record).alias("record"), F.explode("errors").alias("e")).select("record", "e.*")
    return summary, errors


def split_valid(df: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without and with errors; both read the same lazy frame."""
    checked = df.withColumn("errors", errors)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


@dataclass(frozen=True)
class Expectation:
    """``kind``: not_null, length_between, in_set, value_between or unique."""

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()

    def failure(self) -> Column:
        c = F.col(self.column)
        measured = F.length(c) if self.kind == "length_between" else c
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(*self.values)
        low = measured < self.low if self.low is not None else F.lit(False)
        high = measured > self.high if self.high is not None else F.lit(False)
        return c.isNotNull() & (low | high)


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """How many rows hold a value that another row holds too.

    Hashes are counted first; only rows whose hash occurs more than once are compared by value.
    """
    hashes = ["__h1", "__h2"]
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("__value"))
    named = values.withColumns({h: F.xxhash64("__value", F.lit(i)) for i, h in enumerate(hashes)})
    twice = named.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(*hashes)
    counts = named.join(twice, hashes, "left_semi").groupBy(*hashes, "__value").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1).agg(F.coalesce(F.sum("n"), F.lit(0)))


def expectations(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation: checked, failed and success, from one pass plus one per uniqueness check."""
    counters = []
    for i, e in enumerate(suite):
        if e.kind == "unique":
            counters.append((f"f{i}", _repeated(df, e.column).scalar()))
        else:
            counters.append((f"f{i}", None))
    aggs = [F.count_if(suite[i].failure()).alias(n) for i, (n, s) in enumerate(counters) if s is None]
    one = df.agg(F.count(F.lit(1)).alias("checked"), *aggs)
    for name, scalar in counters:
        if scalar is not None:
            one = one.withColumn(name, scalar)
    parts = ", ".join(f"'{e.kind}', '{e.column}', f{i}" for i, e in enumerate(suite))
    rows = one.select("checked", F.expr(f"stack({len(suite)}, {parts}) as (expectation, column_name, failed)"))
    return rows.withColumn("success", F.col("failed") == 0)


def require(results: DataFrame) -> None:
    """Fail the run when an expectation failed."""
    broken = [f"{r.expectation}({r.column_name}): {r.failed}" for r in results.where(~F.col("success")).collect()]
    if broken:
        raise ValueError("expectations failed: " + ", ".join(broken))


def infer_schema(df: DataFrame) -> DataFrame:
    """(name, type, nullable) where nullable tells whether the data hold a null."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    parts = ", ".join(f"'{f.name}', '{type_name(f.dataType)}', `{f.name}` > 0" for f in df.schema)
    return nulls.select(F.expr(f"stack({len(df.columns)}, {parts}) as (name, type, nullable)"))


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Fields added, removed, retyped or changed in nullability between two schema frames."""
    b = before.select(F.col("name"), F.col("type").alias("old_type"), F.col("nullable").alias("old_nullable"))
    a = after.select(F.col("name"), F.col("type").alias("new_type"), F.col("nullable").alias("new_nullable"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .when(F.col("old_nullable") != F.col("new_nullable"), "nullability")
    )
    return (
        b.join(a, "name", "full_outer")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select("name", "change", "old_type", "new_type")
    )


def dataset_profile(df: DataFrame) -> DataFrame:
    """Row count and field names in one row."""
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        "record_count", F.lit(len(df.columns)).alias("field_count"), F.lit(",".join(df.columns)).alias("fields")
    )


def file_sizes(df: DataFrame) -> DataFrame:
    """Total bytes and number of the files behind a file scan."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size").alias("size_bytes"), F.count(F.lit(1)).alias("files"))


def nested_total_errors(items: Column, amount: str, total: Column, item_cap: float, tolerance: float = 0.1) -> Column:
    """For a row with a bounded nested list: item above its cap, total not equal to the sum."""
    over = F.exists(items, lambda x: x[amount] > item_cap)
    summed = F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x[amount])
    return F.filter(
        F.array(
            F.when(over, F.lit("item above cap")),
            F.when(F.abs(summed - total) > tolerance, F.lit("total differs from sum")),
        ),
        lambda e: e.isNotNull(),
    )
