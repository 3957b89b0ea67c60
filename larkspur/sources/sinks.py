"""Writes: files, layered tables, keyed upserts and deletes, publishing by partition."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.ordered import keep_first
from larkspur.session import CODEC, Scratch, remove
from larkspur.sources.files import format_of


def write_table(
    df: DataFrame,
    uri: str,
    fmt: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    **options,
) -> int:
    """Write files and return the row count, taken during the same job."""
    fmt = fmt or format_of(uri)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).options(**options)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(uri)
    return seen.get["rows"]


def write_split(checked: DataFrame, uri: str, invalid: Column, fmt: str = "parquet", partition_by: list[str] | None = None) -> tuple[int, int]:
    """Write valid and rejected rows in one job, apart by the partition column ``is_valid``; how many of each there are.

    The rows are read, checked and written once, and both numbers come from the job that writes.
    """
    seen = Observation()
    flagged = checked.withColumn("is_valid", ~invalid)
    counted = flagged.observe(seen, F.count_if("is_valid").alias("good"), F.count_if(~F.col("is_valid")).alias("bad"))
    counted.write.format(fmt).mode("overwrite").partitionBy("is_valid", *(partition_by or [])).save(uri)
    return seen.get["good"], seen.get["bad"]


def last_write_wins(incoming: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the one loaded last."""
    return keep_first(incoming, [key], order)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Existing rows not replaced, plus the last incoming row per key.

    The stored side meets only the incoming keys, in an anti join; it is neither
    sorted nor windowed.
    """
    fresh = last_write_wins(incoming, key, order).select(*existing.columns)
    untouched = existing.join(incoming.select(key), key, "left_anti").select(*existing.columns)
    return untouched.unionByName(fresh)


def delete_by_key(existing: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return existing.join(ids.select(key), key, "left_anti")


def key_or_position(df: DataFrame, key: str, order: list[Column], bucket: Column) -> DataFrame:
    """Fill a missing key with the row's 0-based position in its batch."""
    from larkspur.operators.ordered import numbered

    placed = numbered(df.withColumn("__one", F.lit(1)), ["__one"], order, bucket, "__pos")
    filled = F.coalesce(F.col(key).cast("string"), (F.col("__pos") - 1).cast("string"))
    return placed.withColumn(key, filled).drop("__one", "__pos")


def bronze_append(df: DataFrame, path: str, partition_by: list[str]) -> int:
    return write_table(df, path, "parquet", "append", partition_by)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Appended files may differ in columns; their schemas are merged."""
    return spark.read.option("mergeSchema", True).parquet(path)


def bronze_table(df: DataFrame, table: str, partition_by: list[str], path: str | None = None) -> None:
    """Append to a catalog table, made with the first rows; columns that are new are added to its schema.

    Readers take the schema from the catalog, so no file footer is opened for it; rows from before have nulls in the
    new columns, and rows without a column of the table get nulls there. ``path`` puts the files into a given folder.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.write.format("parquet").partitionBy(*partition_by)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    known = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    given = {c.lower() for c in df.columns}
    wanted = [F.col(f"`{f.name}`") if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(table).schema]
    df.select(*wanted).write.insertInto(table)


def silver_merge(
    spark: SparkSession, df: DataFrame, root: str, key: str, order: list[Column], buckets: int = 64
) -> DataFrame:
    """Create the table, or upsert by key: only the hash buckets that an incoming key falls into are read and written."""
    return merge_buckets(
        spark,
        root,
        key,
        df,
        lambda old, new: last_write_wins(new, key, order) if old is None else upsert_by_key(old, new, key, order),
        buckets,
    )


def merge_into_table(df: DataFrame, table: str, key: str) -> None:
    """Upsert into a catalog table whose format supports row-level changes."""
    source = df.alias("s")
    (
        source.mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def gold_publish(df: DataFrame, path: str, cluster_by: list[str], partition_by: list[str] | None = None) -> int:
    """Overwrite with rows range-clustered on the columns queries filter by, inside the partitions if there are any."""
    columns = [*(partition_by or []), *cluster_by]
    laid_out = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return write_table(laid_out, path, "parquet", "overwrite", partition_by)


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def _children(spark: SparkSession, path: str) -> list[str]:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(there)) if system.exists(there) else []


def _partitions(spark: SparkSession, root: str, column: str) -> list[int]:
    """Values of the partition column of a table of plain Parquet files, from the names of its folders."""
    return sorted(int(c.split("=")[1]) for c in _children(spark, root) if c.startswith(f"{column}="))


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a folder in the place of another one of the same file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(old).getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(path(old), True)
    if not system.rename(path(new), path(old)):
        raise OSError(f"{new} was not moved to {old}")


def bucket_column(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def read_keyed(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of a keyed table; None before the first write."""
    if not any(c.startswith("bucket_of_") for c in _children(spark, root)):
        return None
    table = spark.read.parquet(root)
    return table.drop(*[c for c in table.columns if c.startswith("bucket_of_")])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def by_bucket(df: DataFrame, key: str, buckets: int = 64) -> DataFrame:
    """The rows with the bucket column of a keyed table, dealt out by it."""
    column = bucket_column(buckets)
    return df.withColumn(column, bucket_of(key, buckets)).repartition(column)


def _table_column(spark: SparkSession, root: str, buckets: int) -> str:
    column = bucket_column(buckets)
    if any(c.startswith("bucket_of_") and not c.startswith(f"{column}=") for c in _children(spark, root)):
        raise ValueError(f"{root} has another number of buckets than {buckets}")
    return column


def _stored(spark: SparkSession, root: str, column: str, touched: list[int]) -> DataFrame | None:
    """The rows of some buckets; None before the first write."""
    return spark.read.parquet(root).where(F.col(column).isin(touched)) if _partitions(spark, root, column) else None


def _put(spark: SparkSession, root: str, column: str, touched: list[int], held: set[str] | None, parts: list[DataFrame]) -> DataFrame:
    """Write the new rows of the touched buckets, ``parts`` one after another, and put them in the place of the files ``held``."""
    if held is None:  # nothing is read that the write replaces
        (only,) = parts
        only.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(root, compression=CODEC)
        filled = set(touched)
    else:
        with Scratch(spark) as scratch:
            staged = f"{root}/.staged-{uuid.uuid4().hex}"  # hidden from readers, on the same file system
            scratch.paths.append(staged)
            for part in parts:
                part.write.mode("append").partitionBy(column).parquet(staged, compression=CODEC)
            filled = set(_partitions(spark, staged, column))
            if set(_stored(spark, root, column, touched).inputFiles()) != held:
                raise RuntimeError(f"another writer has changed {root} meanwhile")
            for number in sorted(filled):
                replace_folder(spark, f"{staged}/{column}={number}", f"{root}/{column}={number}")
    for gone in set(touched) - filled:
        remove(spark, f"{root}/{column}={gone}")
    if not _partitions(spark, root, column):
        return spark.createDataFrame([], parts[0].schema).drop(column)
    return spark.read.schema(parts[0].schema).parquet(root).drop(column)


def merge_buckets(
    spark: SparkSession,
    root: str,
    key: str,
    incoming: DataFrame,
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    buckets: int = 64,
) -> DataFrame:
    """Replace the rows of the buckets that incoming keys fall into by ``merge(their rows, incoming)``.

    The table is Parquet, partitioned by a hash of the key; reading prunes to the buckets, and the result is written once,
    beside them in a hidden folder, from which its partitions are moved into their places; the first rows are written at once. ``merge`` gets
    None for a table that does not exist yet. A job that fails before its end leaves the table as it was, and one
    repeated with the same rows gives the same table. One writer at a time: a bucket that another one has changed
    meanwhile is an error, and nothing is written. Many writers need a table format with row-level changes
    (``merge_into_table``). The number of buckets of a table stays as it was first given.
    """
    column = _table_column(spark, root, buckets)
    with Scratch(spark) as scratch:
        incoming = scratch.cut(incoming, "incoming")
        touched = sorted(r[0] for r in incoming.select(bucket_of(key, buckets)).distinct().collect())  # at most one row per bucket
        stored = _stored(spark, root, column, touched)
        held = None if stored is None else set(stored.inputFiles())
        merged = merge(None if stored is None else stored.drop(column), incoming)
        return _put(spark, root, column, touched, held, [by_bucket(merged, key, buckets)])


#: Bytes of keys that ``replace_keys`` ships to the tasks at a time, and files of a bucket from which on it lays out the stored rows anew.
KEYS_SHIPPED, FILES_PER_BUCKET = 32 << 20, 4


def _groups(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Buckets in groups of at most ``most`` bytes, or of one bucket."""
    groups, held = [], 0
    for number, size in sorted(sizes.items()):
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append(number)
        held += size
    return groups


def replace_keys(spark: SparkSession, root: str, key: str, keys: DataFrame, fresh: DataFrame, buckets: int = 64) -> DataFrame:
    """Replace all rows of ``keys`` in a keyed table by the rows ``fresh``, as ``merge_buckets`` does, shuffling neither.

    ``fresh`` has the bucket column and lies by it: it comes from ``by_bucket``, or from files partitioned by the column.
    Stored rows lie by it as they are read, and stay in the task that reads them: they meet the keys of their buckets, which
    are shipped to the tasks, those of some buckets at a time so that they are bounded. Only buckets of more keys than that
    are shuffled, and buckets that have come to many files, which are put together.
    """
    column = _table_column(spark, root, buckets)
    with Scratch(spark) as scratch:
        keys = scratch.cut(keys.select(key), "keys").withColumn(column, bucket_of(key, buckets))
        size = F.sum(F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 16)
        sizes = {r[0]: r[1] for r in keys.groupBy(column).agg(size).collect()}  # at most one row per bucket
        touched = sorted(sizes)
        stored = _stored(spark, root, column, touched)
        if stored is None:
            return _put(spark, root, column, touched, None, [fresh])
        held = set(stored.inputFiles())
        crowded = len(held) > FILES_PER_BUCKET * max(len(touched), stored.rdd.getNumPartitions())
        parts = [fresh]
        for group in _groups(sizes, KEYS_SHIPPED):
            shipped = sum(sizes[b] for b in group) <= KEYS_SHIPPED
            mine = keys.where(F.col(column).isin(group)).select(key)
            kept = delete_by_key(stored.where(F.col(column).isin(group)), F.broadcast(mine) if shipped else mine, key).select(*fresh.columns)
            parts.append(kept if shipped and not crowded else kept.repartition(column))
        return _put(spark, root, column, touched, held, parts)


def clear(spark: SparkSession, root: str) -> None:
    """Empty a keyed table; the next merge makes it anew."""
    remove(spark, root)


def publish(df: DataFrame, root: str, keep: int = 2) -> DataFrame:
    """Write the rows as the next ``version`` partition; readers take the last one, so they change over at once.

    A job that fails half-way adds no partition (dynamic partition overwrite moves a whole folder at its end), and
    readers of the version before keep their files until ``keep`` newer ones stand. An empty version is refused.
    """
    spark = df.sparkSession
    number = max(_partitions(spark, root, "version"), default=0) + 1
    seen = Observation()
    numbered = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(number))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(root)
    if not seen.get["rows"]:
        raise ValueError(f"an empty table was not published at {root}")
    for old in _partitions(spark, root, "version")[:-keep]:
        remove(spark, f"{root}/version={old}")
    return read_current(spark, root)


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The version published last, or None before the first one."""
    versions = _partitions(spark, root, "version")
    return spark.read.parquet(f"{root}/version={versions[-1]}") if versions else None


def export(df: DataFrame, uri: str, fmt: str = "csv", rows_per_file: int = 500_000) -> int:
    """Parallel CSV or JSON export with bounded files."""
    return write_table(df, uri, fmt, maxRecordsPerFile=rows_per_file)
