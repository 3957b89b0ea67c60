"""Streams that keep tables up to date: indexing, daily cost, rates and memory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators import chunks
from larkspur.operators.ordered import first_n, keep_first
from larkspur.session import Scratch
from larkspur.sources import sinks
from larkspur.streaming.topics import run_to_end

#: Buckets of a table of chunks.
BUCKETS = 64


def ingest_stream(
    docs: DataFrame,
    text: str,
    source: str,
    key: str,
    root: str,
    rejects: str,
    checkpoint: str,
    version: str | None = None,
    embed: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Documents to chunks to a table of (document, chunk) rows in buckets of ``key``.

    A document that arrives again under its key replaces all its chunks, also when
    its text is null now. Of several versions in one batch the one with the largest
    ``version`` counts. A chunk that two documents share has a row for each, so it
    stays while one of them holds it; ``current_chunks`` gives one row per chunk.
    The documents of a batch are shuffled once, by bucket; chunks and stored rows are not.
    ``embed`` adds a column ``vector`` to the chunks. Null texts, and chunks whose
    vector is null, go to ``rejects`` with a reason. Failed tasks are retried by
    Spark, and a repeated batch gives the same table.
    """

    def index(batch: DataFrame, batch_id: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            order = [F.desc(version)] if version else []
            bucket = sinks.bucket_column(BUCKETS)
            newest = keep_first(sinks.by_bucket(batch, key, BUCKETS), [bucket, key], [*order, F.desc_nulls_last(text)])
            batch = scratch.cut(newest, "batch", bucket)
            fresh = chunks.ingest(batch.where(F.col(text).isNotNull()), text, source)
            failed = batch.where(F.col(text).isNull()).select(F.col(key).cast("string").alias("key"), F.lit("no text").alias("reason"))
            if embed:
                fresh = scratch.cut(embed(fresh.drop(bucket)), "embedded")
                failed = failed.unionAll(
                    fresh.where(F.col("vector").isNull()).select(F.col(key).cast("string"), F.lit("no vector")).distinct()
                )
                fresh = fresh.where(F.col("vector").isNotNull())
            failed.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
            # chunks lie by the bucket of their document, as the batch does; an embedding may deal them out otherwise
            laid = sinks.by_bucket(fresh, key, BUCKETS) if embed else fresh
            sinks.replace_keys(batch.sparkSession, root, key, batch.select(key), laid, BUCKETS)

    return run_to_end(docs, index, checkpoint)


def current_chunks(spark: SparkSession, root: str, key: str) -> DataFrame:
    """One row per chunk: that of the document with the largest key."""
    return keep_first(current(spark, root), ["chunk_id"], [F.desc(key), F.desc("chunk_index")])


def count_late(batch: DataFrame, batch_id: int, ts: str, delay: str, late: str) -> None:
    """Write down how many rows of a batch are older than the newest of the batches before by more than ``delay``.

    One row a batch under ``late``: batch_id, rows, late_rows and the newest time so far.
    """
    spark = batch.sparkSession
    kind = "batch_id long, rows long, late_rows long, newest timestamp"
    known = spark.read.schema(kind).parquet(late) if sinks.exists(spark, late) else spark.createDataFrame([], kind)
    before = known.where(F.col("batch_id") < batch_id).agg(F.max("newest")).scalar()
    at = F.col(ts).cast("timestamp")
    row = batch.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(at < before - F.expr(f"INTERVAL {delay}"), F.lit(False))).alias("late_rows"),
        F.greatest(F.max(at), F.max(before)).alias("newest"),
    )
    row.write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, rows, late_rows and newest time of every batch of a running table."""
    return spark.read.schema("batch_id long, rows long, late_rows long, newest timestamp").parquet(f"{root}-late")


def running_table_stream(
    log: DataFrame,
    grouped: Callable[[DataFrame], DataFrame],
    keys: list[str],
    sums: list[str],
    root: str,
    checkpoint: str,
    ts: str = "ts",
    delay: str = "10 minutes",
) -> StreamingQuery:
    """Totals kept as a table: each batch is grouped on its own and added to the rows of its keys.

    ``grouped`` makes rows of ``keys`` and numeric ``sums`` from the rows of a batch. The table is the state, so none
    is held in memory and no row is dropped, however late: a late row is added to its key like any other, and
    counted in a table beside (``late_rows``). Each row keeps its totals before its last batch, so a repeated batch
    gives the same table.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        count_late(batch, batch_id, ts, delay, f"{root}-late")
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]
        new = grouped(batch).withColumn("key", F.concat_ws("|", *parts))

        def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
            zero = F.struct(*[F.lit(0).cast(new.schema[c].dataType).alias(c) for c in sums])
            if stored is None:
                return new.withColumns({"was": zero, "last_batch": F.lit(batch_id).cast("long")})
            was = F.when(F.col("last_batch") == batch_id, F.col("was")).otherwise(F.struct(*sums)).alias("was")
            base = stored.select(F.col("key").alias("stored_key"), was)
            met = new.join(base, new["key"] == base["stored_key"], "left").withColumn("was", F.coalesce("was", zero))
            added = met.withColumns({c: (F.col(c) + F.col(f"was.{c}")).cast(stored.schema[c].dataType) for c in sums})
            added = added.withColumn("last_batch", F.lit(batch_id).cast("long")).select(*stored.columns)
            return stored.join(new.select("key"), "key", "left_anti").select(*stored.columns).unionByName(added)

        sinks.merge_buckets(batch.sparkSession, root, "key", new, merge)

    return run_to_end(log, add, checkpoint)


def daily_cost_stream(usage: DataFrame, root: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Running cost per day and model. Columns: ts, model, cost_usd, total_tokens."""

    def daily(batch: DataFrame) -> DataFrame:
        return batch.groupBy(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("day"), "model").agg(
            F.sum("cost_usd").alias("cost"), F.sum("total_tokens").alias("tokens"), F.count(F.lit(1)).alias("calls")
        )

    return running_table_stream(usage, daily, ["day", "model"], ["cost", "tokens", "calls"], root, checkpoint, delay=delay)


def rate_windows(log: DataFrame, client: str, ts: str = "ts", size: str = "1 minute", slide: str = "10 seconds", delay: str = "10 minutes") -> DataFrame:
    """Requests per client in sliding windows, of a table or of a stream (which holds a window until ``delay`` after its end)."""
    return (
        log.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide), client)
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(F.col("window.start").alias("window_start"), client, "requests")
    )


def error_windows(log: DataFrame, ts: str = "ts", size: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Requests and errors in tumbling windows, of a table or of a stream. Columns: ts, is_error."""
    return (
        log.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, size))
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if("is_error").alias("errors"))
        .select(F.col("window.start").alias("window_start"), "requests", "errors")
    )


def over_error_limit(windows: DataFrame, error_pct: float = 5.0) -> DataFrame:
    """The windows whose error share is over the limit."""
    return windows.where(F.col("errors") * 100.0 / F.col("requests") > error_pct)


def memory_stream(messages: DataFrame, conversation: str, turn: str, root: str, checkpoint: str, n: int = 10) -> StreamingQuery:
    """The last n messages per conversation as a table.

    A repeated delivery of a turn is one row (the stored one stays). A batch is cut
    to n per conversation in the map tasks before it meets the stored rows, so one
    busy conversation stays small, and only the buckets of its conversations are
    written again.
    """

    def last(rows: DataFrame) -> DataFrame:
        return first_n(rows, [conversation], [F.desc(turn)], n)

    def keep(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c not in (conversation, turn)]
        once = keep_first(batch, [conversation, turn], [F.xxhash64(*rest)] if rest else [F.col(turn)])

        def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
            if stored is None:
                return new
            both = stored.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
            return last(keep_first(both, [conversation, turn], [F.col("__new")]).drop("__new"))

        sinks.merge_buckets(batch.sparkSession, root, conversation, last(once), merge)

    return run_to_end(messages, keep, checkpoint)


def current(spark: SparkSession, root: str) -> DataFrame:
    table = sinks.read_keyed(spark, root)
    if table is None:
        raise ValueError(f"nothing was written to {root}")
    return table
