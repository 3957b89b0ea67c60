"""Topic sources and sinks: JSON messages in, keyed messages out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from larkspur.session import cut_lineage
from larkspur.sources.sinks import exists


def kafka_options(servers: str, topic: str, group: str | None = None, from_start: bool = True) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_start else "latest",
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """(key, value) texts of a topic; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    """A growing folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def decoded(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON columns plus ``bad_json``: the text of a message that could not be read, else null."""
    wide = T.StructType([*schema.fields, T.StructField("bad_json", T.StringType())])
    parsed = F.from_json(F.col(value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_json"})
    return messages.select(parsed.alias("m")).select("m.*")


#: State on local disk, saved in the checkpoint: for keys that are kept long, and for keyed state with timers. A job
#: that runs to its end and stops leaves no open stores behind.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # one bound for all stores of an executor, whatever their number
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started inside; a query keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def run_to_end(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", conf: dict[str, str] | None = None
) -> StreamingQuery:
    """Process everything there is, batch by batch, then stop; a scheduler may call this again and again."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each)
    with settings(stream.sparkSession, conf or {}):
        query = writer.start()
    query.awaitTermination()
    return query


def batch_writer(target: str) -> Callable[[DataFrame, int], None]:
    """Each batch owns one folder and replaces it, so a repeated batch changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return write


def json_to_table(messages: DataFrame, schema: T.StructType, target: str, rejects: str, checkpoint: str) -> StreamingQuery:
    """Append readable messages to ``target`` and the others to ``rejects``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.persist(StorageLevel.DISK_ONLY)  # read and parsed once; what is lost is parsed again
        good = parsed.where(F.col("bad_json").isNull()).drop("bad_json")
        bad = parsed.where(F.col("bad_json").isNotNull()).select("bad_json")
        good.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        parsed.unpersist()

    return run_to_end(decoded(messages, schema), write, checkpoint)


def once(stream: DataFrame, ts: str, key: str, delay: str | None = None) -> DataFrame:
    """Each key once, however late it comes; keys are kept (run it with ``ROCKSDB``).

    With ``delay`` state is dropped after that time: each key once among the rows that arrive within ``delay`` of
    each other, and rows later than that are not passed on.
    """
    if delay is None:
        return stream.dropDuplicates([key])
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def messages_of(rows: DataFrame, aggregate: Column, event: Column, key: str, payload: Column) -> DataFrame:
    """(topic, key, value) with topic ``aggregate.event``."""
    return rows.select(
        F.concat_ws(".", aggregate, event).alias("topic"), F.col(key).cast("string").alias("key"), payload.alias("value")
    )


def publish_files(messages: DataFrame, path: str) -> None:
    """File form of a topic write: one folder per topic."""
    messages.write.mode("append").partitionBy("topic").parquet(path)


def relay_once(outbox: DataFrame, sent: DataFrame, limit: int | None = None) -> DataFrame:
    """Unpublished outbox rows not in the ``sent`` ledger: all of them, or the oldest ``limit``."""
    waiting = outbox.where(F.col("published_at").isNull()).join(sent.select("id"), "id", "left_anti")
    return waiting.orderBy("created_at", "id").limit(limit) if limit else waiting


def relay(spark: SparkSession, outbox: DataFrame, topics: str, ledger: str, cycles: int = 1, limit: int | None = None) -> int:
    """Publish what waits and write down what went out; a failed cycle leaves its rows for the next.

    Without ``limit`` one pass drains the outbox: rows of one key go out in order
    of creation, and keys are spread. A row is put into the ledger only after its
    write; a crash between the two sends it again (at least once), as the
    receiver's id check expects.
    """
    published = 0
    schema = T.StructType([T.StructField("id", outbox.schema["id"].dataType)])
    for _ in range(cycles):
        sent = spark.read.schema(schema).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], schema)
        # The picked rows are stored first: the write and the ledger must agree on them.
        picked = cut_lineage(relay_once(outbox, sent, limit).repartition("id").sortWithinPartitions("created_at", "id"), "picked")
        publish_files(messages_of(picked, F.col("aggregate_type"), F.col("event_type"), "id", F.col("payload")), topics)
        picked.select("id").write.mode("append").parquet(ledger)
        count = picked.count()
        published += count
        if limit is None or count < limit:
            break
    return published
