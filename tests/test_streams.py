"""Streams fed in several runs give what one batch over all rows gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import chunks
from larkspur.streaming import tables, topics


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_ingest_follows_changes(spark, tmp_path):
    schema = "doc_id int, source string, text string"
    src, root = f"{tmp_path}/in", f"{tmp_path}/chunks"

    def run():
        stream = topics.read_files(spark, src, schema)
        tables.ingest_stream(stream, "text", "source", "doc_id", root, f"{tmp_path}/bad", f"{tmp_path}/cp")
        return {(r.doc_id, r.chunk) for r in tables.current(spark, root).collect()}

    put(spark, src, [(1, "a", "x" * 1500), (2, "b", "two"), (3, "c", None), (4, "d", "  ")], schema)
    assert run() == {(1, "x" * 1000), (1, "x" * 700), (2, "two")}
    put(spark, src, [(1, "a", "new")], schema)
    assert run() == {(1, "new"), (2, "two")}
    assert run() == {(1, "new"), (2, "two")}
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 1
    assert chunks.not_blank(spark.createDataFrame([(" ",)], "t string"), "t").count() == 0


def test_daily_cost_keeps_running(spark, tmp_path):
    schema = "ts timestamp, model string, cost_usd decimal(18,6), total_tokens bigint"
    src, root = f"{tmp_path}/in", f"{tmp_path}/table"
    from decimal import Decimal as D

    def run():
        tables.daily_cost_stream(topics.read_files(spark, src, schema), root, f"{tmp_path}/cp", "5 days")
        return {(r.day, r.model): (float(r.cost), r.calls) for r in tables.current(spark, root).collect()}

    put(spark, src, [(dt.datetime(2024, 1, 1, 1), "m", D("0.5"), 3), (dt.datetime(2024, 1, 2, 1), "m", D("1"), 3)], schema)
    assert run() == {("2024-01-01", "m"): (0.5, 1), ("2024-01-02", "m"): (1.0, 1)}
    put(spark, src, [(dt.datetime(2024, 1, 1, 9), "m", D("0.25"), 3), (dt.datetime(2024, 1, 2, 2), "n", D("2"), 3)], schema)
    assert run() == {("2024-01-01", "m"): (0.75, 2), ("2024-01-02", "m"): (1.0, 1), ("2024-01-02", "n"): (2.0, 1)}


def test_memory_keeps_the_last_n(spark, tmp_path):
    schema = "c int, turn int, role string, text string"
    src, root = f"{tmp_path}/in", f"{tmp_path}/table"

    def run():
        tables.memory_stream(topics.read_files(spark, src, schema), "c", "turn", root, f"{tmp_path}/cp", 3)
        return {(r.c, r.turn) for r in tables.current(spark, root).collect()}

    put(spark, src, [(1, i, "user", "t") for i in range(5)] + [(2, 0, "user", "t")], schema)
    assert run() == {(1, 2), (1, 3), (1, 4), (2, 0)}
    put(spark, src, [(1, 5, "user", "t")], schema)
    assert run() == {(1, 3), (1, 4), (1, 5), (2, 0)}


def test_duplicates_across_runs_pass_once(spark, tmp_path):
    schema = "id int, ts timestamp"
    src = f"{tmp_path}/in"
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)

    def run():
        stream = topics.once(topics.read_files(spark, src, schema), "ts", "id", "1 hour")
        topics.run_to_end(stream, topics.batch_writer(f"{tmp_path}/out"), f"{tmp_path}/cp")
        return sorted(r.id for r in spark.read.schema("id int").parquet(f"{tmp_path}/out").collect())

    put(spark, src, [(1, at(0)), (1, at(0)), (2, at(1))], schema)
    assert run() == [1, 2]
    put(spark, src, [(2, at(1)), (3, at(5))], schema)
    assert run() == [1, 2, 3]


def test_a_repeated_batch_replaces_its_folder(spark, tmp_path):
    write = topics.batch_writer(f"{tmp_path}/out")
    for _ in range(2):
        write(spark.range(3), 7)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_bad_json_is_set_aside(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"id": 1}\n{"id": \nnot json\n{"id": 2, "more": 1}\n')
    stream = topics.read_files(spark, f"{tmp_path}/in", "value string", "text")
    topics.json_to_table(stream, schema, f"{tmp_path}/t", f"{tmp_path}/r", f"{tmp_path}/cp")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [1, 2]
    assert spark.read.parquet(f"{tmp_path}/r").count() == 2


def test_relay_marks_what_it_sent(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [(f"r{i}", "document", "created", "{}", at(i), at(0) if i == 0 else None) for i in range(6)]
    outbox = spark.createDataFrame(rows, "id string, aggregate_type string, event_type string, payload string, created_at timestamp, published_at timestamp")
    sent = topics.relay(spark, outbox, f"{tmp_path}/topics", f"{tmp_path}/ledger", cycles=4, limit=2)
    assert sent == 5
    out = spark.read.parquet(f"{tmp_path}/topics")
    assert {(r.topic, r.key) for r in out.collect()} == {("document.created", f"r{i}") for i in range(1, 6)}
    assert out.count() == 5
    # A later run goes on from the ledger.
    assert topics.relay(spark, outbox, f"{tmp_path}/topics", f"{tmp_path}/ledger", cycles=4, limit=2) == 0


def test_kafka_options():
    options = topics.kafka_options("h:9092", "docs", "g")
    assert options["subscribe"] == "docs" and options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "g"


@pytest.mark.parametrize("delay,expected", [("1 minute", 1), ("1 day", 0)])
def test_windows_wait_for_the_watermark(spark, tmp_path, delay, expected):
    schema = "ts timestamp, is_error boolean"
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    put(spark, f"{tmp_path}/in", [(at(0), True), (at(1), False), (at(30), False)], schema)
    stream = tables.error_windows(topics.read_files(spark, f"{tmp_path}/in", schema), delay=delay)
    topics.run_to_end(stream, topics.batch_writer(f"{tmp_path}/out"), f"{tmp_path}/cp")
    got = spark.read.schema("window_start timestamp, requests bigint, errors bigint").parquet(f"{tmp_path}/out")
    assert got.count() == expected


def test_rate_windows_slide(spark, tmp_path):
    schema = "ts timestamp, u int"
    base = dt.datetime(2024, 1, 1)
    rows = [(base, 1), (base + dt.timedelta(seconds=45), 1), (base + dt.timedelta(hours=2), 2)]
    put(spark, f"{tmp_path}/in", rows, schema)
    stream = tables.rate_windows(topics.read_files(spark, f"{tmp_path}/in", schema), "u").where(F.col("requests") > 1)
    topics.run_to_end(stream, topics.batch_writer(f"{tmp_path}/out"), f"{tmp_path}/cp")
    got = spark.read.schema("window_start timestamp, u int, requests bigint").parquet(f"{tmp_path}/out").collect()
    assert {r.window_start for r in got} == {base - dt.timedelta(seconds=s) for s in (0, 10)}
