"""Cases that once gave wrong answers."""

import collections
import datetime as dt
import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from larkspur.operators import chunks, clean, evals, ordered, usage
from larkspur.operators.quality import FieldRule
from larkspur.plans.runs import Pipeline, run_etl
from larkspur.sources import sinks
from larkspur.sources.jdbc import JdbcRead
from larkspur.streaming import tables, topics

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


# ---- live index and memory ------------------------------------------------------------------------

DOC = "doc_id int, source string, text string, v int"


def index(spark, tmp_path, **options):
    stream = topics.read_files(spark, f"{tmp_path}/in", DOC)
    tables.ingest_stream(stream, "text", "source", "doc_id", f"{tmp_path}/chunks", f"{tmp_path}/bad", f"{tmp_path}/cp", **options)
    return tables.current(spark, f"{tmp_path}/chunks")


def test_a_shared_chunk_stays_while_one_document_holds_it(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(2, "a", "same", 1), (3, "b", "same", 1)], DOC)
    index(spark, tmp_path)
    put(spark, f"{tmp_path}/in", [(3, "b", "other", 2)], DOC)
    assert {(r.doc_id, r.chunk) for r in index(spark, tmp_path).collect()} == {(2, "same"), (3, "other")}
    assert {(r.doc_id, r.chunk) for r in tables.current_chunks(spark, f"{tmp_path}/chunks", "doc_id").collect()} == {(2, "same"), (3, "other")}


def test_the_newest_version_of_a_batch_wins_and_a_null_text_empties(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, "a", "z first", 1), (1, "a", "a second", 2), (4, "a", "four", 1)], DOC)
    assert {r.chunk for r in index(spark, tmp_path, version="v").collect()} == {"a second", "four"}
    put(spark, f"{tmp_path}/in", [(1, "a", None, 3)], DOC)
    assert {r.chunk for r in index(spark, tmp_path, version="v").collect()} == {"four"}
    assert {(r.key, r.reason) for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {("1", "no text")}


def test_chunks_without_a_vector_are_set_aside(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, "a", "good", 1), (2, "a", "bad", 1)], DOC)
    embed = lambda df: df.withColumn("vector", F.when(F.col("chunk") != "bad", F.array(F.lit(1.0))))
    assert {r.chunk for r in index(spark, tmp_path, embed=embed).collect()} == {"good"}
    assert {(r.key, r.reason) for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {("2", "no vector")}


def test_repeated_delivery_loses_no_message(spark, tmp_path):
    schema = "c int, turn int, role string"

    def run(rows):
        put(spark, f"{tmp_path}/in", rows, schema)
        tables.memory_stream(topics.read_files(spark, f"{tmp_path}/in", schema), "c", "turn", f"{tmp_path}/t", f"{tmp_path}/cp", 3)
        return sorted(r.turn for r in tables.current(spark, f"{tmp_path}/t").collect())

    assert run([(1, 1, "u"), (1, 2, "u"), (1, 3, "u"), (1, 3, "u"), (1, 3, "u")]) == [1, 2, 3]
    assert run([(1, 3, "u"), (1, 3, "u")]) == [1, 2, 3]
    assert run([(1, 4, "u")]) == [2, 3, 4]


def test_the_newest_windows_are_in_the_table(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    schema = "ts timestamp, is_error boolean"

    def run(rows):
        put(spark, f"{tmp_path}/in", rows, schema)
        log = topics.read_files(spark, f"{tmp_path}/in", schema)
        tables.running_table_stream(log, tables.error_windows, ["window_start"], ["requests", "errors"], f"{tmp_path}/t", f"{tmp_path}/cp")
        return {(r.window_start.minute, r.requests, r.errors) for r in tables.over_error_limit(tables.current(spark, f"{tmp_path}/t"), 40.0).collect()}

    assert run([(at(0), True), (at(1), False), (at(7), True)]) == {(0, 2, 1), (5, 1, 1)}
    assert run([(at(8), False), (at(9), False)]) == {(0, 2, 1)}


def test_no_row_of_a_year_out_of_order_is_lost(spark, tmp_path):
    """Two runs over a log of a year, the later one full of old rows: totals are those of all rows, the late ones are counted."""
    rng = random.Random(3)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(365 * 1440)), i % 3 == 0) for i in range(400)]
    schema = "ts timestamp, is_error boolean"

    def run(part):
        put(spark, f"{tmp_path}/in", part, schema)
        log = topics.read_files(spark, f"{tmp_path}/in", schema)
        tables.running_table_stream(log, tables.error_windows, ["window_start"], ["requests", "errors"], f"{tmp_path}/t", f"{tmp_path}/cp")

    run(rows[:200])
    run(rows[200:])
    want = collections.Counter()
    for ts, error in rows:
        want[ts.replace(minute=ts.minute // 5 * 5), "requests"] += 1
        want[ts.replace(minute=ts.minute // 5 * 5), "errors"] += error
    got = {(r.window_start, c): r[c] for r in tables.current(spark, f"{tmp_path}/t").collect() for c in ("requests", "errors")}
    assert got == dict(want)
    late = {r.batch_id: (r["rows"], r.late_rows) for r in tables.late_rows(spark, f"{tmp_path}/t").collect()}
    limit = max(ts for ts, _ in rows[:200]) - dt.timedelta(minutes=10)
    assert late == {0: (200, 0), 1: (200, sum(ts < limit for ts, _ in rows[200:]))}


def test_a_repeated_batch_is_added_once(spark, tmp_path, monkeypatch):
    """A batch that fails after its merge is done again with the same rows."""
    schema = "ts timestamp, is_error boolean"
    put(spark, f"{tmp_path}/in", [(dt.datetime(2024, 1, 1), True), (dt.datetime(2024, 1, 1, 0, 1), False)], schema)
    real, calls = sinks.merge_buckets, []

    def failing(*args, **kwargs):
        out = real(*args, **kwargs)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost after the write")
        return out

    monkeypatch.setattr(sinks, "merge_buckets", failing)

    def run():
        log = topics.read_files(spark, f"{tmp_path}/in", schema)
        tables.running_table_stream(log, tables.error_windows, ["window_start"], ["requests", "errors"], f"{tmp_path}/t", f"{tmp_path}/cp")

    run()
    put(spark, f"{tmp_path}/in", [(dt.datetime(2024, 1, 1, 0, 2), True), (dt.datetime(2024, 1, 1, 0, 7), True)], schema)
    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert sorted((r.requests, r.errors) for r in tables.current(spark, f"{tmp_path}/t").collect()) == [(1, 1), (3, 2)] and len(calls) == 3


def test_a_new_key_that_comes_late_passes_once(spark, tmp_path):
    schema = "id int, ts timestamp"

    def run(rows):
        put(spark, f"{tmp_path}/in", rows, schema)
        stream = topics.once(topics.read_files(spark, f"{tmp_path}/in", schema), "ts", "id")
        topics.run_to_end(stream, topics.batch_writer(f"{tmp_path}/out"), f"{tmp_path}/cp", conf=topics.ROCKSDB)
        return sorted(r.id for r in spark.read.schema("id int").parquet(f"{tmp_path}/out").collect())

    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    assert run([(1, day(300)), (2, day(200)), (1, day(300))]) == [1, 2]
    assert run([(3, day(0)), (1, day(300)), (2, day(200))]) == [1, 2, 3]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


# ---- keyed and published tables -------------------------------------------------------------------


def files_of(spark, root):
    return set(spark.read.parquet(root).inputFiles())


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = f"{tmp_path}/t"
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert sinks.silver_merge(spark, rows, root, "k", [F.col("v")]).count() == 500
    old = files_of(spark, root)
    change = spark.createDataFrame([(7, "b"), (1000, "new")], "k long, v string")
    after = sinks.silver_merge(spark, change, root, "k", [F.col("v")])
    assert 0 < len(files_of(spark, root) - old) <= 2 and len(files_of(spark, root) & old) >= 50
    assert after.where("k = 7").first().v == "b" and after.count() == 501 and sinks.read_keyed(spark, root).count() == 501


def test_a_failed_merge_leaves_the_table_and_a_repeated_one_changes_nothing(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert sinks.read_keyed(spark, root) is None
    sinks.silver_merge(spark, spark.range(50).withColumn("v", F.lit("a")), root, "id", [F.col("v")])
    broken = spark.range(60).withColumn("v", F.when(F.col("id") == 55, F.raise_error(F.lit("boom")).cast("string")).otherwise("b"))
    with pytest.raises(Exception, match="boom"):
        sinks.silver_merge(spark, broken, root, "id", [F.col("v")])
    assert {tuple(r) for r in sinks.read_keyed(spark, root).groupBy("v").count().collect()} == {("a", 50)}
    for _ in range(2):
        sinks.silver_merge(spark, spark.range(10).withColumn("v", F.lit("c")), root, "id", [F.col("v")])
        assert {tuple(r) for r in sinks.read_keyed(spark, root).groupBy("v").count().collect()} == {("a", 40), ("c", 10)}
    with pytest.raises(ValueError):
        sinks.silver_merge(spark, spark.range(1).withColumn("v", F.lit("d")), root, "id", [F.col("v")], buckets=8)


def test_a_second_writer_fails_and_emptied_buckets_go(spark, tmp_path):
    root = f"{tmp_path}/t"
    rows = spark.range(20)
    sinks.merge_buckets(spark, root, "id", rows, lambda old, new: new, 4)

    def slow(old, new):
        sinks.merge_buckets(spark, root, "id", rows.where("id < 5"), lambda o, n: o.union(n), 4)  # another one comes in between
        return new

    with pytest.raises(RuntimeError, match="another writer"):
        sinks.merge_buckets(spark, root, "id", rows.where("id < 5"), slow, 4)
    assert sinks.read_keyed(spark, root).count() == 25
    sinks.merge_buckets(spark, root, "id", rows, lambda old, new: old.limit(0), 4)
    assert sinks.read_keyed(spark, root) is None
    assert sinks.merge_buckets(spark, root, "id", rows, lambda old, new: new if old is None else old, 4).count() == 20


def test_old_versions_are_removed(spark, tmp_path):
    root = f"{tmp_path}/t"
    for n in range(1, 6):
        sinks.publish(spark.range(n), root)
    names = sorted(os.listdir(root))
    assert [x for x in names if x.startswith("version=")] == ["version=4", "version=5"] and sinks.read_current(spark, root).count() == 5
    with pytest.raises(ValueError):
        sinks.publish(spark.range(0), root)
    assert sinks.read_current(spark, root).count() == 5


# ---- values ---------------------------------------------------------------------------------------


def test_quantiles_with_nan_and_infinity(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", float("nan")), ("b", float("-inf")), ("b", float("inf")), ("b", 3.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.q for r in ordered.exact_quantile(df, ["k"], "v", 0.5, "q").collect()}
    assert got == {"a": 2.0, "b": 3.0}
    top = {r.k: r.q for r in ordered.exact_quantile(df, ["k"], "v", 1.0, "q").collect()}
    assert math.isnan(top["a"]) and top["b"] == float("inf")


def test_first_n_above_the_limit_takes_maps_and_reads_the_setting(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    assert ordered.first_n(df, ["k"], [F.col("id")], 1500).count() == 1500
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        small = ordered.first_n(df, ["k"], [F.col("id")], 3)
        assert sorted(r.id for r in small.collect()) == [0, 1, 2]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_majority_of_a_null_prompt(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "x", 2), ("p", "y", 3)], "p string, a string, o int")
    assert {(r.p, r.majority) for r in evals.majority_answer(df, "p", "a", ["o"]).collect()} == {(None, "x"), ("p", "y")}


def test_requests_of_unknown_size_are_admitted(spark):
    df = spark.createDataFrame([("t", 1, 1, 5), ("t", 1, 2, None), ("t", 1, 3, 0), ("t", 1, 4, 99)], "t string, d int, o int, n int")
    assert sorted(r.o for r in usage.daily_budget(df, "t", "d", ["o"], "n", 10).collect()) == [1, 2, 3]


def test_an_empty_jdbc_table_has_no_bounds():
    options = JdbcRead("jdbc:x://h/d?table=t", column="id", partitions=8).options(None, None)
    assert "partitionColumn" not in options and "None" not in options.values()


def test_metadata_is_judged_by_type(spark):
    df = spark.createDataFrame([('{"a": "[draft] x", "b": [1], "c": {"d": 1}, "e": 2, "f": null, "g": "{x", "h": true}',)], "m string")
    assert df.select(clean.scalar_metadata("m")).first()[0] == {"a": "[draft] x", "e": "2", "g": "{x", "h": "true"}


def test_codes_of_names_with_a_common_start(spark):
    names = [f"Customer#{i:05d}" for i in range(700)]
    df = spark.createDataFrame([(n, "x", dt.datetime(2024, 1, 1)) for n in reversed(names)], "c string, t string, ts timestamp")
    got = {r.c: r.category_code for r in clean.build_features(df, "t", "ts", "c").collect()}
    assert got == {n: i for i, n in enumerate(names)}


@pytest.mark.parametrize("size,overlap", [(1000, 200), (10, 0), (10, 9), (7, 5), (50, 10), (3, 1)])
def test_fixed_chunks_equal_slices(spark, size, overlap):
    texts = ["", "x", "ab\ncd" * 30, "é\U0001f600" * 101, "z" * size, "z" * (size + 1), None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {(r.i, r.chunk_index): (r.chunk_start, r.chunk) for r in chunks.chunk_fixed(df, "t", size, overlap).collect()}
    step = size - overlap
    want = {(i, k): (a, t[a : a + size]) for i, t in enumerate(texts) if t for k, a in enumerate(range(0, len(t), step))}
    assert got == want


def test_all_references_are_decoded(spark):
    df = spark.createDataFrame([("<body>it&#8217;s caf&eacute; &mdash; &apos;x&apos; &#x1F600; &amp;lt; &nbsp;&copy;</body>",)], "h string")
    assert df.select(chunks.page_text(F.col("h"))).first()[0] == "it’s café — 'x' \U0001f600 &lt; ©"


# ---- runs -----------------------------------------------------------------------------------------


class Idle(Pipeline):
    name = "idle"

    def extract(self):
        return self.spark.range(5)

    def load(self, df):
        return 0


def test_a_load_without_a_job_does_not_hang(spark):
    row = Idle(spark).run().first()
    assert (row.status, row.records_processed) == ("success", 0)


def test_load_mode_counts_invalid_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    done = run_etl(df, f"{tmp_path}/o.parquet", [FieldRule("v", "str", False)], "id")
    assert (done.status, done.records_written, done.records_invalid) == ("success", 2, 1)
    assert spark.read.parquet(f"{tmp_path}/o.parquet").columns == ["id", "v"]


def test_workers_find_the_package_from_another_folder(tmp_path, small_dir):
    """Python functions run in workers that were started elsewhere, without PYTHONPATH."""
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from larkspur.session import build_session
from larkspur.plans import all_queries
spark = build_session("elsewhere", "local[2]", 2)
for name in ("chunk_sentence", "injection_scan_json", "vector_topk"):
    print(name, all_queries()[name](spark, {small_dir.replace('sf0.01', 'sf0.001')!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0 and done.stdout.count("\n") >= 3, done.stderr[-2000:]


def test_a_merge_writes_its_result_once(spark, tmp_path, monkeypatch):
    root, labels, cut = f"{tmp_path}/t", [], sinks.Scratch.cut
    monkeypatch.setattr(sinks.Scratch, "cut", lambda self, df, label="cut": labels.append(label) or cut(self, df, label))
    sinks.silver_merge(spark, spark.range(40).withColumn("v", F.lit("a")), root, "id", [F.col("v")], 4)
    sinks.silver_merge(spark, spark.range(10, 50).withColumn("v", F.lit("b")), root, "id", [F.col("v")], 4)
    assert labels == ["incoming", "incoming"]
    assert {(r.id, r.v) for r in sinks.read_keyed(spark, root).collect()} == {(i, "a" if i < 10 else "b") for i in range(50)}
    assert not [f for f in os.listdir(root) if f.startswith(".staged")]


def exchanges(df):
    """Shuffles and shipped tables in the plan of a frame."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("BroadcastExchange")


def put_parts(monkeypatch):
    """What the merges write, as frames, in order."""
    parts, real = [], sinks._put
    monkeypatch.setattr(sinks, "_put", lambda *args: parts.extend(args[-1]) or real(*args))
    return parts


def test_a_batch_is_shuffled_once_and_stored_chunks_are_not(spark, tmp_path, monkeypatch):
    parts = put_parts(monkeypatch)
    put(spark, f"{tmp_path}/in", [(i, "a", "text of " * 200 + str(i), 1) for i in range(300)], DOC)
    index(spark, tmp_path, version="v")
    put(spark, f"{tmp_path}/in", [(i, "a", None if i % 2 else "newer", v) for i in range(60) for v in (3, 2)], DOC)
    rows = index(spark, tmp_path, version="v")
    assert [exchanges(p) for p in parts] == [(0, 0), (0, 0), (0, 1)]
    assert {(r.doc_id, r.chunk) for r in rows.where("doc_id < 60").collect()} == {(i, "newer") for i in range(0, 60, 2)}
    assert rows.where("doc_id >= 60").groupBy("doc_id").count().where("count = 3").count() == 240


@pytest.mark.parametrize(("most", "groups", "shuffled"), [(1 << 20, 1, False), (4500, 4, False), (10, 8, True)])
def test_keys_are_shipped_some_buckets_at_a_time(spark, tmp_path, monkeypatch, most, groups, shuffled):
    root = f"{tmp_path}/t"
    old = spark.range(400).select("id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("v"))
    keys = spark.range(100, 500)
    sinks.replace_keys(spark, root, "id", old.select("id").distinct(), sinks.by_bucket(old, "id", 8), 8)
    monkeypatch.setattr(sinks, "KEYS_SHIPPED", most)
    parts = put_parts(monkeypatch)
    fresh = spark.range(200, 450).withColumn("v", F.lit("c"))
    for _ in range(2):  # a repeated one changes nothing
        out = sinks.replace_keys(spark, root, "id", keys.union(keys), sinks.by_bucket(fresh, "id", 8), 8)
        wanted = {(i, v) for i in range(100) for v in "ab"} | {(i, "c") for i in range(200, 450)}
        got = [tuple(r) for r in out.collect()]
        assert set(got) == wanted and len(got) == len(wanted)
    assert len(parts) == 2 * (1 + groups)
    assert all((exchanges(p)[0] > 0) == shuffled for i, p in enumerate(parts) if i % (1 + groups))


def test_buckets_of_many_files_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILES_PER_BUCKET", 1)
    for n in range(5):
        rows = spark.range(100 * n, 100 * n + 100)
        sinks.replace_keys(spark, f"{tmp_path}/t", "id", rows, sinks.by_bucket(rows, "id", 16), 16)
    table = sinks.read_keyed(spark, f"{tmp_path}/t")
    assert table.distinct().count() == table.count() == 500
    assert len(files_of(spark, f"{tmp_path}/t")) <= 32  # of each bucket those put together, and those of the last merge


def test_keys_that_are_null_and_texts_that_are_gone(spark, tmp_path):
    root, kind = f"{tmp_path}/t", "k string, v string"
    rows = spark.createDataFrame([("x", "1"), (None, "2"), ("y", "3")], kind)
    sinks.replace_keys(spark, root, "k", rows.select("k"), sinks.by_bucket(rows, "k", 4), 4)
    gone = spark.createDataFrame([("x",), ("y",)], "k string")
    sinks.replace_keys(spark, root, "k", gone, sinks.by_bucket(rows.limit(0), "k", 4), 4)
    assert [tuple(r) for r in sinks.read_keyed(spark, root).collect()] == [(None, "2")]
