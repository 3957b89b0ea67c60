"""Sources, sinks, cleaning, validation and load runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import clean, governance, quality
from larkspur.operators.quality import Expectation, FieldRule
from larkspur.plans.runs import Pipeline, pipeline_named, run_etl
from larkspur.sources import files, jdbc, sinks


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, value string")


@pytest.mark.parametrize(
    "uri,fmt",
    [("/x/a.csv", "csv"), ("/x/json/part", "json"), ("/x/orc/", "orc"), ("s3a://b/t.parquet", "parquet"), ("/x/delta/t", "delta"), ("/x/plain", "parquet"), ("/x/a.CSV", "parquet")],
)
def test_format_of(uri, fmt):
    assert files.format_of(uri) == fmt


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_round_trip_counts_in_the_write(spark, rows, tmp_path, fmt):
    path = f"{tmp_path}/t.{fmt}"
    assert sinks.write_table(rows, path) == 3
    back = files.read_table(spark, path)
    assert sorted((int(r.id), r.value) for r in back.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sinks.write_table(rows, path, mode="append") == 3
    assert files.read_table(spark, path).count() == 6


def test_empty_write_returns_zero(spark, rows, tmp_path):
    assert sinks.write_table(rows.limit(0), f"{tmp_path}/e.json") == 0


def test_csv_strings_and_described_schema(spark, rows, tmp_path):
    path = f"{tmp_path}/t.csv"
    sinks.write_table(rows, path)
    assert dict(files.read_table(spark, path, infer=False).dtypes) == {"id": "string", "value": "string"}
    described = {r.name: r.type for r in files.describe_source(spark, path).collect()}
    assert described == {"id": "int", "value": "string"}


def test_multi_line_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1},\n {"id": 2}]')
    assert files.read_table(spark, f"{tmp_path}/a.json", multiLine=True).count() == 2


def test_partitions_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(1, "eu"), (2, "us")], "id int, region string")
    sinks.write_table(df, f"{tmp_path}/p", partition_by=["region"])
    one = files.read_table(spark, f"{tmp_path}/p").where("region = 'eu'")
    assert "PartitionFilters: [isnotnull(region" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_corpus_sets_bad_bytes_aside(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("héllo")
    (tmp_path / "sub" / "b.txt").write_bytes(b"\xff\xfe\x00bad")
    (tmp_path / "c.md").write_text("skip")
    good, bad = files.read_corpus(spark, str(tmp_path), "*.txt")
    assert [r.text for r in good.collect()] == ["héllo"]
    assert [r.path[-5:] for r in bad.collect()] == ["b.txt"]


def test_file_admission(spark, tmp_path):
    (tmp_path / "ok.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "fake.png").write_bytes(b"not a png")
    (tmp_path / "x.exe").write_bytes(b"MZ")
    (tmp_path / "noext").write_bytes(b"a")
    (tmp_path / "big.pdf").write_bytes(b"%PDF" + b"0" * 50)
    scanned = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length", "content")
    # The scan lists no empty file, so that row is made by hand.
    empty = spark.createDataFrame([("/x/empty.jpg", 0, b"")], "path string, length bigint, content binary")
    found = scanned.unionByName(empty)
    out = {r.path.split("/")[-1]: r.reject_reason for r in files.file_admission(found, max_bytes=40).collect()}
    assert out == {
        "ok.pdf": None, "fake.png": "type does not match extension", "empty.jpg": "empty",
        "x.exe": "extension not allowed", "noext": "no extension", "big.pdf": "too large",
    }


def test_jdbc_uri():
    url, table = jdbc.parse_jdbc_uri("jdbc:postgresql://localhost:5432/mydb?table=public.users")
    assert (url, table) == ("jdbc:postgresql://localhost:5432/mydb", "public.users")
    url, table = jdbc.parse_jdbc_uri("jdbc:postgresql://me:pw@h:1/d?ssl=true&table=t")
    assert (url, table) == ("jdbc:postgresql://h:1/d?ssl=true", "t")
    assert jdbc.parse_jdbc_uri("jdbc:mysql://h/d")[1] is None
    with pytest.raises(ValueError):
        jdbc.parse_jdbc_uri("http://h/d")


def test_jdbc_options():
    read = jdbc.JdbcRead("jdbc:postgresql://h/d?table=t", column="id", partitions=8, credentials={"user": "u", "password": None})
    got = read.options(5, 900)
    assert got["partitionColumn"] == "id" and got["numPartitions"] == "8"
    assert (got["lowerBound"], got["upperBound"], got["fetchsize"], got["user"]) == ("5", "900", "10000", "u")
    assert "password" not in got
    assert read.bounds_query() == "SELECT min(id) AS lo, max(id) AS hi FROM t"
    assert jdbc.JdbcRead("jdbc:x://h/d", query="SELECT 1").options()["dbtable"] == "(SELECT 1) AS subq"
    assert jdbc.write_options("jdbc:x://h/d?table=t", user="u")["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc.JdbcRead("jdbc:x://h/d").options()


def test_upsert_and_delete(spark, rows):
    incoming = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (9, "z", 3)], "id int, value string, o int")
    out = sinks.upsert_by_key(rows, incoming, "id", [F.desc("o")]).collect()
    assert {(r.id, r.value) for r in out} == {(1, "a"), (2, "y"), (3, "c"), (9, "z")}
    assert sinks.delete_by_key(rows, rows.where("id < 3"), "id").count() == 1


def test_missing_keys_take_their_position(spark):
    df = spark.createDataFrame([(0, "k"), (1, None), (2, None)], "pos int, id string")
    out = sinks.key_or_position(df, "id", [F.col("pos")], F.floor(F.col("pos") / 2)).orderBy("pos").collect()
    assert [r.id for r in out] == ["k", "1", "2"]


def test_versions_switch_and_survive_a_failed_write(spark, rows, tmp_path):
    root = f"{tmp_path}/v"
    assert sinks.read_current(spark, root) is None
    sinks.publish(rows, root)
    broken = rows.withColumn("value", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        sinks.publish(broken, root)
    assert sinks.read_current(spark, root).count() == 3
    sinks.publish(rows.limit(1), root)
    assert sinks.read_current(spark, root).count() == 1


def test_clean(spark):
    df = spark.createDataFrame([(1, " Alice ", 30), (2, " Bob ", 25), (3, "Alice", 30), (4, None, 1)], "o int, name string, age int")
    out = clean.clean(df, [F.col("o")], null_columns=["name"], dedup_columns=["name", "age"]).orderBy("o").collect()
    assert [(r.o, r.name) for r in out] == [(1, "Alice"), (2, "Bob")]


def test_nan_is_not_null(spark):
    assert clean.drop_nulls(spark.createDataFrame([(float("nan"),), (None,)], "x double")).count() == 1


RULES = [FieldRule("id", "int", False), FieldRule("age", "int"), FieldRule("email", "str"), FieldRule("x", "unknown")]


def test_validate(spark):
    df = spark.createDataFrame([(1, "5", None, 1), (None, "not_a_number", "e", 2)], "id int, age string, email string, x int")
    summary, errors = quality.validate_schema(df.withColumn("rec", F.coalesce("id", F.lit(9))), RULES, "rec")
    assert tuple(summary.first()) == (False, 2, 1, 1)
    assert sorted((r.field, r.rule) for r in errors.collect()) == [("age", "type"), ("id", "null")]
    assert errors.where("field = 'id'").first().message == "Record 9: field 'id' is null but not nullable"
    assert quality.validate_schema(df.limit(0), RULES, "x")[0].first().is_valid


def test_validate_missing_field(spark):
    df = spark.createDataFrame([(1,)], "a int")
    _, errors = quality.validate_schema(df, [FieldRule("b", "str", False), FieldRule("c", "str")], "a")
    assert [r.field for r in errors.collect()] == ["b"]


def test_bool_counts_as_int_only_when_asked(spark):
    df = spark.createDataFrame([(True, 1)], "b boolean, i int")
    strict = quality.validate_schema(df, [FieldRule("b", "int")], "i")[0].first()
    loose = quality.validate_schema(df, [FieldRule("b", "int")], "i", python_compat=True)[0].first()
    assert (strict.is_valid, loose.is_valid) == (False, True)
    whole = quality.validate_schema(df, [FieldRule("i", "float")], "i", python_compat=True)[0].first()
    assert whole.is_valid is False


def test_expectations(spark):
    df = spark.createDataFrame([(1, "web"), (1, "fax"), (None, "api")], "id int, src string")
    suite = [Expectation("not_null", "id"), Expectation("unique", "id"), Expectation("in_set", "src", values=("web", "api")), Expectation("value_between", "id", 0, 5)]
    out = quality.expectations(df, suite)
    assert [r.failed for r in out.collect()] == [1, 2, 1, 0]
    with pytest.raises(ValueError, match="unique"):
        quality.require(out)


def test_nested_totals(spark):
    df = spark.createDataFrame([([(8.0,), (41.0,)], 49.0), ([(8.0,)], 9.0)], "tasks array<struct<hours: double>>, total double")
    out = [r[0] for r in df.select(quality.nested_total_errors(F.col("tasks"), "hours", F.col("total"), 40)).collect()]
    assert out == [["item above cap"], ["total differs from sum"]]


def test_file_sizes(spark, rows, tmp_path):
    sinks.write_table(rows.coalesce(1), f"{tmp_path}/s")
    one = quality.file_sizes(files.read_table(spark, f"{tmp_path}/s")).first()
    assert one.files == 1 and one.size_bytes > 0


class Doubler(Pipeline):
    name = "doubler"

    def __init__(self, spark, df, path, fail=False):
        super().__init__(spark)
        self.df, self.path, self.fail = df, path, fail

    def extract(self):
        return self.df

    def transform(self, df):
        if self.fail:
            raise ValueError("no rows today")
        return df.where("id > 1")

    def load(self, df):
        return sinks.write_table(df, self.path)


def test_run_metrics(spark, rows, tmp_path):
    ok = Doubler(spark, rows, f"{tmp_path}/o").run().first()
    assert (ok.status, ok.records_read, ok.records_processed, ok.errors) == ("success", 3, 2, [])
    bad = Doubler(spark, rows, f"{tmp_path}/b", fail=True).run().first()
    assert (bad.status, bad.records_processed, len(bad.errors)) == ("failed", 0, 1)
    assert "no rows today" in bad.errors[0]


def test_jobs_are_found_by_name():
    import larkspur.plans.quality  # noqa: F401

    assert pipeline_named("sp_migration").name == "sp_migration"
    with pytest.raises(KeyError):
        pipeline_named("nothing")


@pytest.mark.parametrize("mode,written,set_aside,status", [("load", 3, 0, "success"), ("quarantine", 2, 1, "partial"), ("fail", 0, 0, "failed")])
def test_etl_modes(spark, rows, tmp_path, mode, written, set_aside, status):
    df = rows.withColumn("value", F.when(F.col("id") > 1, F.col("value")))
    out = run_etl(df, f"{tmp_path}/t", [FieldRule("value", "str", False)], "id", mode, f"{tmp_path}/q")
    assert (out.records_written, out.records_quarantined, out.status) == (written, set_aside, status)
    if mode == "quarantine":
        assert spark.read.parquet(f"{tmp_path}/q").first().errors[0].field == "value"


def test_split_writes_both_kinds_in_one_job(spark, rows, tmp_path):
    df = rows.withColumn("value", F.when(F.col("id") > 1, F.col("value")))
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        calls.add(1)
        return value

    seen = df.withColumn("value", counted(F.col("value")))
    out = run_etl(seen, f"{tmp_path}/t", [FieldRule("value", "str", False)], "id", "split")
    assert (out.records_read, out.records_written, out.records_quarantined, out.status) == (3, 2, 1, "partial")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert {(r.id, r.is_valid, len(r.errors)) for r in table.collect()} == {(1, "false", 1), (2, "true", 0), (3, "true", 0)}
    assert len(table.where("is_valid = 'true'").inputFiles()) >= 1
    once = calls.value
    out = run_etl(seen, f"{tmp_path}/u", [FieldRule("value", "str", False)], "id", "quarantine", f"{tmp_path}/q")
    assert (out.records_written, out.records_quarantined) == (2, 1) and calls.value - once <= once  # read once for both writes


def test_registered_appends_with_changing_columns(spark, tmp_path):
    name = "bronze_test_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.bronze_table(spark.createDataFrame([(1, "a", "x")], "id int, v string, region string"), name, ["region"], f"{tmp_path}/b")
    sinks.bronze_table(spark.createDataFrame([("y", 2, 5.0)], "region string, id int, more double"), name, ["region"], f"{tmp_path}/b")
    sinks.bronze_table(spark.createDataFrame([(3, "c", "x", 6.0)], "ID int, v string, region string, more double"), name, ["region"], f"{tmp_path}/b")
    got = sorted((r.id, r.v, r.region, r.more) for r in spark.table(name).collect())
    assert got == [(1, "a", "x", None), (2, None, "y", 5.0), (3, "c", "x", 6.0)]
    assert [f.name for f in spark.table(name).schema] == ["id", "v", "more", "region"]
    spark.sql(f"DROP TABLE {name}")


def test_gold_partitions_stay_clustered(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id"), (F.col("id") % 4).alias("region"))
    sinks.gold_publish(rows, f"{tmp_path}/g", ["id"], ["region"])
    files_of = spark.read.parquet(f"{tmp_path}/g").groupBy("region", F.input_file_name().alias("f")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    by_region = {}
    for r in files_of.collect():
        by_region.setdefault(r.region, []).append((r.low, r.high))
    assert len(by_region) == 4 and sum(map(len, by_region.values())) <= 4 + 8
    assert all(a[1] < b[0] for spans in by_region.values() for a, b in zip(sorted(spans), sorted(spans)[1:]))


def test_pages_by_position(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.randrange(40) if i % 9 else None, i) for i in range(1003)]
    df = spark.createDataFrame(rows, "day int, id int")
    governance.write_pages(df, ["day", "id"], str(tmp_path), partitions=7)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    for size in (1, 10, 400, 5000):
        pages = -(-1003 // size)
        for page in {1, 2, pages // 2 or 1, pages, pages + 1}:
            got = governance.page_at(spark, str(tmp_path), ["day", "id"], page, size)
            assert [(r.day, r.id) for r in got.collect()] == want[(page - 1) * size : page * size]
            assert all((r.total_rows, r.total_pages) == (1003, pages) for r in got.collect())
    read = governance.page_at(spark, str(tmp_path), ["day", "id"], 50, 10)
    assert len({f.split("part=")[1].split("/")[0] for f in read.inputFiles()}) <= 7
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan
    empty = df.limit(0)
    governance.write_pages(empty, ["day", "id"], f"{tmp_path}/none", partitions=2)
    assert governance.page_at(spark, f"{tmp_path}/none", ["day", "id"], 1, 10).collect() == []


def test_schema_diff(spark):
    before = spark.createDataFrame([(1, "a", 2)], "id int, name string, n int")
    after = spark.createDataFrame([(1, None, 2.0, "x")], "id int, name string, n double, extra string")
    diff = quality.schema_diff(quality.infer_schema(before), quality.infer_schema(after)).collect()
    assert {(r.name, r.change) for r in diff} == {("n", "retyped"), ("extra", "added"), ("name", "nullability")}


def test_features(spark):
    df = spark.createDataFrame([("a b", dt.datetime(2024, 1, 1, 5), "y"), ("c", dt.datetime(2024, 1, 7, 6), "x")], "t string, ts timestamp, cat string")
    out = {r.cat: r for r in clean.build_features(df, "t", "ts", "cat").collect()}
    assert (out["y"].category_code, out["x"].category_code, out["y"].weekday, out["x"].weekday, out["y"].word_count, out["y"].hour) == (1, 0, 1, 7, 2, 5)


def test_scalar_metadata(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x", "c": [1], "d": {"e": 1}, "f": null, "g": true}',)], "m string")
    assert df.select(clean.scalar_metadata("m")).first()[0] == {"a": "1", "b": "x", "g": "true"}
