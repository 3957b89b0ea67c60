"""The pipeline against its stages by brute force, and the SQL of the operators that have one."""

from collections import Counter

import duckdb
import pytest
from cases import empty, odd
from test_decontaminate import brute_distance, words
from test_mixing import brute_count, brute_rates, uniform
from test_quality_rules import brute
from test_simhash import brute_components, brute_print

import corpus_pipeline
from larkspur.llm import queries


@pytest.fixture(scope="module")
def stages(spark, small_dir):
    """The rows before and after every stage, as run() makes them."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small_dir).cache()
        out.append(docs)
    return [d.collect() for d in out]


def test_stages_keep_the_columns(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small_dir).dtypes == docs.dtypes


def test_run_equals_its_stages(spark, small_dir, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, small_dir).collect())) == Counter(map(tuple, stages[-1]))


def test_quality_stage(spark, small_dir, stages):
    judged = {r.doc_id: r.kept for r in queries.QUERIES["op9_quality_rules"](spark, small_dir).collect()}
    assert {r.doc_id for r in stages[1]} == {d for d, kept in judged.items() if kept}
    assert not any(brute(r.text)[-1] for r in stages[1])


def test_dedup_stage(stages):
    rows = [(r.doc_id, brute_print(r.text)) for r in stages[1]]
    assert sorted(r.doc_id for r in stages[2]) == sorted({c for _, _, c in brute_components(rows)})


def test_decontamination_stage(spark, small_dir, stages):
    items = [words(r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages[3]}
    for r in stages[2]:
        text = words(r.text)
        near = [i for i in items if len(set(i) & set(text)) >= 0.8 * len(set(i)) - 2]
        if len(text) < 3000:
            assert (r.doc_id in kept) != any(brute_distance(i, text) <= int(0.2 * len(i)) for i in near)


def test_secret_stage(stages):
    before = {r.doc_id: r for r in stages[3]}
    changed = [r for r in stages[4] if r.text != before[r.doc_id].text]
    assert len(stages[4]) == len(stages[3]) and changed
    assert all("[SECRET]" in r.text and r.n_chars == len(r.text) for r in changed)
    assert not any("token = \"" in r.text and "token = \"[SECRET]" not in r.text for r in stages[4])


def test_mixing_stage(stages):
    rates = brute_rates(stages[4])
    want = Counter({r.doc_id: n for r in stages[4] if (n := brute_count(uniform("mix", r.doc_id), rates[r.source]))})
    assert Counter(r.doc_id for r in stages[5]) == want


def test_every_stage_takes_odd_rows_and_empty_tables(spark, small_dir):
    df = odd(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, df, small_dir)
        assert done.columns[: len(df.columns)] == df.columns and (k == 4 or done.columns == df.columns)
        done.collect()
        assert stage(spark, empty(spark), small_dir).collect() == []


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_agrees(spark, small_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_dir}/{table}.parquet'")
    found = con.execute(queries.SQL[name])
    columns = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, small_dir)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(found.fetchall())
