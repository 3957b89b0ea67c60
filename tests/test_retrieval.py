"""Vector, cache and search operators against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.functions import vectors
from larkspur.operators import search, similarity

DIMS = 8


def table(n, seed, copies=0):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, DIMS)).astype(np.float32)
    if copies:
        m[:copies] = m[0]  # a third of the corpus may be one vector
    return m


def frame(spark, m, id_name, vec_name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{id_name} bigint, {vec_name} array<float>").repartition(5)


def brute(corpus, queries, k, metric):
    c, q = corpus.astype(np.float64), queries.astype(np.float64)
    if metric == "cosine":
        lengths = np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1))
        s = np.divide(q @ c.T, lengths, out=np.zeros((len(q), len(c))), where=lengths > 0)
    else:
        s = 1 - ((q[:, None, :] - c[None, :, :]) ** 2).sum(2)
    s = np.round(s, 9)
    return {(i, j, r + 1) for i in range(len(q)) for r, j in enumerate(np.lexsort((np.arange(len(c)), -s[i]))[:k])}


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
@pytest.mark.parametrize("path", ["ship queries", "ship corpus", "blocks"])
def test_top_k_paths_agree_with_brute_force(spark, monkeypatch, metric, path):
    corpus, queries = table(240, 1, copies=80), table(30, 2)
    corpus[100] = 0
    if path == "ship corpus":
        corpus, queries = queries, corpus
    monkeypatch.setattr(similarity, "SHIP_BYTES", {"ship queries": 100, "ship corpus": 100, "blocks": 5}[path] * DIMS * 8)
    monkeypatch.setattr(similarity, "QUERY_BLOCK_BYTES", 8 * DIMS * 8)
    monkeypatch.setattr(similarity, "CORPUS_BLOCK_BYTES", 50 * DIMS * 8)
    monkeypatch.setattr(similarity, "CELLS", 700)
    got = similarity.top_k(frame(spark, corpus, "vec_id", "embedding"), frame(spark, queries, "query_id", "query_vec"), 7, metric).collect()
    assert {(r.query_id, r.doc_id, r["rank"]) for r in got} == brute(corpus, queries, 7, metric)


def test_rows_without_a_vector_are_skipped(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [])], "vec_id bigint, embedding array<float>")
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id bigint, query_vec array<float>")
    assert [r.doc_id for r in similarity.top_k(c, q, 5).collect()] == [1]


def test_approximate_search_finds_most(spark):
    corpus, queries = table(600, 3), table(20, 4)
    celled, centres = similarity.cluster_cells(frame(spark, corpus, "vec_id", "embedding"), 6)
    q = frame(spark, queries, "query_id", "query_vec")
    everywhere = similarity.top_k_approx(celled, centres, q, 5, probes=6).collect()
    exact = {(i, j) for i, j, _ in brute(corpus, queries, 5, "cosine")}
    assert {(r.query_id, r.doc_id) for r in everywhere} == exact
    half = {(r.query_id, r.doc_id) for r in similarity.top_k_approx(celled, centres, q, 5, probes=3).collect()}
    assert len(half & exact) / len(exact) > 0.6


def test_mean_vectors(spark):
    m = table(50, 5)
    df = frame(spark, m, "id", "v").withColumn("k", F.lit("hot"))
    assert np.allclose(vectors.mean_vectors(df, "k", "v", "mean").first()["mean"], m.astype(float).mean(0))


def hits(spark, rows, schema="query_id int, doc_id int, score double, rank int"):
    return spark.createDataFrame(rows, schema)


def test_rerank_missing_score_is_zero_and_ties_keep_order(spark):
    c = hits(spark, [(1, 10, 0.9, 1), (1, 11, 0.8, 2), (1, 12, 0.7, 3)])
    scores = spark.createDataFrame([(1, 12, 0.5)], "query_id int, doc_id int, score double")
    out = similarity.rerank(c, scores, 3).orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in out] == [(12, 0.5), (10, 0.0), (11, 0.0)]


def test_multi_query_union_keeps_the_first_or_the_best(spark):
    rows = spark.createDataFrame([(1, 7, 0.2, 1), (1, 7, 0.9, 2)], "question int, doc_id int, score double, ord int")
    assert similarity.multi_query_union(rows, "question", "ord").first().score == 0.2
    assert similarity.multi_query_union(rows, "question", "ord", "best").first().score == 0.9


def test_hybrid_merge_folds_in_order(spark):
    rows = spark.createDataFrame([(1, 7, 1, 0.8), (1, 7, 2, 0.4), (1, 7, 3, 0.0)], "query_id int, doc_id int, ord int, score double")
    assert similarity.hybrid_merge(rows, "ord").first().score == pytest.approx(((0.8 + 0.4) / 2 + 0.0) / 2)


def test_adaptive_takes_the_first_good_tier(spark):
    s = "query_id int, doc_id int, score double"
    vector = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.1), (3, 1, 0.1)], s)
    hybrid = spark.createDataFrame([(2, 2, 0.95), (2, 1, 0.99), (3, 2, 0.2)], s)
    wide = spark.createDataFrame([(3, 3, 0.3)], s)
    out = similarity.adaptive([("vector", vector), ("hybrid", hybrid), ("expanded", wide)], 1, 0.7).collect()
    assert {(r.query_id, r.doc_id, r.strategy) for r in out} == {(1, 1, "vector"), (2, 2, "hybrid"), (3, 3, "expanded")}


def test_cache_lookup(spark):
    best = spark.createDataFrame([(1, 5, 0.95), (2, 5, 0.5), (3, 6, 0.99)], "query_id int, doc_id int, score double")
    answers = spark.createDataFrame([(5, "yes", 100), (6, "old", 10)], "doc_id int, answer string, created_at int")
    out = similarity.cache_lookup(best, answers, F.lit(120), F.lit(50), 0.92)
    assert {(r.query_id, r.hit, r.answer) for r in out.collect()} == {(1, True, "yes"), (2, False, None), (3, False, None)}
    assert similarity.cache_stats(out).first().hit_rate == pytest.approx(1 / 3, abs=1e-6)
    assert similarity.cache_stats(out.limit(0)).first().hit_rate == 0.0


def test_bm25_filters(spark):
    rows = [(1, "A", "red fox runs"), (2, "B", "red red fox"), (3, "C", "fox red junior"), (4, "red fox", "nothing")]
    df = spark.createDataFrame(rows, "doc_id int, title string, text string")
    fields = {"title": "A", "text": "D"}
    assert [r.doc_id for r in search.bm25(df, fields, ["red", "fox"], without=["junior"]).collect()][0] == 4
    assert {r.doc_id for r in search.bm25(df, fields, ["red"], phrases=["red fox"]).collect()} == {1, 2, 4}
    page2 = search.bm25(df, fields, ["fox"], page=2, page_size=3).collect()
    assert len(page2) == 1


def test_headline_marks_terms(spark):
    df = spark.createDataFrame([("one two Red fox three",)], "t string")
    assert df.select(search.headline(F.col("t"), ["red", "fox"], 3)).first()[0] == "<b>Red</b> <b>fox</b> three"


def test_trigram_similarity(spark):
    def grams(s):
        return {f"  {w} "[i : i + 3] for w in s.lower().split() for i in range(len(w) + 1)}

    a, b = "Juann Perez", "Juan Peres"
    want = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(search.trigram_similarity(F.col("a"), F.col("b"))).first()[0] == pytest.approx(want)


def test_embed_with_loads_once_per_worker(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "t string")
    out = similarity.embed_with(df, "t", "v", lambda: lambda texts: [[float(len(x))] for x in texts])
    assert sorted(r.v[0] for r in out.collect()) == [2.0, 3.0]


def test_search_parts_only_the_first_rows(monkeypatch):
    """Later scores of a long scan only meet the edge of the best, and blocks of queries keep their own best."""
    monkeypatch.setattr(similarity, "QUERY_STEP", 8)
    corpus, queries = table(6000, 11, copies=500).astype(float), table(20, 12).astype(float)
    parted, partition = [], np.partition
    monkeypatch.setattr(similarity.np, "partition", lambda a, *rest, **more: parted.append(a.size) or partition(a, *rest, **more))
    searching = similarity._Search(np.arange(20), queries, 7, None, "cosine")
    for at in range(0, 6000, 1500):
        searching.scan(corpus[at : at + 1500], np.arange(at, min(at + 1500, 6000)))
    monkeypatch.undo()
    assert 0 < sum(parted) < 20 * 6000 / 20
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])
    got = pa.Table.from_batches(searching.results(schema)).to_pylist()
    assert {(r["query_id"], r["doc_id"]) for r in got} == {(i, j) for i, j, _ in brute(corpus, queries, 7, "cosine")}


def test_the_corpus_is_dealt_to_the_cores_for_many_queries(spark):
    corpus = spark.range(similarity.TASK_ROWS * 3).coalesce(1)
    assert similarity._dealt(corpus.withColumnRenamed("id", "doc_id"), 1000).rdd.getNumPartitions() == 3
    assert similarity._dealt(corpus.withColumnRenamed("id", "doc_id"), 1).rdd.getNumPartitions() == 1
