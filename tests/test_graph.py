"""Graph operators against a plain breadth-first search."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from larkspur.operators import graph


def random_graph(n=14, m=22, seed=5):
    rng = random.Random(seed)
    edges = [(i, f"n{rng.randrange(n)}", f"n{rng.randrange(n)}", "r") for i in range(m)]
    # A hub on a third of the nodes.
    return edges + [(m + i, "n0", f"n{i}", "hub") for i in range(1, n // 3)]


def frames(spark, edges, n=14):
    nodes = spark.createDataFrame([(f"n{i}", "t") for i in range(n)], "id string, type string")
    return nodes, spark.createDataFrame(edges, "ord bigint, source string, target string, relation string")


def near(edges, x):
    return [t if s == x else s for _, s, t, _ in edges if x in (s, t)]


def search(edges, start, end, hops):
    queue, seen = deque([(start, [start])]), set()
    while queue:
        at, path = queue.popleft()
        if at == end:
            return path
        if len(path) > hops or at in seen:
            continue
        seen.add(at)
        queue.extend((x, path + [x]) for x in near(edges, at) if x not in seen)
    return None


@pytest.mark.parametrize("seed,hops", [(5, 3), (6, 3), (7, 4)])
def test_shortest_paths(spark, seed, hops):
    edges = random_graph(seed=seed)
    _, e = frames(spark, edges)
    pairs = [(f"n{i}", f"n{j}") for i in range(14) for j in range(14)]
    got = graph.shortest_paths(e, spark.createDataFrame(pairs, "start string, end string"), hops).collect()
    want = {(a, b): search(edges, a, b, hops) for a, b in pairs}
    assert {(r.start, r.end): r.path for r in got} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_neighbors(spark, depth):
    edges = random_graph()
    nodes, e = frames(spark, edges, n=12)
    got = graph.neighbors(nodes, e, spark.createDataFrame([("n3",), ("n0",)], "id string"), depth).collect()
    for start in ("n3", "n0"):
        level, found = {start}, set()
        for _ in range(depth):
            level = {x for y in level for x in near(edges, y)}
            found |= level
        assert {r.id for r in got if r.start == start} == {x for x in found if int(x[1:]) < 12}


def test_subgraph_lines_take_a_loop_once(spark):
    edges = [(1, "n1", "n1", "SELF"), (2, "n2", "n1", "IN"), (3, "n1", "n3", "OUT")]
    nodes, e = frames(spark, edges, 4)
    out = graph.subgraph_lines(nodes, e, spark.createDataFrame([("n1",)], "id string")).orderBy("ord").collect()
    assert [r.line for r in out] == ["Entity: n1 (t)", "  -SELF-> n1 (t)", "  <-IN- n2 (t)", "  -OUT-> n3 (t)"]


def test_entity_mentions(spark):
    ids = ["RAG", "vector store", "a", "Generation", "zz"]
    entities = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "ord int, id string")
    texts = ["what is rag?", "the VECTOR store rocks", "vector\tstore", "regenerations", "???", "xx zzz"]
    q = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "q int, t string")
    got = {(r.q, r.entity) for r in graph.entity_mentions(q, "q", "t", entities).collect()}
    want = {(i, x) for i, s in enumerate(texts) for x in ids if x.lower() in s.lower()}
    want |= {(i, "RAG") for i, s in enumerate(texts) if not any(x.lower() in s.lower() for x in ids)}
    assert got == want


def test_build_graph(spark):
    docs = spark.createDataFrame([("RAG uses Retrieval and generation",), ("rag retrieval",), ("RAG",)], "t string")
    nodes, edges = graph.build_graph(docs, "t")
    assert {(r.id, r.texts) for r in nodes.collect()} == {("RAG", 2), ("Retrieval", 2), ("Generation", 1)}
    assert {(r.source, r.target, r.texts) for r in edges.collect()} == {("RAG", "Retrieval", 1), ("RAG", "Generation", 1)}


def test_relations(spark):
    _, e = frames(spark, [(1, "n1", "n2", "R")])
    got = {tuple(r) for r in graph.relations_of(e).select("node", "neighbor", "relation").collect()}
    assert got == {("n1", "n2", "R"), ("n2", "n1", "inverse_R")}
    assert graph.undirected(e.where(F.lit(False))).count() == 0


def test_pairs_carry_no_paths(spark, monkeypatch):
    """One edge is looked up in the job that makes the pairs distinct; what is written holds no path but a found one."""
    written, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df, label="cut": written.append((label, df.columns)) or cut(df, label))
    _, e = frames(spark, [(1, "a", "b", "r"), (2, "b", "c", "r"), (3, "c", "d", "r")])
    pairs = spark.createDataFrame([("a", x) for x in "abcd"] * 2, "start string, end string")
    got = graph.shortest_paths(e, pairs).collect()
    assert sorted("".join(r.path) for r in got) == ["a", "ab", "abc", "abcd"]
    assert written == [("pairs", ["start", "end", "o"])] + 2 * [("paths", ["start", "end", "path"])]
