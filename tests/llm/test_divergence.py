import random
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from cases import empty, long_text, odd, plain
from pyspark.sql import functions as F

from larkspur.llm import divergence, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """The contract term by term, with whole numbers of any size."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = {s: counts[g, s] for g, s in groups if g == lang}
        whole = Counter()
        for c in mine.values():
            whole.update(c)

        def shares(c):
            size = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 2) // (size + 2 * len(kept)) for t in kept}

        p = shares(mine[source])

        def ranked(part, values, most):
            values.sort(key=lambda v: (-v[1], v[0].encode()))
            return [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(values[:most], 1)]

        price = lambda a, b: (a - b) * (a - b) // (a + b)
        others = []
        for other in mine:
            if other != source:
                q = shares(mine[other])
                others.append((other, sum(price(p[t], q[t]) for t in kept)))
        out += ranked("pair", others, len(others))
        q = shares(whole)
        out += ranked("term", [(t, price(p[t], q[t])) for t in kept if mine[source][t] > 0 and p[t] > q[t]], top)
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def made(seed, docs, sources, words=60):
    rng = random.Random(seed)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)] + ["É", "é", "ÀB", "日本", "\x80", "A\x00B", "x"]
    rows = []
    for _ in range(docs):
        source = rng.choice(sources)
        weights = [1 + 50 * (hash((source, k)) % 7 == 0) for k in range(len(names))] if source else None
        text = rng.choice((" ", "-", "1", "@")).join(rng.choices(names, weights, k=rng.randrange(60)))
        rows.append((rng.choice(("en", "en", "de", None, "")), source, None if rng.random() < 0.05 else text))
    return [*rows, ("fr", "alone", "word"), ("pt", "a", None), ("pt", "b", ""), ("pt", None, "one")]


SOURCES = ["a", "b", "c", "é", "z", None, ""]


@pytest.mark.parametrize("seed,docs,least,top", [(1, 200, 10, 10), (2, 60, 2, 3), (3, 120, 1, 1000)])
def test_equals_brute_force(spark, seed, docs, least, top):
    rows = made(seed, docs, SOURCES)
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows).repartition(5), least, top).collect())
    assert got == brute(rows, least, top)


def test_matches_sql(spark, small_dir):
    con = oracle.connect(small_dir)
    df, sql = queries.QUERIES["op12_source_divergence"](spark, small_dir), queries.SQL["op12_source_divergence"]
    assert oracle.type_differences(df, con, sql) == "" and oracle.differences(df, con, sql) == ""


def test_small_blocks_give_the_same(spark, monkeypatch):
    """Blocks of a few rows and columns, single terms cut by columns, many passes of text."""
    rows = made(5, 150, [f"s{i}" for i in range(12)])
    for name, value in (("COLUMNS", 5), ("ROWS", 7), ("ENTRIES", 40), ("BYTES", 100)):
        monkeypatch.setattr(divergence, name, value)
    got = sorted(tuple(r) for r in divergence.audit(frame(spark, rows), 3, 10).collect())
    assert got == brute(rows, 3, 10)


@pytest.mark.parametrize("columns,rows", [(4, 3), (8192, 8192), (16, 100), (1, 1)])
def test_products(monkeypatch, columns, rows):
    monkeypatch.setattr(divergence, "COLUMNS", columns)
    monkeypatch.setattr(divergence, "ROWS", rows)
    rng = np.random.default_rng(columns)
    dense = rng.random((40, 30)) < 0.2
    row, column = np.nonzero(dense)
    total = np.zeros((30, 30), np.int64)
    x, y, n = divergence.products(row, column, 30)
    np.add.at(total, (x, y), n)
    assert (total == np.triu(dense.astype(int).T @ dense.astype(int))).all()
    assert all(len(p) == 0 for p in divergence.products(np.zeros(0, int), np.zeros(0, int), 0))


def test_joint_tables(spark):
    rows = made(7, 100, SOURCES)
    got = {tuple(r)[:-1]: r.terms for r in divergence.Audit(frame(spark, rows), 2).joint_tables().collect()}
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    want = Counter()
    for lang, a in counts:
        for other, b in counts:
            if lang == other and a < b:
                for t, n in docs[lang].items():
                    if n >= 2 and counts[lang, a][t] and counts[lang, b][t]:
                        want[lang, a, counts[lang, a][t], b, counts[lang, b][t]] += 1
    assert got == dict(want)


def test_exact_arithmetic(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(10 ** rng.randrange(1, 17)), rng.randrange(1, 10**17), rng.randrange(1, 10**9)) for _ in range(300)]
    rows = [(min(n, size), size, kinds) for n, size, kinds in rows]
    got = spark.createDataFrame(rows, "n long, size long, kinds long").select("*", divergence.share("n", "size", "kinds").alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 2) // (r.size + 2 * r.kinds) for r in got)
    pairs = [(rng.randrange(1, 10**9 + 2), rng.randrange(1, 10**9 + 2)) for _ in range(300)] + [(10**9 + 1, 1), (1, 1)]
    got = spark.createDataFrame(pairs, "p long, q long").select("*", divergence.price("p", "q").alias("f")).collect()
    assert all(r.f == (r.p - r.q) ** 2 // (r.p + r.q) for r in got)


def test_odd_rows(spark):
    df = odd(spark).withColumns({c: F.lit("x") for c in ("term", "n", "docs", "levels", "total", "p", "none", "value", "rank", "part", "item")})
    df = df.unionByName(df).unionByName(df.where("doc_id > 4").withColumn("source", F.lit("other")))
    want = brute([(r.lang, r.source, r.text) for r in df.collect()], 2, 10)
    assert sorted(tuple(r) for r in divergence.audit(df, 2).collect()) == want and want
    assert divergence.audit(empty(spark)).collect() == []
    assert plain(divergence.audit(df, 2)) == plain(divergence.audit(df.repartition(6), 2))


def test_long_texts(spark):
    rows = [("en", "a", long_text(200_000)), ("en", "b", "x" * 2_000_000 + " w"), ("en", "c", "é w " * 300_000)]
    got = divergence.audit(frame(spark, rows), 2).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 10)
