import math
import random
import time
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from cases import empty, odd
from pyspark.sql import functions as F

from larkspur.llm import mixing


def uniform(seed, doc_id):
    return int(md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52


def brute_count(u, rate):
    k, p = 0, math.exp(-rate)
    total = p
    while u >= total and k < rate + 10 * math.sqrt(rate) + 20:
        k += 1
        p *= rate / k
        total += p
    return k


def brute_rates(rows, weights=None):
    size = defaultdict(int)
    for r in rows:
        size[r.source] += len(r.text or "")
    weigh = weights or {s: n**0.5 for s, n in size.items()}
    weigh = {s: w for s, w in weigh.items() if s in size and w}
    whole, mass = sum(size[s] for s in weigh), sum(weigh.values())
    return {s: w / mass * whole / size[s] if size[s] else 1.0 for s, w in weigh.items()}


def test_counts_equal_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = docs.collect()
    rates = brute_rates(rows)
    want = Counter({r.doc_id: n for r in rows if (n := brute_count(uniform("mix", r.doc_id), rates[r.source]))})
    assert Counter(r.doc_id for r in mixing.mix(docs).select("doc_id").collect()) == want


def test_given_weights_and_shares(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    weights = spark.createDataFrame([("src0", 3.0), ("src1", 1.0), ("src2", 0.0), ("none", 5.0), ("src3", None)], "source string, weight double")
    mixed = mixing.mix(docs, weights, epochs=40.0, seed="s").collect()
    chars = Counter()
    for r in mixed:
        chars[r.source] += len(r.text)
    assert set(chars) == {"src0", "src1"}
    assert abs(chars["src0"] / sum(chars.values()) - 0.75) < 0.04


def test_odd_rows(spark):
    df = odd(spark)
    mixed = mixing.mix(df, epochs=3.0)
    assert mixed.columns == [*df.columns, "copy_", "mix_key_"]
    rows = mixed.collect()
    rates = {s: 3 * r for s, r in brute_rates(df.collect()).items()}
    want = Counter()
    for r in df.collect():
        rate = rates[r.source] if sum(len(x.text or "") for x in df.collect() if x.source == r.source) else 1.0
        want[repr((r.doc_id, r.text))] += brute_count(uniform("mix", r.doc_id), rate)
    assert Counter(repr((r.doc_id, r.text)) for r in rows) == +want
    assert [r.mix_key_ for r in mixing.mix(df.coalesce(1)).coalesce(1).collect()]


def test_empty_table(spark):
    assert mixing.mix(empty(spark)).collect() == []


@pytest.mark.parametrize("rate", [0.01, 0.7, 3.0, 60.0, 900.0])
def test_poisson_moments(spark, rate):
    (row,) = mixing.poisson_steps(spark.createDataFrame([("s", rate)], "source string, rate double")).collect()
    assert abs(row.steps[-1] - 1) < 1e-9
    mean = row.first + sum(1 - s for s in row.steps)
    assert abs(mean - rate) < 1e-6 * max(rate, 1)


def test_repeatable_and_shuffled(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    once = [(r.doc_id, r.copy) for r in mixing.mix(docs).collect()]
    again = [(r.doc_id, r.copy) for r in mixing.mix(docs.repartition(3)).collect()]
    assert sorted(once) == sorted(again) and [d for d, _ in once] != sorted(d for d, _ in once)


def test_no_python_in_the_plan(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("rate", [0.0001, 0.5, 3.0, 19.9, 400.0, 950.0, 5000.0, 1e6])
def test_steps_are_the_distribution_function(spark, rate):
    """Against sums of exact probabilities; a source with a huge rate beside large ones costs what its steps cost."""
    rates = spark.createDataFrame([("s", rate), (None, 1.0)], "source string, rate double")
    rows = {r.source: r for r in mixing.poisson_steps(rates).collect()}
    assert rows[None].first == 0 and len(rows["s"].steps) <= 22 * math.sqrt(rate) + 60
    first, steps = rows["s"].first, rows["s"].steps
    log = [-rate + k * math.log(rate) - math.lgamma(k + 1) for k in range(first, first + len(steps))]
    total = 0.0
    for got, x in zip(steps, log):
        total += math.exp(x)
        assert abs(got - total) < 1e-7 * max(rate / 1e4, 1e-3) + 1e-12
    assert abs(steps[-1] - 1) < 1e-7


def test_a_rate_of_a_million(spark):
    rows = [(i, "x" * 10, "tiny") for i in range(3)] + [(i, "y" * 1000, "large") for i in range(3, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("tiny", 1.0), ("large", 0.0)], "source string, weight double")
    start = time.time()
    counts = mixing.mix(docs, weights, epochs=500.0).groupBy("doc_id").count().collect()
    got = {r.doc_id: r["count"] for r in counts}
    size = mixing.source_rates(docs, weights, epochs=500.0).first().rate
    assert set(got) == {0, 1, 2} and all(abs(n - size) < 6 * math.sqrt(size) for n in got.values())
    assert time.time() - start < 60


def test_steps_are_counted_by_halving(spark):
    rng = random.Random(5)
    rows = [(sorted(rng.random() for _ in range(n)), rng.random()) for n in (0, 1, 2, 3, 7, 8, 100) for _ in range(20)] + [([0.2, 0.2, 0.5], 0.2), ([0.1], 0.0)]
    df = spark.createDataFrame(rows, "steps array<double>, u double").select("steps", "u", mixing._steps_upto(F.col("steps"), F.col("u")).alias("n"))
    assert all(r.n == sum(c <= r.u for c in r.steps) for r in df.collect())
