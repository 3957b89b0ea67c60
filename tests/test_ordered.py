"""Order-dependent operators against brute force, with one key holding most rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.operators import ordered, usage

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(n=400, seed=3):
    rng = random.Random(seed)
    return [("hot" if i % 3 else f"k{rng.randrange(6)}", i, rng.randrange(1, 9), rng.choice([-2.5, 0.0, 1.25, 7.0, 300.5])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, i bigint, v bigint, x double").repartition(7)


def test_running_total_is_the_prefix_sum(spark):
    rows = skewed()
    want, sums = {}, {}
    for k, i, v, _ in rows:
        sums[k] = sums.get(k, 0) + v
        want[i] = sums[k]
    got = ordered.running_total(frame(spark, rows), ["k"], [F.col("i")], F.floor(F.col("i") / 16), F.col("v"), "s", "t")
    out = got.collect()
    assert {r.i: r.s for r in out} == want
    assert all(r.t == sums[r.k] for r in out)


def test_running_total_keeps_null_keys(spark):
    rows = [(None, i, 1, 0.0) for i in range(40)] + [("a", 100, 5, 0.0)]
    out = ordered.numbered(frame(spark, rows), ["k"], [F.col("i")], F.floor(F.col("i") / 8), "n").collect()
    assert len(out) == 41
    assert sorted(r.n for r in out if r.k is None) == list(range(1, 41))


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_first_n(spark, n):
    rows = skewed(5000)
    got = ordered.first_n(frame(spark, rows), ["k"], [F.desc("i")], n, rank="r").collect()
    for k in {r[0] for r in rows}:
        mine = sorted((r[1] for r in rows if r[0] == k), reverse=True)[:n]
        assert [r.i for r in sorted((g for g in got if g.k == k), key=lambda g: g.r)] == mine


def test_first_n_prunes_before_the_shuffle(spark):
    plan = ordered.first_n(frame(spark, skewed()), ["k"], [F.col("i")], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_latest_per_key(spark):
    rows = skewed()
    got = ordered.latest_per_key(frame(spark, rows), ["k"], ["i"]).collect()
    assert {(r.k, r.i) for r in got} == {(k, max(r[1] for r in rows if r[0] == k)) for k in {r[0] for r in rows}}


@FEW
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 2)), min_size=1, max_size=60), st.sampled_from([0.0, 0.5, 0.95, 1.0]))
def test_exact_quantile(spark, values, q):
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "k string, x double")
    s, n = sorted(values), len(values)
    place = (n - 1) * q
    low, high = s[int(place)], s[min(n - 1, int(place) + (place > int(place)))]
    want = {
        "cont": low + (high - low) * (place - int(place)),
        "nearest": s[int(place + 0.5)],
        "index": s[min(int(n * q), n - 1)],
    }
    for method, value in want.items():
        got = ordered.exact_quantile(df, ["k"], "x", q, "p", method).collect()
        assert [(r.k, pytest.approx(value)) for r in got] == [("a", got[0].p)]


@FEW
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60))
def test_daily_budget_is_greedy(spark, sizes):
    rows = [("t", "d", i, s) for i, s in enumerate(sizes)]
    left, want = 20, set()
    for _, _, i, s in rows:
        if s <= left:
            left -= s
            want.add(i)
    df = spark.createDataFrame(rows, "tenant string, day string, i bigint, size bigint")
    got = usage.daily_budget(df, "tenant", "day", ["i"], "size", 20).collect()
    assert {r.i for r in got} == want


def test_requests_in_last_minute(spark):
    rows = [(1, i, t) for i, t in enumerate([0.0, 30.0, 59.999999, 60.0, 60.0, 119.5, 300.0])]
    df = spark.createDataFrame(rows, "c int, id int, t double").withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("bigint")))
    got = {r.id: r.requests_60s for r in usage.requests_in_last_minute(df, "c", "ts", "id").collect()}
    # A request exactly 60 s old no longer counts; equal timestamps see each other.
    assert got == {0: 1, 1: 2, 2: 3, 3: 4, 4: 4, 5: 4, 6: 1}
