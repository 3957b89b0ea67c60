"""Density clusters against a plain loop."""

import math
import random

import pytest

from larkspur.operators import clusters


def brute(rows, eps, least):
    """Clusters of one group: key -> smallest core key of its cluster, None for noise."""
    points = {}
    for key, v in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or [])):
        points.setdefault(key, v)
    unit = {k: [x / math.sqrt(sum(y * y for y in v)) for x in v] for k, v in points.items() if v and any(v)}
    near = {a: [b for b in unit if b != a and round(sum(x * y for x, y in zip(unit[a], unit[b])), 9) >= round(1 - eps, 9)] for a in unit}
    core = {a for a in unit if len(near[a]) + 1 >= least}
    label = {}
    for a in sorted(core):
        if a in label:
            continue
        queue = [a]
        label[a] = a
        while queue:
            for b in near[queue.pop()]:
                if b in core and b not in label:
                    label[b] = a
                    queue.append(b)
    out = {k: label.get(k) for k in points}
    for a in unit:
        if a not in core and (found := [label[b] for b in near[a] if b in core]):
            out[a] = min(found)
    return out


def made(seed, dims, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        v = [rng.gauss(0, 1) for _ in range(dims)]
        if rows and rng.random() < 0.3 and rows[-1][2]:
            v = [x + rng.gauss(0, 0.3) for x in rows[-1][2]]
        rows.append((rng.choice(["p", "q", None]), i, None if rng.random() < 0.02 else [0.0] * dims if rng.random() < 0.02 else v))
    return rows


@pytest.mark.parametrize("dims,eps,least,block", [(3, 0.02, 2, 1024), (5, 0.3, 3, 7), (8, 0.3, 2, 16), (4, 0.05, 4, 5), (2, 0.001, 3, 1024), (6, 1.2, 2, 1024)])
def test_clusters_equal_a_plain_loop(spark, dims, eps, least, block):
    rows = made(dims, dims, 220)
    df = spark.createDataFrame(rows, "prompt string, id long, v array<double>")
    got = {(r.prompt, r.id): r.cluster for r in clusters.density_clusters(df, "prompt", "id", "v", eps, least, block).collect()}
    want = {}
    for p in ("p", "q", None):
        want |= {(p, k): c for k, c in brute([r[1:] for r in rows if r[0] == p], eps, least).items()}
    assert got == want and len(set(want.values())) > 3


def test_entropy_counts_noise_as_one_label(spark):
    rows = [("p", 1, [1.0, 0.0]), ("p", 2, [1.0, 0.01]), ("p", 3, [0.0, 1.0]), ("p", 4, [-1.0, 0.0]), ("q", 1, [1.0, 0.0]), ("q", 2, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "prompt string, id long, v array<double>")
    got = {r.prompt: r.entropy for r in clusters.answer_entropy(df, "prompt", "id", "v").collect()}
    assert abs(got["p"] - math.log(2)) < 1e-6 and abs(got["q"]) < 1e-6
    assert clusters.answer_entropy(df.limit(0), "prompt", "id", "v").collect() == []


def test_string_keys_and_repeats(spark):
    rows = [("p", "b", [1.0, 0.0]), ("p", "a", [1.0, 0.1]), ("p", "a", [1.0, 0.1]), ("p", None, [1.0, 0.0]), ("p", "c", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "prompt string, id string, v array<double>")
    got = sorted((r.id, r.cluster) for r in clusters.density_clusters(df, "prompt", "id", "v").collect())
    assert got == [("a", "a"), ("b", "a"), ("c", None)]
