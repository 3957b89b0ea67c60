"""Density clusters of vectors inside groups of any size, without one task per group.

Two points are neighbours if their cosine distance is at most ``eps``. Unit vectors that near are at most
sqrt(2 eps) apart, on any fixed direction too: points are put into bands of that width along one direction and meet
their own and the adjacent bands only. Bands are cut into blocks of bounded size, and each pair of blocks is a unit of
work: dense products of two blocks, from which only counts and a spanning forest leave, at most a row a point.

* a null or zero vector has no neighbours: noise. A null group is a group; rows without a key are left out.
* clusters are named by the smallest key of their core points; noise has a null cluster. A border point goes to the
  smallest of its neighbours' clusters.
* equal keys in a group count as one point (the smallest vector).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.vectors import SCORE_DIGITS, norm
from larkspur.operators.components import connected
from larkspur.operators.evals import label_entropy
from larkspur.session import cut_lineage


def _direction(vector: Column) -> Column:
    """Length of a unit vector along a direction of plus and minus ones, which data rarely follow."""
    signed = F.transform(vector, lambda x, i: F.when(F.pmod(i * 7919 + F.floor(i / 3), F.lit(2)) == 0, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0.0), lambda a, x: a + x) / F.sqrt(F.size(vector).cast("double"))


def _units(points: DataFrame, block: int) -> DataFrame:
    """Every point once for each pair of blocks it takes part in: ``unit``, and whether it is on the ``low`` side."""
    sizes = points.groupBy("g", "band").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("here"))
    beside = [sizes.select("g", (F.col("band") + d).alias("band"), F.col("here").alias(name)) for d, name in ((-1, "above"), (1, "below"))]
    placed = points.join(sizes, ["g", "band"]).join(beside[0], ["g", "band"], "left").join(beside[1], ["g", "band"], "left")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("key"), F.col("here")).cast("int"))

    def blocks(count: str) -> Column:
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    def unit(low_band, low, high_band, high, is_low) -> Column:
        return F.struct(F.struct(low_band.alias("a"), low.alias("b"), high_band.alias("c"), high.alias("d")).alias("unit"), is_low.alias("low"))

    band, own = F.col("band"), F.col("own")
    same = F.transform(blocks("here"), lambda c: unit(band, F.least(own, c), band, F.greatest(own, c), own <= c))
    up = F.transform(blocks("above"), lambda c: unit(band, own, band + 1, c, F.lit(True)))
    down = F.transform(blocks("below"), lambda c: unit(band - 1, c, band, own, F.lit(False)))
    return placed.withColumn("at", F.explode(F.concat(same, up, down))).select(*points.columns, "at.unit", "at.low")


def _near(table: pa.Table, eps: float) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """The two sides of a unit, and which of their points are neighbours; one side only for a block with itself."""
    unit = table["unit"][0].as_py()
    low = table["low"].to_numpy(zero_copy_only=False).astype(bool)
    alone = (unit["a"], unit["b"]) == (unit["c"], unit["d"])
    one = table if alone else table.filter(pa.array(low))
    two = table if alone else table.filter(pa.array(~low))

    def matrix(side: pa.Table) -> np.ndarray:
        flat = side["v"].combine_chunks().flatten().to_numpy()
        return flat.reshape(len(side), -1) if len(side) else np.zeros((0, 1))

    if not len(one) or not len(two):
        return one, two, np.zeros((len(one), len(two)), bool)
    near = np.round(matrix(one) @ matrix(two).T, SCORE_DIGITS) >= round(1 - eps, SCORE_DIGITS)
    if alone:
        np.fill_diagonal(near, False)
    return one, two, near


def _per_unit(points: DataFrame, block: int, eps: float, schema: str, fn: Callable[[pa.Table, pa.Table, np.ndarray], dict]) -> DataFrame:
    def work(table: pa.Table) -> pa.Table:
        one, two, near = _near(table, eps)
        return pa.table(fn(one, two, near))

    return _units(points, block).groupBy("g", "unit").applyInArrow(work, schema)


def _counts(one: pa.Table, two: pa.Table, near: np.ndarray) -> dict:
    """How many neighbours each point has in the unit."""
    sides = [(one, near.sum(1))] + ([] if one is two else [(two, near.sum(0))])
    kept = [(t.filter(pa.array(n > 0)), n[n > 0]) for t, n in sides]
    return {
        "g": pa.concat_arrays([t["g"].combine_chunks() for t, _ in kept]),
        "key": pa.concat_arrays([t["key"].combine_chunks() for t, _ in kept]),
        "n": pa.array(np.concatenate([n for _, n in kept]).astype(np.int64)),
    }


def _forest(one: pa.Table, two: pa.Table, near: np.ndarray) -> dict:
    """Links that connect whatever is connected in the unit: each point once, over the link by which it was reached."""
    if one is two:
        links = near
        names = one["key"].combine_chunks()
    else:
        n, m = near.shape
        links = np.zeros((n + m, n + m), bool)
        links[:n, n:], links[n:, :n] = near, near.T
        names = pa.concat_arrays([one["key"].combine_chunks(), two["key"].combine_chunks()])
    left = np.ones(len(links), bool)
    a, b = [], []
    for start in range(len(links)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            here = queue.pop()
            found = np.flatnonzero(links[here] & left)
            left[found] = False
            a += [here] * len(found)
            b += found.tolist()
            queue += found.tolist()
    g = pa.concat_arrays([one["g"].combine_chunks(), two["g"].combine_chunks()]).slice(0, 1)
    return {"g": g.take(pa.array([0] * len(a), pa.int64())), "a": names.take(pa.array(a, pa.int64())), "b": names.take(pa.array(b, pa.int64()))}


def _borders(one: pa.Table, two: pa.Table, near: np.ndarray) -> dict:
    """The smallest cluster among the core neighbours of each point that is none."""
    out: dict = {"g": [], "key": [], "cluster": []}
    for side, other, links in ((one, two, near), (two, one, near.T))[: 1 if one is two else 2]:
        clusters, core = np.array(other["cluster"].to_pylist(), object), np.array(other["core"].to_pylist(), bool)
        mine = ~np.array(side["core"].to_pylist(), bool)
        for i in np.flatnonzero(mine & (links & core).any(1)) if len(side) and len(other) else ():
            out["g"].append(side["g"][int(i)].as_py())
            out["key"].append(side["key"][int(i)].as_py())
            out["cluster"].append(min(clusters[links[i] & core]))
    return {"g": pa.array(out["g"], one["g"].type), "key": pa.array(out["key"], one["key"].type), "cluster": pa.array(out["cluster"], one["key"].type)}


def density_clusters(
    rows: DataFrame, group: str, key: str, vector: str, eps: float = 0.3, min_samples: int = 2, block: int = 1024
) -> DataFrame:
    """``group``, ``key`` and ``cluster`` of every point: DBSCAN by cosine distance inside each group.

    A point is a core point if it has ``min_samples`` points, itself included, within ``eps``. Runs jobs when called.
    """
    kind = rows.schema[key].dataType.simpleString()
    g = F.when(F.col(group).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(group).cast("string")))
    v = F.col(vector).cast("array<double>")
    known = rows.where(F.col(key).isNotNull()).select(F.col(group).alias("given"), g.alias("g"), F.col(key).alias("key"), v.alias("v"))
    known = cut_lineage(known.groupBy("g", "key").agg(F.first("given").alias("given"), F.min("v").alias("v")), "cluster-points")
    size = norm(F.col("v"))
    unit = known.where(size > 0).select("g", "key", F.transform("v", lambda x: x / size).alias("v"))
    width = math.sqrt(2 * min(eps, 2.0)) * (1 + 1e-9) or 1.0
    unit = cut_lineage(unit.withColumn("band", F.floor(_direction(F.col("v")) / width).cast("int")), "cluster-bands")
    counts = _per_unit(unit, block, eps, f"g string, key {kind}, n long", _counts).groupBy("g", "key").agg(F.sum("n").alias("n"))
    marked = unit.join(counts, ["g", "key"], "left").withColumn("core", F.coalesce("n", F.lit(0)) + 1 >= min_samples)
    marked = cut_lineage(marked, "cluster-cores")
    links = cut_lineage(_per_unit(marked.where("core").drop("n", "core"), block, eps, f"g string, a {kind}, b {kind}", _forest), "cluster-links")
    nodes = links.select(F.struct("g", F.col("a").alias("key")).alias("a"), F.struct("g", F.col("b").alias("key")).alias("b"))
    roots = connected(nodes, "a", "b").select("node.g", "node.key", F.col("root.key").alias("cluster"))
    cores = marked.where("core").select("g", "key").join(roots, ["g", "key"], "left").withColumn("cluster", F.coalesce("cluster", "key"))
    if min_samples > 2:  # with fewer, a point with a neighbour is a core point
        cores = cut_lineage(cores, "cluster-names")
        near = marked.where(F.col("n") > 0).join(cores, ["g", "key"], "left").select("g", "key", "v", "band", "core", "cluster")
        found = _per_unit(near, block, eps, f"g string, key {kind}, cluster {kind}", _borders)
        cores = cores.unionByName(cut_lineage(found.groupBy("g", "key").agg(F.min("cluster").alias("cluster")), "cluster-borders"))
    return known.join(cores, ["g", "key"], "left").select(F.col("given").alias(group), F.col("key").alias(key), "cluster")


def answer_entropy(rows: DataFrame, group: str, key: str, vector: str, eps: float = 0.3, min_samples: int = 2) -> DataFrame:
    """Semantic entropy per prompt: the entropy of the clusters of its answers, noise as one label."""
    return label_entropy(density_clusters(rows, group, key, vector, eps, min_samples), group, "cluster")


