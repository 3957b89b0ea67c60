"""Connected components of a graph given by its edges, without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a")
    return (
        tied.select(F.col("least").alias("x"), F.col("b").alias("y"))
        .unionAll(least.select(F.col("least").alias("x"), F.col("a").alias("y")))
        .where("x <> y")
        .distinct()
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )


def connected(edges: DataFrame, a: str, b: str, rounds: int = 100) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node that can be reached.

    Large-star and small-star steps by turns, each written to the shared folder, until every edge goes
    straight to a root. Edges only shrink in number and no neighbourhood is gathered: minima are
    aggregated before the shuffle. Null ends and loops are left out.
    """
    now = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    now = cut_lineage(now.distinct(), "components")
    for _ in range(rounds):
        # Done when no node is both a root and a member, and each member has one root.
        members = now.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("n"))
        open_ = members.where("n > 1").select("node").unionAll(
            members.join(now.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("node")
        )
        if open_.isEmpty():
            break
        now = cut_lineage(_small_star(_large_star(now)), "components")
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
