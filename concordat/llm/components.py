"""Connected components by alternating large-star and small-star steps.

Each step is one aggregate and one join on node keys, so an edge list of any size and a node with a
third of all edges are handled by Spark's own shuffles (skewed joins are split); each round is
written to the shared folder. At the end every node points at its component's smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import Steps

MOST_ROUNDS = 40


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: each node's larger neighbours move to its smallest neighbour (or itself).
    small: each node and its smaller neighbours move to the smallest of them."""
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # a: the centre, b: its neighbour; in the small step only neighbours below the centre count.
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(low, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node is either a root or has one edge, to a root: then a node's other end is its component."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """(node, component) for every node of the edges (columns a, b); component: its smallest node.

    Edges with a null end are left out. The result is a step of its own; those before it are dropped.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    now = steps.save(now, "edges")
    for _ in range(MOST_ROUNDS):
        if _settled(now):
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            labels = steps.save(now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), "labels")
            steps.drop(now)
            return labels
        later = steps.save(_star(_star(now, large=True), large=False), "edges")
        steps.drop(now)
        now = later
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
