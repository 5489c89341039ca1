"""Connected components of an edge table by alternating large-star and small-star steps.

Each step reduces the neighbours of a node to their minimum (combined on the map
side) and joins that minimum back to the edges, so a node with very many
neighbours is never gathered in one group; the join has one row per node on one
side and can be split. Every round is written to the shared folder, which cuts
the lineage and gives the counts that decide when nothing changes any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.staging import stage


def _star(edges: DataFrame, keep) -> DataFrame:
    """Link each neighbour that ``keep`` selects, and the node, to the node's minimum."""
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = edges.join(low, "u").where(keep)
    return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _star(both, F.col("v") > F.col("u")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b")
    return linked.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges``: two long columns a, b. Result: node, root (smallest node of its component),
    for every node of an edge. Empty edges give an empty table."""
    state = lambda df: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(now.df)
    for _ in range(max_rounds):
        if not seen["n"]:
            break
        after = stage(_small(_large(now.df)), "edges")
        now.drop()
        now, before, seen = after, seen, state(after.df)
        if before == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.df.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
