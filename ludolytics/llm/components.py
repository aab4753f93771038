"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import keep


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return tuple(row)


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    Nodes are longs. Edges with a null end are no edges; loops give a component of one;
    repeated edges and both directions count once; no edges give no rows. Every round
    moves each node to the least neighbour it can see, so the rounds grow with the
    logarithm of the longest chain. Rounds are cut by checkpoints in the shared folder.
    The minimum of a node's neighbours is summed up on the map side, so that a node with
    very many neighbours is one row per task in that shuffle; the join that follows is one
    whose skewed partitions AQE splits.
    """
    given = edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).dropna()
    nodes = keep(given.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    now = keep(given.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    state = _state(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = keep(small.select("e.u", F.col("e.m").alias("v")).where("u != v").distinct())
        before, state = state, _state(now)
        if state == before:
            root = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
            return nodes.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
