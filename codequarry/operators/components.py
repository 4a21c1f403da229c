"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.session import Scratch, hot_keys, salted_join


def _star(edges: DataFrame, scratch: Scratch, large: bool) -> DataFrame:
    """One contraction of edges (u > v). Large: every node passes its least neighbour on to its larger neighbours;
    small: to its smaller ones and itself. Both keep the components."""
    flat = edges.select("u", "v")
    if large:
        flat = flat.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.save(flat.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("c")))
    hot = hot_keys(least, "u", "c", least.count())
    joined = salted_join(flat, least.select("u", "m"), "u", hot, F.col("v"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    out = scratch.save(out.where("u <> v").distinct())
    scratch.drop(least)
    return out


def components(edges: DataFrame, scratch: Scratch | None = None, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of edges(a, b): component is the least node reached, in the nodes' order.

    Edges with a null end are left out, loops make their node a component of its own, repeated edges count once. Work
    and shuffles are in proportion to the edges in each round, rounds grow with the logarithm of the longest chain; a
    node with most edges is dealt over several tasks. An empty input gives no rows.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL")
    nodes = scratch.save(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(now)
    for _ in range(most_rounds):
        large = _star(now, scratch, True)
        small = _star(large, scratch, False)
        scratch.drop(now, large)
        now, after = small, mark(small)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.withColumnsRenamed({"u": "node", "v": "component"}), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
