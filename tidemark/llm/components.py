"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import saved


def _min_of_neighbours(edges: DataFrame) -> DataFrame:
    """u and the least of u and its neighbours. Summed up before the shuffle, so
    a node with very many neighbours is no hot group."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and its component's least node, from undirected edges (u, v).

    Alternates large stars (larger neighbours move to the least one) and small
    stars (smaller neighbours do) until nothing changes. Nodes are compared by
    value; loops and repeated edges do no harm; no edges give no rows.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_min_of_neighbours(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = saved(small)
        new = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
