"""Distributed union-find: connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """The root (smallest node) of every node that has an edge, other than the root itself: node, root.

    ``edges`` has a and b (longs, no nulls; loops are ignored). Each round is written to the shared folder, and a
    round that changes nothing ends the work. Groups grow by the rounds' power of two, so 60 of them suffice for any table.
    """
    edges = checkpoint(edges.where("a <> b").select("a", "b").distinct())  # else every use would make the edges again
    edges = checkpoint(_small(edges))
    state, ended = None, False
    for _ in range(rounds):
        # Both halves keep a < b turned to b > a; a star per component is the fixed point.
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if ended := (now.n, now.h) == state or not now.n:
            break
        state = (now.n, now.h)
        edges = checkpoint(_small(_large(edges)))
    if not ended:
        raise RuntimeError(f"Components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
