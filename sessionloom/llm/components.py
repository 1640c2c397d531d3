"""Connected components of an undirected graph by alternating large and small stars.

Every round is two map-side-combined minima with a salted join back, so that a node with a third
of all edges is spread over many tasks; rounds are written tables, so
a lost executor costs a few tasks and lineage stays short. Nothing is collected but one row
with the count and a checksum of the edges, which stop changing when every component is a
star around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sessionloom.operators.skew import salted_left_join
from sessionloom.session import Staging


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return salted_left_join(around.filter("v > u"), least, ["u"], ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = salted_left_join(edges, least, ["u"], ["v"]).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, stage: Staging, name: str) -> DataFrame:
    """``node, root`` of every node that has an edge and is not its component's smallest node.

    ``edges`` has two long columns ``u, v`` without nulls, in any order, repeats allowed.
    """
    now = stage.put(f"{name}_0", edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark, rounds = None, 0
    while True:
        found = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if found["n"] == 0 or found == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark, rounds = found, rounds + 1
        now = stage.put(f"{name}_{rounds}", _small_star(_large_star(now)))
