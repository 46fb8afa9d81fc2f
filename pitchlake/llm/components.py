"""Connected components of a graph of longs, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v): root is the component's smallest node.

    Each round links every node's larger neighbours, then its smaller ones, to
    the smallest node that it sees; the number of rounds grows with the
    logarithm of a component's size. A round's edges are written to the shared
    folder. Minima are partial aggregates and the joins have one side with
    unique keys, so Spark splits a node with very many neighbours.
    """
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges-0")
    state, k = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _minima(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, f"edges-{k}-large")
        low = _minima(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        k += 1
        edges = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"edges-{k}")
        now = tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
