"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where(F.col("v") > F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``a, b`` (longs, any order, repeats and loops allowed) to ``node, component``: the smallest node that each node
    reaches, for each node of an edge but the smallest itself. No edges give no rows.

    Each round is a written table; a node's neighbours are only ever reduced to their minimum, never gathered. It ends
    when a round changes nothing, which the sum of the edges' hashes tells.
    """
    edges = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}0")
    mark, i = None, 0
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == mark or state.n == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark, i = state, i + 1
        edges = scratch.save(_small_star(_large_star(edges)), f"{name}{i}")
        scratch.drop(f"{name}{i - 1}")
