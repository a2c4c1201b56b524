"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import stored

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node near it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter("v > u")
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).filter("u > v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node points at one root, and no root points on."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    on = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return twice.union(on).isEmpty()


def components(links: DataFrame, what: str) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b) but the components' own roots.

    The component is its smallest node. Every round goes through a table in the shared
    scratch folder; a hot node's links are joined, never gathered in one task.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stored(edges.distinct(), f"{what}-links")
    for turn in range(MAX_ROUNDS):
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = stored(_small_star(_large_star(edges)), f"{what}-star{turn}")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
