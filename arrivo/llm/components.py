"""Connected components of a table of links, by alternating stars; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arrivo.session import discard, materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller, written."""
    larger = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    return materialize(larger.distinct(), "edges")


def _flat(edges: DataFrame) -> bool:
    """Whether every node points at one other that points at none: then the edges are the components."""
    seen = edges.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    nodes = seen.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 OR out = 1 AND into = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); the root is the smallest node that links reach.

    Links point every node at the smallest of its neighbours until all point at their roots, in a number of rounds that
    grows with the logarithm of the longest path. Only one yes or no a round reaches the driver.
    """
    edges = _ordered(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    while not _flat(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.join(_least(both), "u")
        large = near.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        near = large.join(_least(large), "u")
        older, edges = edges, _ordered(near.select("u", F.col("m").alias("v")).unionByName(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        discard(older)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
