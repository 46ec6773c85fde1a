"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import Workspace


def _are_stars(edges: DataFrame) -> bool:
    """Whether all edges (u to its smaller v) point at a node without an edge of its own, one from each u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("n_down"), F.min("down").alias("least"))
    return not nodes.agg(F.max(F.expr("n_down > 1 or (n_down = 1 and least = 0)"))).first()[0]


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """node, component (smallest reachable id) of every node with an edge to another one.

    Alternates large-star and small-star steps: each node hands its smallest neighbour to its larger
    and then to its smaller ones, until all edges point at the smallest node. Rounds are written
    to the shared folder; no node's neighbours are ever gathered into a row. Edges that are such stars
    already take no round.
    """
    stars = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = work.put(stars)
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.withColumnRenamed("m", "v"))
        after = work.put(small.distinct())
        work.drop(stars)
        stars = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))


def extended(parts: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """The components once more links (a, b, a written table) have joined them; without links ``parts`` as it is."""
    if links.isEmpty():
        return parts
    return components(links.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b"))), work)
