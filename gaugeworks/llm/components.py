"""Connected components of a link table by alternating large and small stars.

Each round sends every node's neighbours to its smallest one.  All work is grouped
minima (combined map-side) and joins that adaptive execution can split, so a node
with very many links never meets in one task; the minima are written first, because a
join on top of an aggregate could not be split.  Lineage is cut with ``checkpoint()``.
Rounds end once the edges are stars, which one grouped count of their ends tells: a round that
only confirms this would be four more writes with all their plans, which the driver holds.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut_lineage


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of u go to the smallest of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u itself, go to the smallest of them; edges are (larger, smaller)."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is nobody's smaller end; such edges lead to roots."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return (ends.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
            .where("down > 1 OR down > 0 AND up > 0").isEmpty())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root``: for every linked node the smallest node it can reach.

    Nulls and self-links carry nothing and are left out; repeated links count once.
    """
    pairs = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges = cut_lineage(pairs.where("u <> v").distinct())
    while not _are_stars(edges):
        edges = cut_lineage(_small(cut_lineage(_large(edges))))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct())
