"""Connected components of an edge table, by alternating star operations.

Large star points every larger neighbour of a node at the smallest node
around it; small star does so for the smaller neighbours.  Both keep the
components and only use minima (combined map-side) and joins, so a hub with
very many neighbours is never gathered in one task.  They converge to stars
in a number of rounds logarithmic in the length of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs) that is not the
    smallest of its component; root is the smallest."""
    found = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct())
    mark = _mark(found)
    while mark[0]:
        sides = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (sides.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        large = saved(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        found = saved(small)
        new = _mark(found)
        if new == mark:
            break
        mark = new
    return found.select(F.col("a").alias("node"), F.col("b").alias("root"))
