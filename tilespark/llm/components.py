"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _lower(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: a node's neighbours (the larger ones, or the smaller ones and itself) move to its least neighbour.

    The least neighbour comes from an aggregate that is joined back, so no task gathers a hub's neighbours.
    """
    if larger_only:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        moved = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        joined = down.join(least, F.col("u") == F.col("w"))
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v) -> (node, root): the least node of its component, for each node that has an edge and isn't a root.

    Alternates large-star and small-star steps until the edges are stars, as a count and a checksum tell.
    """
    edges = materialise(edges.filter("u <> v").select("u", "v").distinct())
    state = None
    while True:
        edges = materialise(_lower(_lower(edges, True), False))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
