"""Tile features placed on a grid; features in one cell add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cells(features: DataFrame, cell: Column | int, key: str = "slide") -> DataFrame:
    """Adds row and col: the cell of x and y, counted from the least place of the slide. A row runs along x."""
    cell = F.lit(cell) if isinstance(cell, int) else cell
    least = features.groupBy(key).agg(F.min("x").alias("_x0"), F.min("y").alias("_y0"))
    return features.join(least, key).withColumn("row", F.floor((F.col("x") - F.col("_x0")) / cell).cast("long")).withColumn("col", F.floor((F.col("y") - F.col("_y0")) / cell).cast("long")).drop("_x0", "_y0")


def scatter_add(placed: DataFrame, key: str = "slide", feature: str = "f", digits: int | None = None) -> DataFrame:
    """One row a cell: f, the sum by dimension, and the sums of x and y. Sums are made before the shuffle, by dimension."""
    long = placed.select(key, "row", "col", "x", "y", F.posexplode(feature).alias("i", "v"))
    sums = long.groupBy(key, "row", "col", "i").agg(F.sum(F.col("v").cast("double")).alias("v"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    value = F.round("v", digits) if digits is not None else F.col("v")
    packed = F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))), lambda s: s["v"])
    return sums.groupBy(key, "row", "col").agg(packed.alias("f"), F.max("sx").alias("sx"), F.max("sy").alias("sy"))


def not_background(feature: str = "f") -> Column:
    return F.exists(feature, lambda v: v != 0)


def extents(placed: DataFrame, key: str = "slide") -> DataFrame:
    return placed.groupBy(key).agg((F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"))


def dense(grid: DataFrame, key: str = "slide") -> DataFrame:
    """All cells of the extents, with whether anything stands there."""
    size = extents(grid, key)
    every = size.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("row"), "cols").select(key, "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)).alias("col"))
    return every.join(grid, [key, "row", "col"], "left").withColumn("filled", F.coalesce(not_background(), F.lit(False)))


def running_minimum(features: DataFrame, key: str = "slide") -> DataFrame:
    """Adds min_x and min_y of the slide to each row."""
    w = Window.partitionBy(key)
    return features.withColumn("min_x", F.min("x").over(w)).withColumn("min_y", F.min("y").over(w))
