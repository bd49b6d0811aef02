"""Tile grids from slide sizes, and bounds of tiles in a mask.

A slide's axis of dim pixels holds (dim - size) div step + 1 tiles, and none if it is shorter than a tile. Both axes
are exploded from sequences, so a slide's tiles are made where the slide's row is, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _origins(dim: Column, size: Column, step: Column, exclusive: bool) -> Column:
    last = dim - size - (1 if exclusive else 0)
    return F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last.cast("long"), step.cast("long"))).otherwise(F.array().cast("array<long>"))


def grid(slides: DataFrame, size: Column, step: Column | None = None, width: str = "w", height: str = "h", exclusive: bool = False) -> DataFrame:
    """Adds x and y, a row a tile, in row order. exclusive: a last tile that fits exactly is dropped."""
    step = size if step is None else step
    rows = slides.withColumn("y", F.explode(_origins(F.col(height), size, step, exclusive)))
    return rows.withColumn("x", F.explode(_origins(F.col(width), size, step, exclusive)))


def chunks(slides: DataFrame, chunk: int, width: str = "w", height: str = "h") -> DataFrame:
    """Adds chunk_x, chunk_y, chunk_w and chunk_h; the last ones are clipped."""
    out = slides
    for axis, dim, name in (("y", height, "chunk_h"), ("x", width, "chunk_w")):
        starts = F.when(F.col(dim) > 0, F.sequence(F.lit(0).cast("long"), (F.col(dim) - 1).cast("long"), F.lit(chunk).cast("long"))).otherwise(F.array().cast("array<long>"))
        out = out.withColumn(f"chunk_{axis}", F.explode(starts)).withColumn(name, F.least(F.lit(chunk).cast("long"), F.col(dim) - F.col(f"chunk_{axis}")))
    return out


def to_mask(coordinate: Column, factor: Column | float) -> Column:
    """A pixel's place in a reduced mask."""
    return F.floor(coordinate / (F.lit(factor) if isinstance(factor, (int, float)) else factor)).cast("long")


def from_mask(place: Column, factor: float) -> Column:
    return F.floor(place * F.lit(factor)).cast("long")


def fits(start: Column, size: Column, dim: Column, inclusive: bool) -> Column:
    """Whether a region ends within an axis; inclusive: it may touch the end."""
    return start + size <= dim if inclusive else start + size < dim


def region_key(x: Column, y: Column, size: Column) -> Column:
    """Tiles within a quarter of a tile of each other share a key; tiles under four pixels are their own."""
    quarter = F.greatest(F.floor(size / 4), F.lit(1))
    return F.struct(F.floor(x / quarter).cast("long").alias("kx"), F.floor(y / quarter).cast("long").alias("ky"))


def best_level(levels: Column, downsample: float) -> Column:
    """Of an array of (w, h, downsample): the smallest level that needn't be enlarged, as an index; the first if none."""
    fitting = F.filter(F.transform(levels, lambda l, i: F.struct(l["downsample"].alias("d"), i.alias("i"))), lambda s: s["d"] <= downsample)
    return F.coalesce(F.array_max(fitting)["i"], F.lit(0))
