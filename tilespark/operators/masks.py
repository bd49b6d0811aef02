"""Tissue masks as tables (slide, y, x, m): cleaning, and means over regions.

A slide is cut into strips of rows, which spread over the cluster; a strip also gets the few rows around it that its
results depend on, so each operation deals the cells once, and a worker holds one strip. A row of the table is a cell;
cells that aren't there, or are null, don't count.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.color import TISSUE, hsv, in_box
from .encoder import resize

KEYS = ("slide",)
#: Rows of a strip.
STRIP = 256
#: (how a cell and its four neighbours become one, what a missing neighbour counts as)
LEAST, GREATEST = (np.minimum, 1 << 30), (np.maximum, -(1 << 30))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def cross(values: np.ndarray, there: np.ndarray, step: tuple) -> np.ndarray:
    """Each cell becomes the least or greatest of itself and its four neighbours."""
    choose, missing = step
    padded = np.pad(np.where(there, values, missing), 1, constant_values=missing)
    return choose.reduce([padded[1:-1, 1:-1], padded[:-2, 1:-1], padded[2:, 1:-1], padded[1:-1, :-2], padded[1:-1, 2:]])


def _morphed(mask: DataFrame, steps: list[tuple], keys) -> DataFrame:
    """The steps one after another: each reaches one row further, so a strip comes with as many rows as there are steps."""
    halo, schema = len(steps), mask.select(*keys, "y", "x", "m").schema
    strip = lambda by: F.floor((F.col("y") + by) / STRIP)
    dealt = mask.select(*keys, "y", "x", "m", F.explode(F.sequence(strip(-halo), strip(halo))).alias("_strip"))

    def run(table: pa.Table) -> pa.Table:
        y, x = _column(table, "y"), _column(table, "x")
        m = table.column("m").combine_chunks()
        known = m.is_valid().to_numpy(zero_copy_only=False)
        row, column = y - y.min(), x - x.min()
        values, there = (np.zeros((int(row.max()) + 1, int(column.max()) + 1), kind) for kind in (np.int32, bool))
        values[row, column], there[row, column] = m.fill_null(0).to_numpy(zero_copy_only=False), known
        for step in steps:
            values = cross(values, there, step)
        own = np.flatnonzero(y // STRIP == _column(table, "_strip")[0])
        kept = table.take(pa.array(own)).select([f.name for f in schema])
        at = schema.fieldNames().index("m")
        return kept.set_column(at, "m", pa.array(values[row, column][own], mask=~known[own]).cast(m.type))

    return dealt.groupBy(*keys, "_strip").applyInArrow(run, schema)


def erode(mask: DataFrame, keys=KEYS) -> DataFrame:
    return _morphed(mask, [LEAST], keys)


def dilate(mask: DataFrame, keys=KEYS) -> DataFrame:
    return _morphed(mask, [GREATEST], keys)


def opened(mask: DataFrame, keys=KEYS) -> DataFrame:
    return _morphed(mask, [LEAST, GREATEST], keys)


def closed(mask: DataFrame, keys=KEYS) -> DataFrame:
    return _morphed(mask, [GREATEST, LEAST], keys)


def clean(mask: DataFrame, keys=KEYS) -> DataFrame:
    """Specks go, then holes."""
    return _morphed(mask, [LEAST, GREATEST, GREATEST, LEAST], keys)


def region_means(regions: DataFrame, mask: DataFrame, size: Column | int, keys=KEYS) -> DataFrame:
    """regions (.., y, x) of size by size cells: adds pct, the mean of m over them, by each strip's summed-area table.

    A region belongs to the strip of its first row; a strip comes with as many rows below it as its largest region
    needs. What of a region lies outside the mask counts as 0; regions without any cell, or of no size, have a null pct.
    """
    marked = regions.withColumn("_size", (F.lit(size) if isinstance(size, int) else size).cast("long")).withColumn("_strip", F.floor(F.col("y") / STRIP))
    if isinstance(size, int):
        rows = mask.withColumn("_most", F.lit(max(size, 1)))
    else:
        rows = mask.join(F.broadcast(marked.agg(F.greatest(F.max("_size"), F.lit(1)).alias("_most"))))  # one row
    strips = F.sequence(F.floor((F.col("y") - F.col("_most") + 1) / STRIP), F.floor(F.col("y") / STRIP))
    rows = rows.filter("m is not null").select(*keys, "y", "x", F.col("m").cast("long").alias("m"), F.explode(strips).alias("_strip"))
    schema = StructType([*regions.schema.fields, *StructType.fromDDL("pct double").fields])

    def run(wanted: pa.Table, cells: pa.Table) -> pa.Table:
        out = wanted.select([f.name for f in regions_schema])
        pct, bad = np.zeros(wanted.num_rows), np.ones(wanted.num_rows, bool)
        if wanted.num_rows and cells.num_rows:
            y, x = _column(cells, "y"), _column(cells, "x")
            y0, x0 = y.min(), x.min()
            table = np.zeros((2, int(y.max() - y0) + 2, int(x.max() - x0) + 2), np.int64)  # sums of m, and of cells
            table[0, y - y0 + 1, x - x0 + 1], table[1, y - y0 + 1, x - x0 + 1] = _column(cells, "m"), 1
            table = table.cumsum(1).cumsum(2)
            side = wanted.column("_size").fill_null(0).to_numpy()
            ends = [np.clip(_column(wanted, axis) + by - low, 0, n - 1) for axis, low, n in (("y", y0, table.shape[1]), ("x", x0, table.shape[2])) for by in (0, side)]
            top, bottom, left, right = ends
            total, count = table[:, bottom, right] - table[:, top, right] - table[:, bottom, left] + table[:, top, left]
            bad = (count == 0) | (side <= 0)
            pct = np.where(bad, 0.0, total / np.maximum(side * side, 1))
        return out.append_column("pct", pa.array(pct, pa.float64(), mask=bad))

    regions_schema = regions.schema
    return marked.groupBy(*keys, "_strip").cogroup(rows.groupBy(*keys, "_strip")).applyInArrow(run, schema)


def chunked(pixels: DataFrame, chunk: int, factor: int, detect: Callable | None = None, box=TISSUE, keys=KEYS) -> DataFrame:
    """pixels (slide, y, x, r, g, b) at full resolution -> the mask at 1 / factor, made chunk by chunk as for images that
    don't fit anywhere whole: each chunk is reduced and cleaned on its own, and placed at its corner's place in the
    mask. Chunks whose side isn't a multiple of the factor overlap there; the later one, in row order, wins."""
    place = lambda axis: F.floor(F.col(axis) / chunk)
    dealt = pixels.select(*keys, "y", "x", "r", "g", "b", place("y").alias("_cy"), place("x").alias("_cx"))
    schema = StructType([*pixels.select(*keys).schema.fields, *StructType.fromDDL("y long, x long, r int, g int, b int, _cy long, _cx long").fields])

    def run(table: pa.Table) -> pa.Table:
        y, x, cy, cx = (_column(table, c) for c in ("y", "x", "_cy", "_cx"))
        row, column = y - cy * chunk, x - cx * chunk
        image = np.zeros((int(row.max()) + 1, int(column.max()) + 1, 3), np.uint8)
        for i, c in enumerate("rgb"):
            image[row, column, i] = _column(table, c)
        small = image if factor == 1 else resize(image, image.shape[0] // factor, image.shape[1] // factor) if min(image.shape[:2]) >= factor else image[:0]
        rows, columns = np.indices(small.shape[:2])
        own = table.select(list(keys)).take(pa.array(np.zeros(rows.size, np.int64)))
        at = lambda cell, inner: pa.array(cell[0] * chunk // factor + inner.ravel(), pa.int64())
        named = {"y": at(cy, rows), "x": at(cx, columns), **{c: pa.array(small[:, :, i].ravel(), pa.int32()) for i, c in enumerate("rgb")}}
        corner = {"_cy": pa.array(np.full(rows.size, cy[0]), pa.int64()), "_cx": pa.array(np.full(rows.size, cx[0]), pa.int64())}
        return pa.table({**{k: own.column(k) for k in keys}, **named, **corner})

    small = dealt.groupBy(*keys, "_cy", "_cx").applyInArrow(run, schema)
    hit = in_box(hsv(F.col("r"), F.col("g"), F.col("b")), box) if detect is None else detect(F.col("r"), F.col("g"), F.col("b"))
    cleaned = clean(small.select(*keys, "y", "x", "_cy", "_cx", hit.cast("int").alias("m")), (*keys, "_cy", "_cx"))
    return cleaned.groupBy(*keys, "y", "x").agg(F.max_by("m", F.struct("_cy", "_cx")).alias("m"))


def tile_share(pixels: DataFrame, hit: Column, *tile: str) -> DataFrame:
    """The share of a tile's pixels that are hit, at full resolution."""
    return pixels.groupBy(*tile).agg(F.avg(hit.cast("int")).alias("pct"))


def verified(tiles: DataFrame, exact: DataFrame, threshold: float, *tile: str) -> DataFrame:
    """Tiles whose share, taken anew at full resolution, still reaches the threshold; it replaces theirs."""
    return tiles.drop("pct").join(exact, list(tile)).filter(F.col("pct") >= threshold)


def enough_tissue(threshold: float, strict: bool = False) -> Column:
    """A null share is never enough."""
    if not 0 <= threshold <= 1:
        raise ValueError(f"a threshold lies in [0, 1]; {threshold} doesn't")
    return F.coalesce((F.col("pct") > threshold) if strict else (F.col("pct") >= threshold), F.lit(False))
