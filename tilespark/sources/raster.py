"""A data source for rasters: their levels, reduced pixels, and regions of them.

spark.dataSource.register(RasterSource); spark.read.format("raster").option("path", ..).load() gives a row a file with
the levels that it holds; option("factor", n) gives pixels (path, y, x, r, g, b) of the image reduced by n, in
partitions of a few rows, each of which reads only the part of the image that they depend on; option("thumbnail", true)
starts from the smallest level that needn't be enlarged instead of the first. with_regions() reads tiles. Binary PPM and
TIFF are read here; other decoders take part by DECODERS; those of slide formats aren't installed here.
"""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.encoder import resize_part
from .scratch import system
from .tiff import Tiff

ROWS_TOGETHER = 64


class Ppm:
    """An 8-bit P6 image: one level, whose rows are read as they are needed."""

    def __init__(self, file: BinaryIO):
        self.file, fields = file, []
        while len(fields) < 4:
            line = file.readline()
            if not line:
                raise ValueError("a cut header")
            fields += line.split(b"#")[0].split()
        if fields[0] != b"P6" or int(fields[3]) > 255:
            raise ValueError("not an 8-bit P6 image")
        self.width, self.height, self.start = int(fields[1]), int(fields[2]), file.tell()

    @property
    def levels(self) -> list[tuple[int, int, float]]:
        return [(self.width, self.height, 1.0)]

    def region(self, level: int, x: int, y: int, width: int, height: int) -> np.ndarray:
        if x < 0 or y < 0 or x + width > self.width or y + height > self.height:
            raise ValueError(f"region {x},{y} {width}x{height} isn't within {self.width}x{self.height}")
        self.file.seek(self.start + y * self.width * 3)
        rows = np.frombuffer(self.file.read(height * self.width * 3), np.uint8).reshape(height, self.width, 3)
        return rows[:, x : x + width]


def write_ppm(path: str, image: np.ndarray) -> None:
    with open(path, "wb") as f:
        f.write(b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + image[:, :, :3].astype(np.uint8).tobytes())


#: Extension -> what opens a file: an object with levels, and region(level, x, y, width, height).
DECODERS: dict[str, Callable[[BinaryIO], object]] = {".ppm": Ppm, ".tif": Tiff, ".tiff": Tiff}


def open_raster(path: str):
    files, place = system(path)
    opener = DECODERS.get(os.path.splitext(place)[1].lower())
    if opener is None:
        raise ValueError(f"{path}: no decoder for this extension")
    return opener(io.BufferedReader(files.open_input_file(place)))


def check_level(levels: Column, level: int) -> Column:
    """An array of levels that holds this one; else the query fails and tells how many there are."""
    told = F.concat(F.lit(f"level {level} isn't there; the image has "), F.size(levels).cast("string"), F.lit(" levels"))
    return F.when(F.size(levels) > level, levels).otherwise(F.raise_error(told))


def reduced(raster, factor: int, first: int, last: int, thumbnail: bool = False) -> np.ndarray:
    """Rows first .. last - 1 of the image reduced by factor; thumbnail: from the level nearest to it."""
    levels = raster.levels
    level = max((i for i, (_, _, d) in enumerate(levels) if d <= factor), default=0, key=lambda i: levels[i][2]) if thumbnail else 0
    width, height = levels[level][:2]
    small = levels[0][0] // factor, levels[0][1] // factor
    read = lambda low, high: raster.region(level, 0, low, width, high - low)[:, :, :3]
    return resize_part(read, height, width, small[1], small[0], first, last)


class _Part(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.factor = options["path"], int(options.get("factor", 0))
        self.thumbnail = options.get("thumbnail", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        files, place = system(self.path)
        found = files.get_file_info(place)
        paths = [f.path for f in files.get_file_info(fs.FileSelector(place)) if f.is_file] if found.type == fs.FileType.Directory else [place]
        begin = self.path[: self.path.index(place)] if place in self.path else ""  # scheme and host
        paths = sorted(begin + p for p in paths if os.path.splitext(p)[1].lower() in DECODERS)
        if not self.factor:
            return [_Part(p, 0, 0) for p in paths]
        rows = {p: open_raster(p).levels[0][1] // self.factor for p in paths}
        return [_Part(p, a, min(n, a + ROWS_TOGETHER)) for p, n in rows.items() for a in range(0, n, ROWS_TOGETHER)]

    def read(self, partition: _Part) -> Iterator:
        raster = open_raster(partition.path)
        if not self.factor:
            width, height, _ = raster.levels[0]
            yield (partition.path, width, height, [dict(zip(("w", "h", "downsample"), level)) for level in raster.levels])
            return
        part = reduced(raster, self.factor, partition.first, partition.last, self.thumbnail)
        rows, columns = np.indices(part.shape[:2])
        yield pa.RecordBatch.from_arrays(
            [pa.array([partition.path] * rows.size), pa.array((rows + partition.first).ravel().astype(np.int32)), pa.array(columns.ravel().astype(np.int32)), *(pa.array(part[:, :, c].ravel().astype(np.int32)) for c in range(3))],
            ["path", "y", "x", "r", "g", "b"],
        )


class RasterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        return "path string, y int, x int, r int, g int, b int" if int(self.options.get("factor", 0)) else "path string, w long, h long, levels array<struct<w:long,h:long,downsample:double>>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def with_regions(tiles: DataFrame, level: int = 0, samples: int = 3) -> DataFrame:
    """tiles (path, x, y, size, ..): adds pixels, the interleaved samples of each tile at a level, and error. A tile that
    can't be read has null pixels and tells why; imputed() or rejected() decide what becomes of it."""
    schema = StructType([*tiles.schema.fields, *StructType.fromDDL("pixels binary, error string").fields])

    def run(batches):
        at, raster = None, None
        for batch in batches:
            pixels, errors = [], []
            for path, x, y, size in zip(*(batch.column(c).to_pylist() for c in ("path", "x", "y", "size"))):
                try:
                    if path != at:  # tiles of a file stand together
                        raster, at = open_raster(path), path
                    pixels.append(np.ascontiguousarray(raster.region(level, x, y, size, size)[:, :, :samples]).tobytes())
                    errors.append(None)
                except (OSError, ValueError, IndexError) as error:
                    pixels.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pixels, pa.binary()), pa.array(errors, pa.string())], schema.fieldNames())

    return tiles.mapInArrow(run, schema)


def imputed(tiles: DataFrame, samples: int = 3) -> DataFrame:
    """For encoding: tiles that couldn't be read become zeros, with a mark."""
    zeros = F.expr(f"unhex(repeat('00', size * size * {samples}))")
    return tiles.withColumn("is_imputed", F.col("pixels").isNull()).withColumn("pixels", F.coalesce("pixels", zeros))


def rejected(tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For checks and pictures: (tiles that were read, those that weren't, with their errors)."""
    return tiles.filter("pixels is not null").drop("error"), tiles.filter("pixels is null").drop("pixels")
