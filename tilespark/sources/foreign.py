"""Tile tables and embeddings in the files of other tools, where the packages that read those are installed.

spark.dataSource.register(TileFiles), spark.dataSource.register(TensorFiles); spark.read.format("hdf5tiles") and
format("tensors") give a row a tile, or a row a file, of the files in option("path", ..); a partition a file. Writers make
a file a slide. Without the package (h5py, torch) each says which one is missing.
"""

from __future__ import annotations

import importlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .scratch import put, system


def need(package: str):
    try:
        return importlib.import_module(package)
    except ModuleNotFoundError as error:
        raise ModuleNotFoundError(f"these files need the package {package}, which isn't installed; Parquet tables don't") from error


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Files(DataSourceReader):
    def __init__(self, options: dict, package: str, suffix: str):
        need(package)
        self.path, self.suffix = options["path"], suffix

    def partitions(self) -> list[InputPartition]:
        files, place = system(self.path)
        found = files.get_file_info(place)
        every = [f.path for f in files.get_file_info(fs.FileSelector(place)) if f.is_file] if found.type == fs.FileType.Directory else [place]
        begin = self.path[: self.path.index(place)] if place in self.path else ""
        return [_File(begin + p) for p in sorted(every) if p.endswith(self.suffix)]

    def content(self, path: str) -> io.BytesIO:
        files, place = system(path)
        with files.open_input_stream(place) as f:
            return io.BytesIO(f.read())


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


class _Tiles(_Files):
    def read(self, partition: _File) -> Iterator:
        with need("h5py").File(self.content(partition.path), "r") as f:
            coords = np.asarray(f["coords"], np.int32).reshape(-1, 2)
            n = len(coords)
            of = lambda name, kind, other: np.asarray(f[name], kind) if name in f else np.full(n, f.attrs.get(other, 0), kind)
            attributes = [(k, str(v)) for k, v in f.attrs.items()]
            columns = [pa.array([_stem(partition.path)] * n), pa.array(coords[:, 0]), pa.array(coords[:, 1]), pa.array(of("patch_size", np.int32, "patch_size")), pa.array(of("level", np.int32, "level")), pa.array(of("tissue_percentage", np.float32, "tissue_thresh")), pa.array([attributes] * n, pa.map_(pa.string(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["slide", "x", "y", "patch_size", "level", "tissue_pct", "attributes"])


class TileFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "hdf5tiles"

    def schema(self) -> str:
        return "slide string, x int, y int, patch_size int, level int, tissue_pct float, attributes map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _Tiles(self.options, "h5py", ".h5")


class _Tensors(_Files):
    def read(self, partition: _File) -> Iterator:
        kept = need("torch").load(self.content(partition.path), map_location="cpu", weights_only=True)
        vector = kept.get("slide_embedding") if isinstance(kept, dict) else None
        error = None if vector is not None else "no dictionary with slide_embedding"
        yield (_stem(partition.path), None if vector is None else [float(v) for v in vector.reshape(-1)], error)


class TensorFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tensors"

    def schema(self) -> str:
        return "stem string, embedding array<double>, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Tensors(self.options, "torch", ".pt")


def write_tile_files(tiles: DataFrame, folder: str) -> None:
    """tiles (slide, x, y, patch_size, level, tissue_pct) -> a file a slide; a slide without tiles has none."""
    need("h5py")

    def one(table: pa.Table) -> pa.Table:
        kept, slide = io.BytesIO(), table.column("slide")[0].as_py()
        with need("h5py").File(kept, "w") as f:
            f["coords"] = np.stack([table.column(c).to_numpy() for c in "xy"], 1).astype(np.int32)
            for name, column, kind in (("patch_size", "patch_size", np.int32), ("level", "level", np.int32), ("tissue_percentage", "tissue_pct", np.float32)):
                f.create_dataset(name, data=table.column(column).to_numpy().astype(kind), compression="gzip" if table.num_rows > 10_000 else None)
            f.attrs["num_patches"] = table.num_rows
        put(f"{folder}/{slide}.h5", kept.getvalue())
        return pa.table({"n": [table.num_rows]})

    tiles.groupBy("slide").applyInArrow(one, "n long").write.format("noop").mode("overwrite").save()


def write_tensor_files(embeddings: DataFrame, folder: str) -> None:
    """embeddings (stem, embedding) -> a file a slide."""
    need("torch")

    def write(part: Iterator) -> None:
        torch = need("torch")
        for row in part:
            kept = io.BytesIO()
            torch.save({"slide_embedding": torch.tensor([row.embedding])}, kept)
            put(f"{folder}/{row.stem}.pt", kept.getvalue())

    embeddings.select("stem", "embedding").foreachPartition(write)
