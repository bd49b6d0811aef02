"""Where intermediate files go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def base(setting: str | None, master: str) -> str:
    """The folder that the setting names. Without it, one machine has a folder of its own; on a cluster it has to be set."""
    if setting:
        return setting.rstrip("/")
    if not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="tilespark-")


def folder(spark: SparkSession) -> str:
    """A fresh path in the folder that spark.checkpoint.dir names."""
    setting = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return f"{base(setting, spark.sparkContext.master)}/files-{uuid.uuid4().hex}"


def system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, by its scheme, and the path within it; a plain path is a folder that workers share."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def put(path: str, content: bytes) -> None:
    """A file is complete or absent."""
    to, place = system(path)
    to.create_dir(place.rsplit("/", 1)[0], recursive=True)
    part = f"{place}.{uuid.uuid4().hex}.part"
    with to.open_output_stream(part) as f:
        f.write(content)
    to.move(part, place)
