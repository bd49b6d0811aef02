"""Worklists: text files with a path a line."""

from __future__ import annotations

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, extension, stem
from ..operators.sampling import split
from .scratch import system

#: Extensions that each mode accepts.
EXTENSIONS = {
    "pipeline": (".svs", ".tif", ".tiff", ".ndpi", ".vms", ".vmu", ".scn", ".mrxs"),
    "extract": (".svs", ".tif", ".tiff", ".ndpi", ".vms", ".vmu", ".scn"),
    "embed": (".svs", ".tif", ".tiff", ".ndpi", ".mrxs"),
    "batch": (".svs", ".tif", ".tiff", ".ndpi"),
    "color": (".tif", ".tiff"),
}


def with_names(paths: DataFrame) -> DataFrame:
    p = F.col("path")
    return paths.withColumns({"name": basename(p), "stem": stem(p), "ext": extension(p)})


def read(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """path, line_no, name, stem, ext: trimmed lines that aren't blank or comments, in order, repeats kept.

    base: where relative paths lie. Line numbers are ranks within a file, which is one text split here.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    rows = lines.select((F.col("line_no") + 1).cast("long").alias("line_no"), F.trim("line").alias("path")).filter((F.col("path") != "") & ~F.col("path").startswith("#"))
    if base:
        rows = rows.withColumn("path", F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), "path")))
    return with_names(rows)


def existing(worklist: DataFrame, listing: DataFrame) -> DataFrame:
    """The paths that are listed; order and repeats are kept."""
    return worklist.join(listing.select("path").distinct(), "path", "left_semi")


def absent(worklist: DataFrame, listing: DataFrame) -> DataFrame:
    return worklist.join(listing.select("path"), "path", "left_anti")


def distinct_sorted(worklist: DataFrame) -> DataFrame:
    return with_names(worklist.select("path").distinct().orderBy("path"))


def first(worklist: DataFrame, n: int) -> DataFrame:
    """Sorted, repeats kept, cut; to be taken before any filter that follows."""
    return worklist.orderBy("path", "line_no").limit(n)


def as_filter(worklist: DataFrame) -> DataFrame:
    """The lines and their stems, as one set of keys."""
    return worklist.select(F.explode(F.array("path", "stem")).alias("key")).distinct()


def write_splits(worklist: DataFrame, parts: int, path: str) -> None:
    """Contiguous parts, a folder each."""
    split(worklist, parts, "line_no").select("bucket", F.col("path").alias("value")).repartition("bucket").sortWithinPartitions("bucket").write.partitionBy("bucket").text(path)


def write_relative(worklist: DataFrame, prefix: str, path: str) -> None:
    from ..functions.paths import strip_prefix

    worklist.select(strip_prefix(F.col("path"), prefix).alias("value")).write.text(path)


def mode(path: str) -> str:
    """What an input is: a worklist (a text file), a single image, or a folder of images."""
    files, place = system(path)
    kind = files.get_file_info(place).type
    if kind == FileType.NotFound:
        raise FileNotFoundError(f"cannot determine the kind of input: {path}")
    if kind == FileType.Directory:
        return "dir"
    return "worklist" if place.endswith(".txt") else "single"


def inputs(spark: SparkSession, path: str, folder: str | None = None, extensions: tuple[str, ...] = EXTENSIONS["batch"]) -> DataFrame:
    """path, name, stem, ext of what an input names, whatever its kind. A worklist's bare names are files of a folder, its
    own unless another is given; those that aren't there are left out, and whole paths stay. A folder's files count with
    extensions in lower case."""
    from .listing import files, single

    kind = mode(path)
    if kind == "single":
        return single(spark, path, extensions)
    if kind == "dir":
        return files(spark, path, extensions, both_cases=False).drop("length")
    base = (folder or path.rsplit("/", 1)[0]).rstrip("/")
    rows = read(spark, path)
    there = files(spark, base, ("",), whole=True).select(F.col("name").alias("_name"))
    bare = rows.filter(~F.col("path").startswith("/")).join(there, F.col("path") == F.col("_name"), "left_semi")
    found = rows.filter(F.col("path").startswith("/")).unionByName(bare.withColumn("path", F.concat(F.lit(base + "/"), "path")))
    return found.drop("line_no")
