"""Folders as tables of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .worklists import EXTENSIONS, with_names


def files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS["pipeline"], both_cases: bool = True, whole: bool = False) -> DataFrame:
    """path, length, name, stem, ext of a folder's own files; an extension in lower or upper case, not in mixed case;
    whole: any file.

    Only names and sizes are read. Order is by path.
    """
    wanted = [*extensions, *(e.upper() for e in extensions if both_cases)]
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path", "length")
    named = with_names(rows.withColumn("path", F.regexp_replace("path", "^file:/+", "/")))
    return (named if whole else named.filter(F.col("ext").isin(wanted))).orderBy("path")


def single(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS["pipeline"]) -> DataFrame:
    """One file; its extension counts in any case."""
    if not path.lower().endswith(extensions):
        raise ValueError(f"{path}: unsupported extension")
    return with_names(spark.createDataFrame([(path,)], "path string"))


def stems(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """The stems of a folder's results: what is done."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path")
    return with_names(rows).select(F.expr(f"substring(name, 1, char_length(name) - {len(suffix)})").alias("stem")).distinct()
