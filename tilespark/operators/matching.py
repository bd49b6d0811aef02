"""Joining slides to the files made from them, and telling what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUFFIXES = ("", "_coords", "_patches", "_features")
SUFFIXES_BATCH = ("_aex", "_coords", "_patches")


def match(slides: DataFrame, files: DataFrame, suffixes: tuple[str, ...] = SUFFIXES, prefix: bool = True) -> DataFrame:
    """slides (stem, ..), files (file_stem): adds file_stem and priority of each slide's best file.

    A file becomes one row for each stem that it could serve: its name without each suffix that it ends with, and, as
    the last choice, its beginnings, of which only lengths that a stem has are made. The best file of each stem is an
    aggregate, made before the shuffle as well, and joined to the slides by equality.
    """
    name = F.col("file_stem")
    named = [F.when(F.endswith(name, F.lit(s)) & (F.char_length(name) > len(s)), F.struct(F.substring(name, F.lit(1), F.char_length(name) - len(s)).alias("stem"), F.lit(i).alias("priority"))) for i, s in enumerate(suffixes)]
    options = F.array_compact(F.array(*named))
    if prefix:
        lengths = slides.agg(F.array_sort(F.collect_set(F.char_length("stem"))).alias("_lengths"))  # one row
        files = files.join(F.broadcast(lengths))
        begins = F.transform(F.filter("_lengths", lambda n: (n <= F.char_length(name)) & (n > 0)), lambda n: F.struct(F.substring(name, F.lit(1), n).alias("stem"), F.lit(len(suffixes)).alias("priority")))
        options = F.concat(options, begins)
    offers = files.select("file_stem", F.explode(options).alias("o")).select(F.col("o.stem").alias("stem"), F.struct("o.priority", "file_stem").alias("b"))
    best = offers.groupBy("stem").agg(F.min("b").alias("b")).select("stem", "b.file_stem", "b.priority")
    return slides.join(best, "stem", "left")


def missing(slides: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Slides without a file."""
    return slides.join(files.select(key), key, "left_anti")


def resume(slides: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is left to do."""
    return missing(slides, done, key)


def chosen(slides: DataFrame, worklist: DataFrame, key: str) -> DataFrame:
    return slides.join(worklist.select(key), key, "left_semi")


def flagged(flags: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Flag rows with whether their file is listed."""
    there = listing.select(F.col(key).alias("_there")).distinct()
    return flags.join(there, F.col(key) == F.col("_there"), "left").withColumn("present", F.col("_there").isNotNull()).drop("_there")


def first_few(rows: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first n by key, with how many there are in all: what a report shows of what is missing or failed."""
    total = rows.agg(F.count("*").alias("of"))  # one row
    return rows.select(key).orderBy(key).limit(n).join(F.broadcast(total))
