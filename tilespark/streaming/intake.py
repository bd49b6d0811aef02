"""Worklists and run records as streams of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.worklists import with_names


def worklist_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The paths of all worklists put into a folder, as they come."""
    lines = spark.readStream.text(folder).select(F.trim("value").alias("path"))
    return with_names(lines.filter((F.col("path") != "") & ~F.col("path").startswith("#")))


def process_new(paths: DataFrame, work: Callable[[DataFrame], DataFrame], done: str, checkpoint: str) -> StreamingQuery:
    """Work on what came since the last run and isn't done, once a path, then stop.

    work: (path, name, stem, ext) -> rows with stem. A batch that is run again after a failure replaces its own output,
    and errors end the query.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        todo = rows.dropDuplicates(["stem"])
        try:
            before = spark.read.parquet(done).filter(F.col("batch") != number).select("stem")
            todo = todo.join(before, "stem", "left_anti")
        except AnalysisException as error:  # the first batch finds no folder, or nothing in it
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        work(todo).write.mode("overwrite").parquet(f"{done}/batch={number}")

    return paths.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_totals(records: DataFrame, table: str, once: bool = False) -> StreamingQuery:
    """Counts by status of a stream of records, in memory, for a display; once: of what is there now."""
    totals = records.groupBy("status").agg(F.count("*").alias("n"), F.sum("num_patches").alias("patches"))
    writer = totals.writeStream.outputMode("complete").format("memory").queryName(table)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_records(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Results and errors (by status) appended as they come, each batch once; what goes wrong ends the query."""

    def batch(rows: DataFrame, number: int) -> None:
        for name, kept in (("results", F.col("status") == "success"), ("errors", F.col("status") != "success")):
            rows.filter(kept).write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

    return records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
