"""Records of a run: outcomes, counters, workers, timings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: An outcome is the first of these whose stage went wrong.
STAGES = (("extracted", "failed_extraction"), ("embedded", "failed_embedding"), ("classified", "classification_error"))


def worker_stats(timings: DataFrame) -> DataFrame:
    """timings (worker_id, processing_time, num_patches), rounded half to even; the noise of adding in any order goes first."""
    time = F.col("processing_time")
    return timings.groupBy("worker_id").agg(
        F.count(time).alias("files"), F.bround(F.round(F.avg(time), 6), 1).alias("mean_time"), F.bround(F.round(F.sum(time), 6), 1).alias("total_time"), F.bround(F.max(time), 1).alias("max_time"), F.sum("num_patches").alias("patches")
    )


def imbalance(stats: DataFrame, alert: float = 20.0) -> DataFrame:
    """How much longer than the idlest worker the busiest was, in percent; null if that one did nothing."""
    low, high = F.min("total_time"), F.max("total_time")
    return stats.agg(F.round(F.try_divide((high - low) * 100, low), 4).alias("imbalance")).withColumn("alert", F.coalesce(F.col("imbalance") > alert, F.lit(False)))


def counters(records: DataFrame, status: str = "status") -> DataFrame:
    return records.groupBy(status).agg(F.count("*").alias("n"))


def summary(results: DataFrame, errors: DataFrame, elapsed: float) -> DataFrame:
    """One row: successes, errors, patches in all and a file, files a second."""
    done = results.agg(F.count("*").alias("success"), F.coalesce(F.sum("num_patches"), F.lit(0)).alias("total_patches"), F.avg("num_patches").alias("avg_patches"))
    failed = errors.agg(F.count("*").alias("errors"))
    return done.join(failed).withColumn("files_per_s", F.try_divide(F.col("success") + F.col("errors"), F.lit(float(elapsed))))


def outcome(*flags: str) -> Column:
    """flags: stage columns, true where it went well, null where it wasn't reached."""
    chain = F
    for (_, failed), flag in zip(STAGES, flags):
        chain = chain.when(~F.coalesce(F.col(flag), F.lit(False)), failed)
    return chain.otherwise("success")


def status(extracted: Column, embedded: Column, found: Column, classified: Column, error: Column) -> Column:
    """Where a file stands. Each stage's flag is null until the stage ends; found: whether the embedding is there; error:
    what was raised."""
    return (
        F.when(error.isNotNull(), "error")
        .when(extracted.isNull(), "processing").when(~extracted, "failed_extraction")
        .when(embedded.isNull(), "processing").when(~embedded, "failed_embedding")
        .when(~F.coalesce(found, F.lit(False)), "no_embedding")
        .when(classified.isNull(), "processing").when(~classified, "classification_error")
        .otherwise("success")
    )


def timed(records: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Adds processing_time, the seconds between two timestamps, and timestamp, when the record was made."""
    seconds = (F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / 1e6
    return records.withColumn("processing_time", seconds).withColumn("timestamp", F.current_timestamp())


def inferred_status(output: Column, code: Column) -> Column:
    """What a tool's output says about its run."""
    return F.when(code != 0, "failed").when(F.contains(output, F.lit("already exists, skipping")), "skipped").otherwise("success")


def patches_in(output: Column) -> Column:
    return F.regexp_extract(output, r"(\d+) patches", 1).try_cast("int")


def outcomes(success: DataFrame, errors: DataFrame) -> DataFrame:
    """Successes and errors in one table; what one of them lacks is null."""
    return success.unionByName(errors, allowMissingColumns=True)


def succeeded(records: DataFrame, mark: str = "predicted_organ") -> DataFrame:
    return records.filter(F.col(mark).isNotNull())


def shares(timings: DataFrame, name: str = "step", seconds: str = "seconds") -> DataFrame:
    """Each step's share of the whole time, the longest first."""
    total = timings.agg(F.sum(seconds).alias("_all"))  # one row
    return timings.join(F.broadcast(total)).select(name, seconds, F.round(F.try_divide(F.lit(100.0) * F.col(seconds), F.col("_all")), 1).alias("pct")).orderBy(F.desc(seconds), name)


def exit_code(succeeded: int, failed: int, strict: bool = False) -> int:
    """0 if any file went well; strict: if none failed."""
    return int(failed > 0) if strict else int(succeeded == 0)


def exit_codes(succeeded: Column, failed: Column, strict: bool = False) -> Column:
    """exit_code() of counts in a table."""
    return F.when(failed > 0 if strict else succeeded == 0, 1).otherwise(0)


def run_phases(spark: SparkSession, phases: list[tuple[str, Callable[[], object]]]) -> DataFrame:
    """Runs phases in order; the first that raises ends the run. A row a phase: phase, status (success, failed, skipped),
    error."""
    rows, lost = [], False
    for name, work in phases:
        try:
            if not lost:
                work()
            rows.append((name, "skipped" if lost else "success", None))
        except Exception as error:  # noqa: BLE001  whatever a phase raises ends the run, and is reported
            lost = True
            rows.append((name, "failed", f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(rows, "phase string, status string, error string")
