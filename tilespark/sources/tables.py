"""Declared schemas of what is read and written, and its sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.resolution import sentinel
from ..operators.classify import usable
from ..operators.quality import truth

TILES = "slide string, x int, y int, patch_size int, level int, tissue_pct float"
SLIDES = "slide string, path string, w long, h long, metadata map<string,string>"
EMBEDDINGS = "stem string, embedding array<double>, metadata map<string,string>, processing_info map<string,string>"
TIMINGS = "filename string, worker_id string, start_time string, end_time string, processing_time double, num_patches long, status string"
RESULTS = "filename string, wsi_path string, output_path string, num_patches long, worker_id string, start_time string, end_time string, processing_time double"
ERRORS = "filename string, wsi_path string, error string, timestamp string, worker_id string, start_time string, end_time string, processing_time double"
COLORS = "filename string, needs_correction string, g_modal int, b_modal int"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TIMINGS)


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    """Names of files that a colour check flagged."""
    return read_csv(spark, path, COLORS).filter(truth(F.col("needs_correction"))).select("filename")


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Tile tables, whose slides each have one patch size, at level 0."""
    return spark.read.schema(TILES).parquet(path)


def invalid_slides(tiles: DataFrame) -> DataFrame:
    """Slides that break those rules."""
    return tiles.groupBy("slide").agg(F.min("patch_size").alias("low"), F.max("patch_size").alias("high"), F.max("level").alias("level")).filter("low <> high or level <> 0")


def read_embeddings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejects)."""
    rows = spark.read.schema(EMBEDDINGS).parquet(path)
    good = F.coalesce(usable(F.col("embedding")), F.lit(False))
    return rows.filter(good), rows.filter(~good)


def write_tiles(tiles: DataFrame, slides: DataFrame, path: str) -> None:
    """Tiles in files that hold whole ranges of slides, so that a slide's are found by the files' statistics; and a row a
    slide that says how many, 0 too."""
    tiles.repartitionByRange("slide", "y").sortWithinPartitions("slide", "y", "x").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/tiles")
    counts = tiles.groupBy("slide").agg(F.count("*").alias("n"))
    slides.join(counts, "slide", "left").withColumn("num_patches", F.coalesce("n", F.lit(0))).drop("n").write.mode("overwrite").parquet(f"{path}/slides")


def write_embeddings(embeddings: DataFrame, path: str) -> None:
    """Embeddings, and beside them what is known of each as a JSON record."""
    embeddings.write.mode("overwrite").parquet(f"{path}/embeddings")
    record = json_record(metadata=F.col("metadata"), processing_info=F.col("processing_info"))
    embeddings.select("stem", record.alias("record")).write.mode("overwrite").parquet(f"{path}/records")


def write_features(features: DataFrame, slides: DataFrame, path: str) -> None:
    """The optional dump of tile features (slide, x, y, f, tissue_pct), with the slides' metadata beside it."""
    features.select("slide", "x", "y", "f", "tissue_pct").repartitionByRange("slide", "y").write.mode("overwrite").parquet(f"{path}/features")
    slides.select("slide", "patch_size", "metadata").write.mode("overwrite").parquet(f"{path}/slides")


def write_log(records: DataFrame, header: dict[str, str], path: str) -> None:
    """A batch as text: the header's lines, then one for each record (stem, status, processing_time)."""
    spark = records.sparkSession
    top = spark.createDataFrame([(f"{k}: {v}",) for k, v in header.items()] + [("=" * 60,)], "value string").coalesce(1)
    top.write.mode("overwrite").text(path)
    time = F.format_string("%.1f", F.col("processing_time").cast("double"))
    records.select(F.concat_ws(" ", F.concat(F.lit("["), F.upper("status"), F.lit("]")), "stem", F.concat(time, F.lit("s"))).alias("value")).write.mode("append").text(path)


def with_sentinels(slides: DataFrame) -> DataFrame:
    """For sinks that know no null: -1 for an unknown MPP, 'unknown' for a magnification."""
    return slides.withColumn("mpp", sentinel(F.col("mpp"))).withColumn("magnification", F.coalesce("magnification", F.lit("unknown")))


def json_record(**columns: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(k) for k, c in columns.items())))


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").json(path)


def write_tracking(results: DataFrame, errors: DataFrame, timings: DataFrame, path: str) -> None:
    for name, rows in (("results", results), ("errors", errors), ("timings", timings)):
        rows.write.mode("overwrite").csv(f"{path}/{name}", header=True)


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
