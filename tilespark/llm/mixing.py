"""Mixing sources to target weights by hash-threshold histograms.

Every row has a uniform 60-bit hash of its id. Sizes are summed by source and hash bucket; the running sum over the
buckets shows in which bucket a source's budget runs out; only that bucket is refined by the next bits of the hash, and
what the last level leaves is one bucket in 2**24 of a source. A row is then taken by comparing its hash with its
source's threshold: nothing is sorted, and a source that holds a third of all rows is 4096 partial sums like any other.

Defined cases: null or empty text has size 0 and is taken 0 times; a null source is a source, placed last; a null id
hashes as the empty string; rows with one id share a hash and are taken together; an empty table gives an empty result;
columns beyond id, source and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, materialise

LEVEL_BITS = 12
HASH_BITS = 60
WEIGHT_CYCLE = 3
MAX_REPEAT = 3
MAX_BROADCAST_SOURCES = 50_000


def hash60(column: str) -> Column:
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Water-filling over one row a source (source, source_size, weight): adds target.

    A source's target is min(max_repeat * source_size, level * weight) with one level for all, chosen so that the
    targets sum to all sizes. With the sources in the order of the level at which each fills up, the tentative level of
    a source is what is left for it and those after it once those before it are full. It is the mean of its own filling
    level and the next tentative one, so it rises until a source isn't filled, and falls from there: the level sought is
    the largest.
    """
    order = Window.orderBy("_fills", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rest = F.sum("source_size").over(every) - max_repeat * F.coalesce(F.sum("source_size").over(order), F.lit(0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(order), F.lit(0))
    return (
        sources.withColumn("_fills", F.lit(float(max_repeat)) * F.col("source_size") / F.col("weight"))
        .withColumn("_level", rest.cast("double") / weight)
        .withColumn("_level", F.max("_level").over(every))
        .withColumn("target", F.least(F.lit(float(max_repeat)) * F.col("source_size"), F.col("_level") * F.col("weight")))
        .drop("_fills", "_level")
    )


def _boundary(sums: DataFrame, budgets: DataFrame) -> DataFrame:
    """The bucket of each source in which the running sum passes its budget: source, bucket, budget left before it."""
    running = Window.partitionBy("source").orderBy("bucket")
    return (
        sums.join(budgets.select("_source", "budget"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_run", F.sum("size").over(running))
        .filter((F.col("_run") > F.col("budget")) & (F.col("_run") - F.col("size") <= F.col("budget")) & (F.col("size") > 0))
        .select(F.col("source").alias("_source"), "bucket", (F.col("budget") - F.col("_run") + F.col("size")).alias("budget"))
    )


def thresholds(rows: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """rows (doc_id, source, size) -> a row a source: _source, source_size, target, whole (copies of every row), cut (the
    largest hash of which one copy more is taken)."""
    rows = rows.select("doc_id", "source", F.col("size").cast("long").alias("size"), hash60("doc_id").alias("h"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", (rank - 1) % WEIGHT_CYCLE + 1)
    plan = targets(sources, max_repeat).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = materialise(plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))  # a row a source

    budgets = plan.select(F.col("source").alias("_source"), "budget")
    shift, part = HASH_BITS, rows
    for _ in range(2):
        shift -= LEVEL_BITS
        keyed = part.withColumn("bucket", F.shiftrightunsigned("h", shift))
        sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
        budgets = materialise(_boundary(sums, budgets))  # at most a row a source
        part = keyed.join(budgets.withColumnRenamed("bucket", "_bucket").drop("budget"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))).select("source", "h", "size")
        budgets = budgets.withColumn("floor", F.shiftleft("bucket", shift) - 1)
    exact = part.groupBy("source", F.col("h").alias("bucket")).agg(F.sum("size").alias("size"))
    run = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
    over = F.col("_run") > F.col("budget")
    cuts = (
        exact.join(budgets.drop("bucket"), exact["source"].eqNullSafe(F.col("_source")))
        .withColumn("_run", run)
        .groupBy("_source")
        .agg(
            F.coalesce(F.max(F.when(~over, F.col("bucket"))), F.first("floor")).alias("_low"),
            F.coalesce(F.max(F.when(~over, F.col("_run"))), F.lit(0)).alias("_under"),
            F.min(F.when(over, F.struct("_run", "bucket"))).alias("_high"),
            F.first("budget").alias("budget"),
        )
        .select("_source", F.when(F.col("_high._run") - F.col("budget") < F.col("budget") - F.col("_under"), F.col("_high.bucket")).otherwise(F.col("_low")).alias("cut"))
    )
    plan = plan.join(cuts, plan["source"].eqNullSafe(cuts["_source"]), "left")
    return materialise(plan.select(F.col("source").alias("_source"), "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")))


def with_copies(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """docs with doc_id and source: adds copies, source_size and target, in place of columns so named. Up to
    MAX_BROADCAST_SOURCES rows are sent to the docs, which then aren't dealt by source; more are joined by shuffle."""
    docs = docs.drop("copies", "source_size", "target")
    few = plan.count() <= MAX_BROADCAST_SOURCES
    joined = docs.join(F.broadcast(plan) if few else plan, docs["source"].eqNullSafe(plan["_source"]))
    return joined.withColumn("copies", F.col("whole") + (hash60("doc_id") <= F.col("cut")).cast("long")).drop("_source", "whole", "cut")


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(sizes(documents(spark, sf_dir, "doc_id", "source", "text")))
    return with_copies(rows, thresholds(rows)).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


SQL = {
    "op10_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
f AS (SELECT *, 3.0::DOUBLE * source_size / weight AS fills FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS lev
  FROM f WINDOW w AS (ORDER BY fills, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, max(lev) OVER () * weight) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
b AS (SELECT *, target - whole * source_size AS budget FROM p),
r AS (SELECT d.source, d.h, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h)::BIGINT AS run FROM d),
c AS (
  SELECT b.source, coalesce(max(r.h) FILTER (r.run <= b.budget), -1) AS low, coalesce(max(r.run) FILTER (r.run <= b.budget), 0) AS under,
         min(r.h) FILTER (r.run > b.budget) AS high, min(r.run) FILTER (r.run > b.budget) AS over, any_value(b.budget) AS budget
  FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source GROUP BY b.source),
k AS (SELECT source, CASE WHEN over - budget < budget - under THEN high ELSE low END AS cut FROM c)
SELECT d.doc_id, d.size, b.source_size, round(b.target, 6) AS target, (d.size * (b.whole + CASE WHEN d.h <= k.cut THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""
}
QUERIES = {"op10_mix_sources": op10_mix_sources}
