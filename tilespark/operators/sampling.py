"""Limits, samples and splits that give the same rows on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tiling import region_key

#: A split counts rows in the square of so many ranges.
RANGES = 16


def head(tiles: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first n tiles of each slide, in row order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("y", "x"))
    return tiles.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def sample(tiles: DataFrame, n: int, identity: list[str], *keys: str) -> DataFrame:
    """n tiles of each slide by the order of a hash, without replacement."""
    drawn = F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in identity)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(drawn, *identity))
    return tiles.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def random_tiles(candidates: DataFrame, n: int, size: int, *keys: str) -> DataFrame:
    """Up to n tiles of each slide in the order of a hash, no two in one region."""
    drawn = F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in (*keys, "x", "y"))))
    marked = candidates.withColumn("_drawn", drawn).withColumn("_region", region_key(F.col("x"), F.col("y"), F.lit(size)))
    first = F.row_number().over(Window.partitionBy(*keys, "_region").orderBy("_drawn", "y", "x"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_drawn", "y", "x"))
    return marked.withColumn("_first", first).filter("_first = 1").withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_drawn", "_region", "_first", "_rank")


def split(rows: DataFrame, parts: int, order: str, nulls_last: bool = False) -> DataFrame:
    """Adds bucket, 1..parts: contiguous in the order, sizes apart by one at most, larger ones first.

    Ranks are exact without gathering all rows in one task: rows are counted by ranges of the order, cut at its
    quantiles, and each range ranks its own rows from its offset. Rows without a value come first, or last.
    """
    if rows.schema[order].dataType.typeName() not in ("long", "integer", "short", "byte"):
        raise TypeError(f"split orders by an integer column; {order} isn't one")
    n = RANGES * RANGES
    # Counting and ranking scan the rows apart and have to cut them alike, but a sketch depends on the order in which its
    # parts arrive. So the cuts are made once, here: one row, n - 1 numbers.
    cuts, total = rows.agg(F.percentile_approx(order, [(i + 1) / n for i in range(n - 1)], 20 * (n - 1)), F.count("*")).first()
    cuts, value = sorted(cuts or []), F.col(order)
    literal = lambda some: F.array(*map(F.lit, some)).cast("array<long>")
    below = lambda some: F.size(F.filter(some, lambda cut: cut < value))
    fine = F.array(*(literal(cuts[i : i + RANGES - 1]) for i in range(0, n, RANGES)))
    ranged = rows.withColumn("_coarse", below(literal(cuts[RANGES - 1 :: RANGES])))
    ranged = ranged.withColumn("_range", F.when(value.isNull(), n if nulls_last else -1).otherwise(F.col("_coarse") * RANGES + below(F.element_at(fine, F.col("_coarse") + 1)))).drop("_coarse")
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # n + 1 rows at most
    offset = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order)) + F.col("_offset") - 1
    base, extra = divmod(total, parts)
    large = extra * (base + 1)
    bucket = F.when(place < large, F.floor(place / (base + 1))).otherwise(extra + F.floor((place - large) / max(base, 1)))
    return ranged.join(F.broadcast(offset), "_range").withColumn("bucket", (bucket + 1).cast("int")).drop("_range", "_offset")


def split_counts(rows: DataFrame, parts: int, bucket: str = "bucket") -> DataFrame:
    """Rows of every bucket, 0 for the missing ones."""
    every = rows.sparkSession.range(1, parts + 1).select(F.col("id").cast("int").alias(bucket))
    return every.join(rows.groupBy(bucket).agg(F.count("*").alias("n")), bucket, "left").select(bucket, F.coalesce("n", F.lit(0)).alias("n"))
