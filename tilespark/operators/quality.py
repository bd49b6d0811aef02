"""Colour checks on sampled pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 220


def stride(width: Column, height: Column, resolution: int) -> Column:
    """Every how many pixels to take one, for about resolution of them along the longer axis."""
    return F.greatest(F.ceil(width / resolution), F.ceil(height / resolution), F.lit(1))


def strided(pixels: DataFrame, step: Column | int) -> DataFrame:
    step = F.lit(step) if isinstance(step, int) else step
    return pixels.filter((F.pmod(F.col("x"), step) == 0) & (F.pmod(F.col("y"), step) == 0))


def modes(pixels: DataFrame, *keys: str) -> DataFrame:
    """The most frequent green and blue of each key; the lower of equals."""
    return pixels.groupBy(*keys).agg(F.mode("g", True).alias("g_modal"), F.mode("b", True).alias("b_modal"))


def needs_correction(limit: int = LIMIT) -> Column:
    return (F.col("g_modal") < limit) | (F.col("b_modal") < limit)


def totals(checked: DataFrame) -> DataFrame:
    bad = F.count_if("needs_correction")
    return checked.agg(F.count("*").alias("files"), bad.alias("bad"), F.round(F.lit(100.0) * bad / F.greatest(F.count("*"), F.lit(1)), 1).alias("pct"))


def truth(flag: Column) -> Column:
    """A flag as text files hold it."""
    return F.coalesce(F.lower(flag) == "true", F.lit(False))
