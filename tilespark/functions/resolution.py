"""Micrometres per pixel (MPP), magnification, and tile sizes that follow from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SIZE = 512


def _number(properties: Column, key: str) -> Column:
    return properties[key].try_cast("double")


def mpp(properties: Column) -> Column:
    """From a map of properties: the vendor's value, the mean of both axes, the vendor's property; else null."""
    return F.coalesce(_number(properties, "aperio.MPP"), (_number(properties, "openslide.mpp-x") + _number(properties, "openslide.mpp-y")) / 2, _number(properties, "openslide.aperio.MPP"))


def _truthy(value: Column) -> Column:
    return F.when(value != 0, value)


def mpp_of_any(properties: Column) -> Column:
    """The lenient form: both axes' mean or either one, where 0 is missing; then a spacing (metres, if below 1); then
    a resolution in pixels a centimetre... each only where the former are missing."""
    x, y = (_truthy(_number(properties, f"openslide.mpp-{a}")) for a in "xy")
    spacing = _truthy(_number(properties, "spacing"))
    spacing = F.when(spacing < 1, spacing * 1e6).otherwise(spacing)
    resolution = _truthy(_number(properties, "resolution"))
    return F.coalesce((x + y) / 2, x, y, _truthy(_number(properties, "aperio.MPP")), spacing, F.lit(25400.0) / resolution)


def magnification(value: Column) -> Column:
    """A label for an MPP; null for null and 0."""
    near = lambda low, high: value.between(low, high)
    nominal = F.when(near(0.23, 0.27), "40x").when(near(0.48, 0.52), "20x").when(near(0.18, 0.22), "60x").when(near(0.35, 0.40), "25x")
    return F.when(value.isNull() | (value == 0), F.lit(None)).otherwise(F.coalesce(nominal, F.concat(F.lit("~"), (F.lit(40 * 0.25) / value).cast("int").cast("string"), F.lit("x"))))


def patch_size(value: Column) -> Column:
    """The tile size of an MPP, by buckets."""
    return F.when(value.isNull(), DEFAULT_SIZE).when(value.between(0.23, 0.27), 1024).when(value.between(0.48, 0.52), 512).when(value < 0.35, 1024).otherwise(512)


def scaled_size(size: Column, value: Column, target: float) -> Column:
    """A tile size at another MPP, rounded up; unchanged where the MPP is unknown."""
    return F.when(value > 0, F.ceil(size * (F.lit(target) / value))).otherwise(size).cast("long")


def scaled_step(step: Column, size: Column, value: Column, target: float) -> Column:
    """A step follows the tile size where it equals it."""
    return F.when(step == size, scaled_size(size, value, target)).otherwise(scaled_size(step, value, target))


def sentinel(value: Column, missing: float = -1.0) -> Column:
    """For files that can't hold null."""
    return F.coalesce(value, F.lit(missing))
