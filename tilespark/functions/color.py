"""Pixel colours. One integer-valued HSV formula serves both scales; it claims no other library's rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_CIRCLE, FULL_BYTE = 180, 256
#: Closed bounds of hue, saturation and value.
TISSUE = ((90, 180), (8, 255), (103, 255))
TISSUE_WIDE = ((0, 180), (20, 255), (30, 255))


def hsv(r: Column, g: Column, b: Column, circle: int = HALF_CIRCLE) -> tuple[Column, Column, Column]:
    """Hue in circle steps, saturation and value in 0..255, from channels in 0..255."""
    value, low = F.greatest(r, g, b), F.least(r, g, b)
    spread = value - low
    saturation = F.when(value == 0, F.lit(0)).otherwise(F.floor(F.lit(255.0) * spread / value + F.lit(0.5)))
    sixth = circle / 6.0
    turn = F.when(value == r, (g - b) / spread).when(value == g, F.lit(2.0) + (b - r) / spread).otherwise(F.lit(4.0) + (r - g) / spread)
    hue = F.floor(turn * sixth + F.lit(0.5))
    hue = F.when(spread == 0, F.lit(0)).otherwise(F.when(hue < 0, hue + circle).otherwise(hue))
    return hue.cast("int"), saturation.cast("int"), value.cast("int")


def in_box(channels: tuple[Column, Column, Column], box=TISSUE) -> Column:
    h, s, v = (c.between(low, high) for c, (low, high) in zip(channels, box))
    return h & s & v


def is_dark(r: Column, g: Column, b: Column, limit: int = 240) -> Column:
    """Mean of the channels below a limit."""
    return (r + g + b) / 3 < limit


def normalised(value: Column, mean: float, deviation: float) -> Column:
    """A byte as a standardised fraction."""
    return (value / F.lit(255.0) - F.lit(mean)) / F.lit(deviation)


def share_bucket(share: Column, threshold: float) -> Column:
    """The colour that an overlay gives a tile."""
    return F.when(share >= 0.5, "green").when(share >= threshold, "yellow").otherwise("red")
