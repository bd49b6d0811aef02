"""slides -> tiles -> features -> embeddings -> predictions, each arrow a function of tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.color import TISSUE, TISSUE_WIDE, hsv, in_box
from ..functions.resolution import magnification, mpp, scaled_size, scaled_step
from ..operators import classify, encoder, exclusion, masks, sampling, tiling, tracking


@dataclass(frozen=True)
class Config:
    patch_size: int = 512
    step_size: int | None = None
    threshold: float = 0.05
    downsample: int = 16
    box: tuple = TISSUE
    target_mpp: float | None = None
    exclude: str | None = None
    exclude_mode: str = "any"
    max_patches: int | None = None
    sampled: bool = False
    inclusive: bool = False
    cell_size: int | None = None


PRESETS = {
    "pipeline": Config(),
    "shell": Config(threshold=0.25, patch_size=973),
    "profile": Config(threshold=0.25, downsample=32, box=TISSUE_WIDE),
}


def with_sizes(slides: DataFrame, config: Config) -> DataFrame:
    """slides (slide, w, h, metadata): adds mpp, magnification, size and step."""
    size, step = F.lit(config.patch_size), F.lit(config.step_size or config.patch_size)
    out = slides.withColumn("mpp", mpp(F.col("metadata")))
    out = out.withColumn("magnification", magnification(F.col("mpp")))
    if config.target_mpp is None:
        return out.withColumn("size", size.cast("long")).withColumn("step", step.cast("long"))
    return out.withColumn("size", scaled_size(size, F.col("mpp"), config.target_mpp)).withColumn("step", scaled_step(step, size, F.col("mpp"), config.target_mpp))


def tissue_mask(pixels: DataFrame, config: Config) -> DataFrame:
    """pixels (slide, y, x, r, g, b) of the reduced image -> the cleaned mask."""
    hit = in_box(hsv(F.col("r"), F.col("g"), F.col("b")), config.box)
    return masks.clean(pixels.select("slide", "y", "x", hit.cast("int").alias("m")))


def tiles(slides: DataFrame, mask: DataFrame, config: Config) -> DataFrame:
    """Tiles with enough tissue: slide, x, y, patch_size, level, tissue_pct."""
    sized = with_sizes(slides, config)
    grid = tiling.grid(sized, F.col("size"), F.col("step"))
    side = tiling.to_mask(F.col("size"), config.downsample)
    placed = grid.withColumns({"px": F.col("x"), "py": F.col("y"), "side": side})
    placed = placed.withColumns({"x": tiling.to_mask(F.col("px"), config.downsample), "y": tiling.to_mask(F.col("py"), config.downsample)})
    extent = mask.groupBy("slide").agg((F.max("x") + 1).alias("_mw"), (F.max("y") + 1).alias("_mh"))
    inside = placed.join(extent, "slide").filter(tiling.fits(F.col("x"), F.col("side"), F.col("_mw"), config.inclusive) & tiling.fits(F.col("y"), F.col("side"), F.col("_mh"), config.inclusive))
    shares = masks.region_means(inside.select("slide", "px", "py", "x", "y", "side", "size"), mask, F.col("side"))
    kept = shares.filter(masks.enough_tissue(config.threshold)).select("slide", F.col("px").alias("x"), F.col("py").alias("y"), "size", "pct")
    kept = exclusion.exclude(kept, config.exclude, config.exclude_mode)
    if config.max_patches is not None:
        kept = sampling.sample(kept, config.max_patches, ["slide", "x", "y"], "slide") if config.sampled else sampling.head(kept, config.max_patches, "slide")
    return kept.select("slide", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), F.col("size").cast("int").alias("patch_size"), F.lit(0).alias("level"), F.col("pct").cast("float").alias("tissue_pct"))


def embeddings(features: DataFrame, pool: Callable = encoder.mean_pool) -> DataFrame:
    return encoder.pool(features, pool)


def predictions(embedded: DataFrame, model: DataFrame, run: DataFrame, key: str = "slide") -> DataFrame:
    """Predictions for the run's slides only; those without an embedding come as failures."""
    mine = embedded.join(run.select(key), key, "left_semi")
    done = classify.predicted(classify.scored(mine.filter(F.coalesce(classify.usable(F.col("embedding")), F.lit(False))), model))
    lost = run.select(key).join(done.select(key), key, "left_anti").withColumn("status", F.lit("failed")).withColumn("error", F.lit("no embedding"))
    return tracking.outcomes(done, lost)
