"""Encoders: tiles to features, features to one vector a slide. Models are injected; a worker loads one once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

BATCH = 32


def mean_pool(features: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
    """The encoder of tests: the mean of the features."""
    return features.mean(axis=0)


def encode_tiles(load: Callable[[], Callable[[list[bytes]], np.ndarray]], batch: int = BATCH):
    """A column function, image bytes -> features. A tile that can't be read should come as zeros, and marked."""

    @pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for images in batches:
            out = [model(list(images[i : i + batch])) for i in range(0, len(images), batch)]
            yield pd.Series(list(np.concatenate(out))) if out else pd.Series([], dtype=object)

    return run


def pool(features: DataFrame, encoder: Callable[[np.ndarray, np.ndarray], np.ndarray] = mean_pool, digits: int | None = None) -> DataFrame:
    """features (slide, x, y, f) -> slide, embedding, num_patches; tiles in the order of y and x."""

    def one(tiles: pd.DataFrame) -> pd.DataFrame:
        tiles = tiles.sort_values(["y", "x"], kind="stable")
        vector = np.asarray(encoder(np.array(tiles.f.tolist(), float), tiles[["x", "y"]].to_numpy()), float)
        vector = vector if digits is None else vector.round(digits)
        return pd.DataFrame({"slide": [tiles.slide.iloc[0]], "embedding": [vector.tolist()], "num_patches": [len(tiles)]})

    return features.select("slide", "x", "y", "f").groupBy("slide").applyInPandas(one, "slide long, embedding array<double>, num_patches long")


def pool_means(features: DataFrame, digits: int | None = None) -> DataFrame:
    """pool() with the mean as its encoder, as an aggregate by dimension that combines before the shuffle."""
    long = features.select("slide", F.posexplode("f").alias("i", "v"))
    mean = F.avg(F.col("v").cast("double"))
    means = long.groupBy("slide", "i").agg((F.round(mean, digits) if digits is not None else mean).alias("v"), F.count("*").alias("n"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"])
    return means.groupBy("slide").agg(packed.alias("embedding"), F.max("n").alias("num_patches"))


def imputed(features: DataFrame, width: int) -> DataFrame:
    """Missing features become zeros, with a mark."""
    return features.withColumn("is_imputed", F.col("f").isNull()).withColumn("f", F.coalesce("f", F.array_repeat(F.lit(0.0).cast("float"), width)))


def _weights(source: int, target: int, first: int, last: int, lobes: int = 4) -> tuple[int, np.ndarray]:
    """Windowed-sinc weights of places first .. last - 1 of target: (first place of source that counts, the weights from
    there on). When an image shrinks, the kernel widens."""
    scale = source / target
    reach = max(1.0, scale)
    centre = (np.arange(first, last) + 0.5) * scale - 0.5
    low, high = max(0, int(centre[0] - lobes * reach)), min(source, int(centre[-1] + lobes * reach) + 2)
    d = (np.arange(low, high)[None, :] - centre[:, None]) / reach
    w = np.where(np.abs(d) < lobes, np.sinc(d) * np.sinc(d / lobes), 0.0)
    return low, w / w.sum(1, keepdims=True)


def resize_part(read: Callable[[int, int], np.ndarray], source_height: int, source_width: int, height: int, width: int, first: int, last: int) -> np.ndarray:
    """Rows first .. last - 1 of an image resampled to height x width; read(low, high) gives its rows low .. high - 1."""
    if last <= first or not width:
        return np.zeros((max(0, last - first), width, 3), np.uint8)
    low, down = _weights(source_height, height, first, last)
    out = np.einsum("ys,sxc->yxc", down, read(low, low + down.shape[1]).astype(float))
    parts = []
    for a in range(0, width, 256):
        left, across = _weights(source_width, width, a, min(width, a + 256))
        parts.append(np.einsum("xs,ysc->yxc", across, out[:, left : left + across.shape[1]]))
    return np.clip(np.rint(np.concatenate(parts, 1)), 0, 255).astype(np.uint8)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Windowed-sinc resampling of an H x W x C image, some rows at a time."""
    read = lambda low, high: image[low:high]
    parts = [resize_part(read, image.shape[0], image.shape[1], height, width, a, min(height, a + 256)) for a in range(0, height, 256)]
    return np.concatenate(parts) if parts else image[:0]


def reduce_pixels(pixels: DataFrame, factor: int, strip: int = 32) -> DataFrame:
    """pixels (slide, w, h, y, x, r, g, b) -> the pixels of the images, of w by h, reduced by factor.

    A worker makes a strip of the reduced rows, from the rows of the image within the kernel's reach of it.
    """
    reach = 4 * factor + 1
    place = lambda by: F.floor((F.col("y") + by) / (strip * factor))
    last = F.floor((F.floor(F.col("h") / factor) - 1) / strip)
    strips = F.filter(F.sequence(place(-reach), place(reach)), lambda s: (s >= 0) & (s <= last))
    dealt = pixels.select("slide", "y", "x", "r", "g", "b", "w", "h", F.explode(strips).alias("_strip"))

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).to_numpy()
        w, h, first = int(column("w")[0]), int(column("h")[0]), int(column("_strip")[0]) * strip
        last, y = min(h // factor, first + strip), column("y")
        low = int(y.min())
        image = np.zeros((int(y.max()) - low + 1, w, 3), np.uint8)
        for i, c in enumerate("rgb"):
            image[y - low, column("x"), i] = column(c)
        small = resize_part(lambda a, b: image[a - low : b - low], h, w, h // factor, w // factor, first, last)
        rows, columns = np.indices(small.shape[:2])
        return pa.table({"slide": table.column("slide").take(pa.array(np.zeros(rows.size, np.int64))), "y": (rows + first).ravel(), "x": columns.ravel(), **{c: pa.array(small[:, :, i].ravel(), pa.int32()) for i, c in enumerate("rgb")}})

    return dealt.groupBy("slide", "_strip").applyInArrow(run, f"slide {pixels.schema['slide'].dataType.simpleString()}, y long, x long, r int, g int, b int")


def without_alpha(pixels: Column | str, samples: Column | str) -> Column:
    """Interleaved samples of a tile, three or four a pixel -> three a pixel."""

    @pandas_udf("binary")
    def drop(pixels: pd.Series, samples: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(-1, int(n))[:, :3]).tobytes() for p, n in zip(pixels, samples)])

    return drop(pixels, samples)


def resized(pixels: Column | str, width: Column | str, target: int) -> Column:
    """Interleaved RGB samples of a tile, and its width -> those of a square of the target side; unchanged if it is one."""

    @pandas_udf("binary")
    def scale(pixels: pd.Series, width: pd.Series) -> pd.Series:
        def one(p, w):
            image = np.frombuffer(p, np.uint8).reshape(-1, int(w), 3)
            return p if image.shape[:2] == (target, target) else resize(image, target, target).tobytes()

        return pd.Series([None if p is None else one(p, w) for p, w in zip(pixels, width)])

    return scale(pixels, width)


def transform(image: np.ndarray, size: int, mean: list[float], deviation: list[float]) -> np.ndarray:
    """Alpha dropped, shorter side resized, centre cut out, standardised: C x size x size."""
    image = image[:, :, :3]
    scale = size / min(image.shape[:2])
    image = resize(image, max(size, round(image.shape[0] * scale)), max(size, round(image.shape[1] * scale)))
    y, x = (image.shape[0] - size) // 2, (image.shape[1] - size) // 2
    cut = image[y : y + size, x : x + size].astype(np.float32) / 255
    return ((cut - np.array(mean, np.float32)) / np.array(deviation, np.float32)).transpose(2, 0, 1)
