"""Pictures as sinks: PNG files of masks, overlays and tiles; and a tag of TIFF files set in place."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.functions import pandas_udf

from .scratch import put

COLORS = {"green": (0, 128, 0), "yellow": (255, 255, 0), "red": (255, 0, 0)}
#: TIFF's PhotometricInterpretation, and YCbCr as its value.
PHOTOMETRIC, YCBCR = 262, 6


def png(image: np.ndarray) -> bytes:
    """8-bit grey (H x W) or colour (H x W x 3) as a PNG file."""
    image = np.ascontiguousarray(image, np.uint8)
    height, width = image.shape[:2]
    rows = np.zeros((height, 1 + image[0].size if height else 1), np.uint8)  # each row behind a filter of 0
    rows[:, 1:] = image.reshape(height, -1)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def overlay(image: np.ndarray, x: np.ndarray, y: np.ndarray, side: int, colours: list[str]) -> np.ndarray:
    """Outlines of tiles, at the image's scale, on a copy; what lies outside isn't drawn."""
    out = np.array(image[:, :, :3], np.uint8)
    for left, top, colour in zip(x.tolist(), y.tolist(), colours):
        right, bottom = left + side, top + side
        for rows, columns in ((slice(top, top + 1), slice(left, right + 1)), (slice(bottom, bottom + 1), slice(left, right + 1)), (slice(top, bottom + 1), slice(left, left + 1)), (slice(top, bottom + 1), slice(right, right + 1))):
            out[max(0, rows.start) : max(0, rows.stop), max(0, columns.start) : max(0, columns.stop)] = COLORS[colour]
    return out


def tile_png(pixels: Column | str, width: Column | str) -> Column:
    """Raw interleaved RGB bytes of a tile and its width -> a PNG file."""

    @pandas_udf("binary")
    def encode(pixels: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([png(np.frombuffer(p, np.uint8).reshape(-1, int(w), 3)) for p, w in zip(pixels, width)])

    return encode(pixels, width)


def write_files(rows: DataFrame, folder: str) -> None:
    """rows (name, content) -> files below a folder that the workers share, by its scheme. A file is complete or absent."""

    def write(part: Iterator) -> None:
        for row in part:
            put(f"{folder}/{row.name}", bytes(row.content))

    rows.select("name", "content").foreachPartition(write)


def tiff_with_tag(data: bytes, tag: int = PHOTOMETRIC, value: int = YCBCR) -> bytes:
    """The file with a 16-bit tag of its first directory set; a file without that tag can't be set in place."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(f"{order}H", data, 2)[0] not in (42, 43):
        raise ValueError("not a TIFF file")
    big = struct.unpack_from(f"{order}H", data, 2)[0] == 43
    at = struct.unpack_from(f"{order}Q", data, 8)[0] if big else struct.unpack_from(f"{order}I", data, 4)[0]
    count = struct.unpack_from(f"{order}Q" if big else f"{order}H", data, at)[0]
    at, size = (at + 8, 20) if big else (at + 2, 12)
    out = bytearray(data)
    for entry in range(at, at + count * size, size):
        if struct.unpack_from(f"{order}H", data, entry)[0] == tag:
            struct.pack_into(f"{order}H", out, entry + (12 if big else 8), value)
            return bytes(out)
    raise ValueError(f"tag {tag} isn't in the first directory")


def with_photometric(content: Column | str, value: int = YCBCR) -> Column:
    """TIFF files with that tag set; null where it can't be."""

    @pandas_udf("binary")
    def rewrite(content: pd.Series) -> pd.Series:
        def one(data):
            try:
                return None if data is None else tiff_with_tag(data, PHOTOMETRIC, value)
            except (ValueError, struct.error):
                return None

        return pd.Series([one(d) for d in content], dtype=object)

    return rewrite(content)
