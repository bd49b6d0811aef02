"""TIFF files by their directories: levels, and regions of a level from the tiles or strips that they touch.

Baseline images of 8-bit samples, uncompressed or deflated, with or without differencing, in the classic and the 64-bit
form. Each page that is smaller than the first, at its proportions, is a level.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from typing import BinaryIO

import numpy as np

#: Fixed values of the format: bytes of a field's type, and the tags read here.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
LETTERS = {1: "B", 3: "H", 4: "I", 13: "I", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
DEFLATE = (8, 32946)


class Tiff:
    def __init__(self, file: BinaryIO):
        self.file = file
        head = self._at(0, 16)
        self.order = {b"II": "<", b"MM": ">"}.get(head[:2], "")
        kind = struct.unpack_from(f"{self.order}H", head, 2)[0] if self.order else 0
        if kind not in (42, 43):
            raise ValueError("not a TIFF file")
        self.big = kind == 43
        at = struct.unpack_from(f"{self.order}Q", head, 8)[0] if self.big else struct.unpack_from(f"{self.order}I", head, 4)[0]
        pages = []
        while at and len(pages) < 64:
            fields, at = self._directory(at)
            pages.append(fields)
        if not pages:
            raise ValueError("a TIFF file without pages")
        first = pages[0]
        proportion = first[WIDTH][0] / first[HEIGHT][0]
        self.pages = [first, *(p for p in pages[1:] if p[WIDTH][0] < first[WIDTH][0] and abs(p[WIDTH][0] / p[HEIGHT][0] / proportion - 1) < 0.05)]

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _directory(self, at: int) -> tuple[dict[int, tuple], int]:
        number, entry, long = ("Q", 20, "Q") if self.big else ("H", 12, "I")
        size = struct.calcsize(number)
        count = struct.unpack(self.order + number, self._at(at, size))[0]
        raw = self._at(at + size, count * entry + struct.calcsize(long))
        fields = {}
        for i in range(count):
            tag, kind, n = struct.unpack_from(f"{self.order}HH{long}", raw, i * entry)
            if kind not in LETTERS:
                continue
            length, inline = SIZES[kind] * n, raw[i * entry + 4 + struct.calcsize(long) : (i + 1) * entry]
            data = inline[:length] if length <= len(inline) else self._at(struct.unpack(self.order + long, inline)[0], length)
            fields[tag] = struct.unpack(f"{self.order}{n}{LETTERS[kind]}", data)
        return fields, struct.unpack_from(self.order + long, raw, count * entry)[0]

    @property
    def levels(self) -> list[tuple[int, int, float]]:
        return [(p[WIDTH][0], p[HEIGHT][0], self.pages[0][WIDTH][0] / p[WIDTH][0]) for p in self.pages]

    def region(self, level: int, x: int, y: int, width: int, height: int) -> np.ndarray:
        """height x width x samples; only the tiles or strips that it touches are read."""
        page = self.pages[level]
        full, tall, samples = page[WIDTH][0], page[HEIGHT][0], page.get(SAMPLES, (1,))[0]
        if x < 0 or y < 0 or x + width > full or y + height > tall:
            raise ValueError(f"region {x},{y} {width}x{height} isn't within {full}x{tall}")
        compression = page.get(COMPRESSION, (1,))[0]
        if set(page.get(BITS, (1,))) != {8} or page.get(PLANAR, (1,))[0] != 1 or compression not in (1, *DEFLATE):
            raise ValueError("only interleaved 8-bit samples, uncompressed or deflated, are read here")
        tiled = TILE_OFFSETS in page
        wide, high = (page[TILE_WIDTH][0], page[TILE_HEIGHT][0]) if tiled else (full, min(tall, page.get(ROWS, (tall,))[0]))
        offsets, counts = (page[TILE_OFFSETS], page[TILE_COUNTS]) if tiled else (page[OFFSETS], page[COUNTS])
        across = -(-full // wide)
        out = np.zeros((height, width, samples), np.uint8)
        for row in range(y // high, -(-(y + height) // high)):
            for column in range(x // wide, -(-(x + width) // wide)):
                raw = self._at(offsets[row * across + column], counts[row * across + column])
                raw = zlib.decompress(raw) if compression in DEFLATE else raw
                lines = high if tiled else min(high, tall - row * high)
                piece = np.frombuffer(raw, np.uint8, lines * wide * samples).reshape(lines, wide, samples)
                if page.get(PREDICTOR, (1,))[0] == 2:
                    piece = np.cumsum(piece, 1, dtype=np.uint8)
                top, left = row * high, column * wide
                a, b = max(y, top), min(y + height, top + lines)
                c, d = max(x, left), min(x + width, left + wide)
                out[a - y : b - y, c - x : d - x] = piece[a - top : b - top, c - left : d - left]
        return out


def write(file: BinaryIO, pages: list[np.ndarray], tile: int | None = None, deflate: bool = True, order: str = "<", photometric: int = 2) -> None:
    """Pages of 8-bit samples (H x W x samples), in tiles of a side or in one strip."""
    entry: Callable = lambda tag, kind, *values: (tag, kind, values)
    file.write((b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 0))
    link = 4  # where the place of the next directory goes
    for image in pages:
        height, width, samples = image.shape
        side = tile or max(height, width)
        pieces = []
        for top in range(0, height, side):
            for left in range(0, width, side):
                piece = image[top : top + side, left : left + side]
                if tile:
                    piece = np.pad(piece, ((0, side - piece.shape[0]), (0, side - piece.shape[1]), (0, 0)))
                raw = np.ascontiguousarray(piece).tobytes()
                pieces.append(zlib.compress(raw) if deflate else raw)
        places = []
        for p in pieces:
            places.append(file.tell())
            file.write(p + bytes(len(p) % 2))
        sizes = [len(p) for p in pieces]
        where = [entry(TILE_WIDTH, 4, side), entry(TILE_HEIGHT, 4, side), entry(TILE_OFFSETS, 4, *places), entry(TILE_COUNTS, 4, *sizes)] if tile else [entry(OFFSETS, 4, *places), entry(ROWS, 4, height), entry(COUNTS, 4, *sizes)]
        fields = sorted([entry(WIDTH, 4, width), entry(HEIGHT, 4, height), entry(BITS, 3, *[8] * samples), entry(COMPRESSION, 3, 8 if deflate else 1), entry(PHOTOMETRIC, 3, photometric), entry(SAMPLES, 3, samples), *where])
        body, rows = [], []
        at = file.tell() + 2 + 12 * len(fields) + 4
        for tag, kind, values in fields:
            data = struct.pack(f"{order}{len(values)}{LETTERS[kind]}", *values)
            if len(data) > 4:
                body.append(data + bytes(len(data) % 2))
                data, at = struct.pack(f"{order}I", at), at + len(body[-1])
            rows.append(struct.pack(f"{order}HHI", tag, kind, len(values)) + data.ljust(4, b"\0"))
        here = file.tell()
        file.write(struct.pack(f"{order}H", len(fields)) + b"".join(rows) + bytes(4) + b"".join(body))
        end = file.tell()
        file.seek(link)
        file.write(struct.pack(f"{order}I", here))
        file.seek(end)
        link = here + 2 + 12 * len(fields)
