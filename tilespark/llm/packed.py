"""Arrays packed into binary cells, so that a shuffle moves few large rows instead of many small ones."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_LEVEL = 1


def pack(*arrays: np.ndarray) -> bytes:
    """Byte planes apart, then compressed: the high bytes of small or rising numbers cost next to nothing."""
    head, body = [struct.pack("<I", len(arrays))], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        body.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes())
    return zstandard.ZstdCompressor(level=_LEVEL).compress(b"".join(head + body))


def unpack(cell: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(cell)
    count = struct.unpack_from("<I", raw)[0]
    kinds = [struct.unpack_from("<2sQ", raw, 4 + 10 * i) for i in range(count)]
    at, out = 4 + 10 * count, []
    for code, n in kinds:
        kind = np.dtype("<" + code.decode())
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def rising(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences."""
    return np.diff(keys, prepend=keys.dtype.type(0))


def risen(differences: np.ndarray) -> np.ndarray:
    return np.cumsum(differences, dtype=differences.dtype)


def bounds(values: np.ndarray) -> np.ndarray:
    """Where each group of equal neighbours begins, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + length[0] - 1, then start[1] .., in one array."""
    total = int(length.sum())
    out = np.ones(total, np.int64)
    keep = length > 0
    start, length = start[keep].astype(np.int64), length[keep].astype(np.int64)
    if not total:
        return np.zeros(0, np.int64)
    at = np.concatenate([[0], np.cumsum(length)[:-1]])
    out[at] = start
    out[at[1:]] -= start[:-1] + length[:-1] - 1
    return np.cumsum(out)
