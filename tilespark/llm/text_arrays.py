"""Words and windows of many texts at once, as arrays of 64-bit hashes.

A word's hash is a polynomial over random values of its bytes, finished by an avalanche step; all arithmetic is modulo
2**64. Hashes depend on the bytes only, so every worker and every run gives the same.
"""

from __future__ import annotations

import numpy as np

from .packed import ranges

U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BASE = U(0x9E3779B97F4A7C15)
#: A random value for each byte; white space counts as nothing.
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD_VALUE = np.where(SPACE, U(0), BYTE_VALUE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Powers of a base that are kept from call to call.
KEPT_POWERS = (1 << 20) + 64
_ladders: dict[int, np.ndarray] = {}


def _ladder(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base**0 .. base**(n - 1)."""
    known = _ladders.get(int(base))
    if known is None:
        known = _ladders[int(base)] = _ladder(KEPT_POWERS, base)
    if n <= KEPT_POWERS:
        return known[:n]
    step = (known[-1:] * base)[0]  # whole ladders, each of them times the power that it begins with
    return (_ladder(-(-n // KEPT_POWERS), step)[:, None] * known).reshape(-1)[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words:
    """hashes of all words; first[i] .. first[i + 1] are those of text i; start and end are byte places."""

    __slots__ = ("hashes", "first", "start", "end")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        n = len(data)
        if not n:
            self.hashes, self.first = np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
            self.start = self.end = np.zeros(0, np.int64)
            return
        word = ~SPACE[data]
        borders = offsets[1:-1]
        borders = borders[(borders > 0) & (borders < n)]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        begins[borders] = word[borders]
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        ends[borders - 1] = word[borders - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        if not len(self.start):
            self.hashes = np.zeros(0, np.uint64)
            return
        place = np.arange(n)
        place[: self.start[0]] = 0
        place[self.start[0] :] -= np.repeat(self.start, np.diff(self.start, append=n))
        value = _WORD_VALUE[LOWER[data] if lower else data] * powers(int(place.max()) + 1)[place]
        self.hashes = mix(np.add.reduceat(value, self.start))

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_INVERSE = U(pow(int(_BASE), -1, 2**64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of size values, wherever it starts; windows over borders are the caller's to drop."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(len(hashes)), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(len(hashes) - size + 1, _INVERSE))


def inside(first: np.ndarray, size: int, count: int) -> np.ndarray:
    """Whether the window that starts at each of count places lies in one text."""
    out = np.ones(count, bool)
    from_ = np.minimum(np.maximum(first[:-1], first[1:] - size + 1), count)
    out[ranges(from_, np.minimum(first[1:], count) - from_)] = False
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of width values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
