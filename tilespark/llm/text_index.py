"""Full-text indexes over a shard's texts, searched for many patterns at once.

Both answer backward steps: from the interval of the suffixes that begin with a string to the interval of those that
begin with one more symbol in front. WaveletIndex keeps the Burrows-Wheeler transform in a wavelet matrix of packed bits
with counts a word; RunIndex keeps its runs, with the running counts of each symbol at the runs' ends. Suffixes are
sorted by as many symbols as a pattern can have. Each also keeps the order keys of the places in suffix order, with
their range minima, to tell whether a string also stands earlier.
"""

from __future__ import annotations

import numpy as np


def bounded_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first depth symbols at least, by doubling the compared length."""
    n = len(text)
    have = 1
    if text.dtype == np.uint8:  # seven symbols at once
        padded = np.concatenate([text, np.zeros(7, np.uint8)]).astype(np.uint64)
        keys = np.zeros(n, np.uint64)
        for i in range(7):
            keys = keys << np.uint64(8) | padded[i : i + n]
        have = 7
    else:
        keys = text.astype(np.uint64)
    order = np.argsort(keys)
    ranked = keys[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    slot = np.arange(n)
    rank = np.empty(n, np.int64)  # the first slot of a suffix's group of equals
    rank[order] = np.maximum.accumulate(np.where(fresh, slot, 0))
    while have < depth:
        # only groups of two and more are sorted on; they keep their slots
        slot = slot[~(fresh & np.append(fresh[1:], True))]
        if not len(slot):
            break
        rest = order[slot]
        after = np.where(rest + have < n, rank[np.minimum(rest + have, n - 1)] + 1, 0)
        keys = rank[rest] * (n + 1) + after
        by = np.argsort(keys)
        keys, rest = keys[by], rest[by]
        order[slot] = rest
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[rest] = np.maximum.accumulate(np.where(fresh, slot, 0))
        have *= 2
    return order


class RangeMinimum:
    """Minima of all stretches of 1, 2, 4 .. BLOCK values; of longer ones, by whole blocks between two of BLOCK."""

    BLOCK_BITS = 12

    def __init__(self, values: np.ndarray):
        n = len(values)
        levels = max(1, min(self.BLOCK_BITS + 1, n.bit_length()))
        size = [n - (1 << k) + 1 for k in range(levels)]
        self.base = np.cumsum([0, *size])
        self.flat = np.empty(self.base[-1], values.dtype)
        self.flat[:n] = values
        for k in range(1, levels):
            half, last = 1 << k - 1, self.flat[self.base[k - 1] : self.base[k]]
            np.minimum(last[: size[k]], last[half : half + size[k]], out=self.flat[self.base[k] : self.base[k + 1]])
        self.blocks = None
        if n > 1 << self.BLOCK_BITS:
            whole = n >> self.BLOCK_BITS
            self.blocks = RangeMinimum(values[: whole << self.BLOCK_BITS].reshape(whole, -1).min(1))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of values[lo:hi], none empty."""
        level = np.minimum(np.frexp((hi - lo).astype(np.float64))[1] - 1, self.BLOCK_BITS)
        base = self.base[level]
        out = np.minimum(self.flat[base + lo], self.flat[base + hi - (1 << level)])
        if self.blocks is not None:
            first, last = -(-lo >> self.BLOCK_BITS), hi >> self.BLOCK_BITS
            long = np.flatnonzero((hi - lo > 2 << self.BLOCK_BITS) & (first < last))
            if len(long):
                out[long] = np.minimum(out[long], self.blocks.least(first[long], last[long]))
        return out


class _Index:
    def __init__(self, text: np.ndarray, symbols: int, keys: np.ndarray, depth: int):
        """text: symbols from 1, apart from separators 0. keys: the order key of each place."""
        order = bounded_suffixes(text, depth)
        self.size = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.keys = RangeMinimum(keys[order])
        self._transform(text[order - 1], symbols)

    def _transform(self, bwt: np.ndarray, symbols: int) -> None:
        raise NotImplementedError

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = symbol.astype(np.int64)
        both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        before = self.before[symbol]
        return both[: len(lo)] + before, both[len(lo) :] + before


def _packed(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 bits a word, one word more than needed; and the bits set before each word."""
    packed = np.packbits(bits, bitorder="little")
    words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
    return words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int32)])


class WaveletIndex(_Index):
    def _transform(self, bwt: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (bwt >> level & 1).astype(bool)
            words, counts = _packed(bit)
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(int((~bit).sum()))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        every = np.arange(symbols + 1)
        self.start = np.zeros(symbols + 1, np.int64)
        self.start = self._walk(every, np.zeros(symbols + 1, np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            word = place >> 6
            mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][word] + np.bitwise_count(self.words[level][word] & mask)
            place = np.where(symbol >> (self.bits - 1 - level) & 1, self.zeros[level] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._walk(symbol, place) - self.start[symbol]


class RunIndex(_Index):
    """Nothing is kept for each place but a bit where a run begins, with counts a word: the predecessor among the runs'
    beginnings is found by counting bits."""

    def _transform(self, bwt: np.ndarray, symbols: int) -> None:
        begins = np.concatenate([[True], bwt[1:] != bwt[:-1]])
        self.words, self.counts = _packed(begins)
        run = np.flatnonzero(begins)  # first place of each run
        self.head = bwt[run].astype(np.int64)
        self.runs = len(run)
        length = np.diff(run, append=len(bwt))
        order = np.argsort(self.head, kind="stable")  # the runs of each symbol in turn
        self.of = self.head[order] * (self.runs + 1) + order
        full = np.concatenate([[0], np.cumsum(length[order])])  # symbols up to each of these runs
        first = np.searchsorted(self.head[order], np.arange(symbols + 1))
        before = full[:-1] - full[first[self.head[order]]]  # of the same symbol, at the runs' beginnings
        self.within = np.empty(self.runs, np.int64)  # what to add to a place in a run of the symbol sought
        self.within[order] = before - run[order]
        self.full, self.base = full, full[first]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (63 - (place & 63)).astype(np.uint64)  # up to the place itself
        at = self.counts[word] + np.bitwise_count(self.words[word] & mask) - 1
        out = place + self.within[at]
        other = np.flatnonzero(self.head[at] != symbol)
        if len(other):
            sought = symbol[other]
            out[other] = self.full[np.searchsorted(self.of, sought * (self.runs + 1) + at[other])] - self.base[sought]
        return out


def earlier_matches(kind: type[_Index], text: np.ndarray, symbols: int, keys: np.ndarray, end_keys: np.ndarray, start: np.ndarray, length: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal matches of at least `least` symbols, in each pattern, with what stands at an earlier place.

    The patterns are pieces of the text: start and length. A place is earlier if its key is smaller; end_keys are those
    of the places as ends of matches. Returns (pattern, begin, end) of the matches, which may overlap.

    A window that ends at e is first read forwards from its left end: where that fails, at g, no window that ends
    behind g can match, so the next one ends at g. A window that holds is extended backwards to its left end s, and
    reported; what stands in front of s then says where the next window may end. All patterns step together.
    """
    if not len(length):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    depth = int(length.max())
    ahead = kind(text, symbols, keys, depth)  # prepends
    behind = kind(text[::-1].copy(), symbols, end_keys[::-1].copy(), depth)  # appends, as it reads the text backwards
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lane = np.flatnonzero(length >= least)
    end = length[lane].astype(np.int64)
    backward = np.zeros(len(lane), bool)
    place = end - least  # the symbol read next
    checks = np.ones(len(lane), bool)  # the search tests a whole window; else it seeks the next end
    lo, hi = np.zeros(len(lane), np.int64), np.full(len(lane), len(text), np.int64)
    n = len(text)
    while len(lane):
        at = start[lane] + place
        live = np.ones(len(lane), bool)
        for index, mine, own in ((ahead, backward, keys), (behind, ~backward, end_keys)):
            i = np.flatnonzero(mine)
            if not len(i):
                continue
            a, b = index.step(lo[i], hi[i], text[at[i]])
            ok = a < b
            j = np.flatnonzero(ok)
            ok[j] = index.keys.least(a[j], b[j]) < own[at[i[j]]]
            lo[i], hi[i], live[i] = a, b, ok
        # those that go on
        go = live.copy()
        go &= np.where(backward, place > 0, place + 1 < end)
        step = np.where(backward, -1, 1)
        place = np.where(go, place + step, place)
        turn = np.flatnonzero(~go)
        if len(turn):
            back, good, p = backward[turn], live[turn], place[turn]
            # backwards: the match begins at p, or behind it
            begin = np.where(good, p, p + 1)
            said = turn[back]
            found.append((lane[said], begin[back], end[said]))
            # forwards: the match ends behind p, or at it
            reach = np.where(good, p + 1, p)
            whole = ~back & checks[turn] & good
            new_end = np.where(back | whole, end[turn], np.minimum(reach, end[turn] - 1))
            done = (back & (begin == 0)) | (~back & ~whole & (new_end < least))
            backward[turn] = whole
            checks[turn] = ~back
            end[turn] = new_end
            place[turn] = np.where(whole, new_end - 1, np.where(back, begin - 1, new_end - least))
            lo[turn], hi[turn] = 0, n
            if done.any():
                keep = np.ones(len(lane), bool)
                keep[turn[done]] = False
                lane, end, backward, place, checks, lo, hi = (x[keep] for x in (lane, end, backward, place, checks, lo, hi))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    which, begin, stop = (np.concatenate(x) for x in zip(*found))
    keep = stop - begin >= least
    return which[keep], begin[keep], stop[keep]
