"""Media columns: AVI with motion-JPEG frames, written, parsed and cut into shots.

A payload byte is the grey of a block of 8 x 8 pixels: its quantised mean, the one coefficient that a plain block has,
which JPEG keeps losslessly. Frames are baseline grey JPEGs of 16 x 16 blocks, with a restart marker after each row; the
last one is filled up with black, and the payload's length stands in the file's comment. The reader walks the RIFF
tree, takes frame places from idx1 and decodes the entropy-coded scans of all frames at once, one symbol of each stretch
between restart markers at a time, whoever wrote them: baseline, any Huffman tables, any sampling of components. A shot
begins where the histogram difference to the frame before exceeds its own recent mean by a multiple of its recent
deviation.

Defined cases: null or empty text is a payload of 64 zero bytes; equal payloads give equal files; an empty table gives
an empty result; other columns are ignored. Frames without their own Huffman tables, progressive ones and files that
aren't AVI raise ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, slices

SIDE = 16  # blocks of a frame's row, which are those between restart markers, and rows
BLOCKS = SIDE * SIDE
FPS = 25
BINS = 16
WINDOW = 8
DEVIATIONS = 2.5
LEAST_DIFFERENCE = 0.25
#: Quantiser of the mean: a step is one grey level.
GREY = 8
COMMENT = b"payload bytes: "


def _zigzag() -> np.ndarray:
    """Place in row order of each coefficient in file order: along the diagonals, turning at each end."""
    return np.array([y * 8 + x for y, x in sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (sum(p), p[sum(p) % 2 == 0]))]).astype(np.intp)


def _inverse_cosine() -> np.ndarray:
    """64 x 64: coefficients in file order -> pixels of the block in row order."""
    k, n = np.arange(8)[:, None], np.arange(8)[None, :]
    basis = np.cos((2 * n + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    return np.einsum("uy,vx->uvyx", basis, basis).reshape(64, 64)[ZIGZAG].astype(np.float32)


ZIGZAG = _zigzag()
INVERSE = _inverse_cosine()

# ---- writing ---------------------------------------------------------------------------------------------------------

#: This writer's code lengths for the categories of differences of means, the likeliest first; and its one code of one
#: bit for the end of a block.
CATEGORIES = ((3, (5, 4, 7, 3, 2, 6)), (4, (1, 0)), (5, (8,)))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, codes: Sequence[tuple[int, tuple[int, ...]]]) -> bytes:
    counts = dict((n, len(s)) for n, s in codes)
    return _segment(0xC4, bytes([kind, *(counts.get(n, 0) for n in range(1, 17))]) + bytes(x for _, s in codes for x in s))


def jpeg_header() -> bytes:
    return (
        b"\xff\xd8" + _segment(0xDB, bytes([0, GREY]) + b"\1" * 63) + _segment(0xC0, struct.pack(">BHHBBBB", 8, 8 * SIDE, 8 * SIDE, 1, 1, 0x11, 0))
        + _huffman(0x00, CATEGORIES) + _huffman(0x10, ((1, (0,)),)) + _segment(0xDD, struct.pack(">H", SIDE)) + _segment(0xDA, b"\1\1\0\0\x3f\0")
    )


def _codes() -> tuple[np.ndarray, np.ndarray]:
    """By difference + 255: the bits of a block (category, difference, end of block), and how many."""
    code, before, found = 0, 0, {}
    for length, symbols in CATEGORIES:
        code <<= length - before
        for s in symbols:
            found[s], code = (code, length), code + 1
        before = length
    bits, lengths = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        head, length = found[size]
        bits[d + 255] = (head << size | (d if d >= 0 else d + (1 << size) - 1)) << 1
        lengths[d + 255] = length + size + 1
    return bits, lengths


HEADER = jpeg_header()
_BITS, _LENGTHS = _codes()


def encode_frames(payload: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """payload: whole frames of BLOCKS bytes -> (their chunks one behind the other, even in size; length of each JPEG)."""
    rows = payload.reshape(-1, SIDE).astype(np.int64) - 128
    difference = np.diff(rows, axis=1, prepend=0) + 255
    code, size = _BITS[difference], _LENGTHS[difference]
    end = np.cumsum(size, 1)
    words = np.zeros((len(rows), 5), np.uint64)  # 16 blocks of 14 bits at most, and what is shifted out of the last
    every = np.arange(len(rows))
    for j in range(SIDE):
        at = end[:, j] - size[:, j]
        word, shift = at >> 6, 64 - (at & 63) - size[:, j]
        own = np.where(shift >= 0, code[:, j] << np.maximum(shift, 0).astype(np.uint64), code[:, j] >> np.maximum(-shift, 0).astype(np.uint64))
        words[every, word] |= own
        words[every, word + 1] |= np.where(shift < 0, code[:, j] << np.where(shift < 0, 64 + shift, 0).astype(np.uint64), np.uint64(0))
    scan = words.byteswap().view(np.uint8).reshape(len(rows), 40)
    count = (end[:, -1] + 7) >> 3
    scan[every, count - 1] |= ((1 << (count * 8 - end[:, -1])) - 1).astype(np.uint8)  # filled up with ones
    valid = np.arange(40) < count[:, None]
    flat, row = scan[valid], np.repeat(every, count)
    stuffed = flat == 0xFF  # gets a zero behind it
    # each row: its bytes, then a marker; each frame: a chunk's head and the header, its rows, a byte if it is odd
    head = 8 + len(HEADER)
    row_size = count + np.bincount(row, stuffed, len(rows)).astype(np.int64) + 2
    frame_size = row_size.reshape(-1, SIDE).sum(1) + len(HEADER)
    frame_at = np.concatenate([[0], np.cumsum(frame_size + 8 + frame_size % 2)])
    inner = np.cumsum(row_size.reshape(-1, SIDE), 1) - row_size.reshape(-1, SIDE)
    row_at = (frame_at[:-1, None] + head + inner).reshape(-1)
    out = np.zeros(frame_at[-1], np.uint8)
    before = np.cumsum(1 + stuffed) - (1 + stuffed)
    first = np.cumsum(count) - count
    at = row_at[row] + before - before[first][row]
    out[at] = flat
    marker = row_at + row_size - 2
    out[marker] = 0xFF
    out[marker + 1] = np.where(every % SIDE == SIDE - 1, 0xD9, 0xD0 + every % SIDE % 8)
    heads = np.zeros((len(frame_size), head), np.uint8)
    heads[:, :4] = np.frombuffer(b"00dc", np.uint8)
    heads[:, 4:8] = frame_size.astype("<u4").view(np.uint8).reshape(-1, 4)
    heads[:, 8:] = np.frombuffer(HEADER, np.uint8)
    out[frame_at[:-1, None] + np.arange(head)] = heads
    return out, frame_size


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def avi_of(movi: bytes, lengths: np.ndarray, payload_bytes: int | None, width: int = 8 * SIDE, height: int = 8 * SIDE) -> bytes:
    """An AVI file of frames' chunks, and each JPEG's length."""
    count, most = len(lengths), int(lengths.max())
    steps = 8 + lengths + lengths % 2
    index = np.zeros((count, 4), "<u4")
    index[:, 0] = int.from_bytes(b"00dc", "little")
    index[:, 1] = 0x10  # each can be decoded by itself
    index[:, 2] = 4 + np.cumsum(steps) - steps
    index[:, 3] = lengths
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, count, 0, 1, most, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, count, most, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    info = b"" if payload_bytes is None else _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", COMMENT + str(payload_bytes).encode()))
    body = (
        b"AVI " + _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
        + info + _chunk(b"LIST", b"movi" + movi) + _chunk(b"idx1", index.tobytes())
    )
    return _chunk(b"RIFF", body)


def write_avis(payloads: list[bytes]) -> list[bytes]:
    """payloads: of a positive multiple of 64 bytes each."""
    counts = [-(-len(p) // BLOCKS) for p in payloads]
    filled = b"".join(x for p, n in zip(payloads, counts) for x in (p, bytes(n * BLOCKS - len(p))))
    chunks, lengths = encode_frames(np.frombuffer(filled, np.uint8))
    ends = np.cumsum(8 + lengths + lengths % 2)
    out, frame, at = [], 0, 0
    for p, n in zip(payloads, counts):
        end = int(ends[frame + n - 1])
        out.append(avi_of(chunks[at:end].tobytes(), lengths[frame : frame + n], len(p)))
        frame, at = frame + n, end
    return out


# ---- reading ---------------------------------------------------------------------------------------------------------


@dataclass
class Video:
    fps: float
    payload_bytes: int | None
    frames: list[tuple[int, int]]  # place and length of each frame's JPEG
    data: bytes


def parse_avi(data: bytes) -> Video:
    """Frame places come from idx1, relative to the movi list."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    fps, length, movi, index = 0.0, None, None, np.zeros((0, 4), "<u4")
    todo = [(12, 8 + struct.unpack_from("<I", data, 4)[0])]
    while todo:
        at, end = todo.pop()
        while at + 8 <= end:
            name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            if name == b"LIST":
                if data[at + 8 : at + 12] == b"movi":
                    movi = at + 8
                else:
                    todo.append((at + 12, at + 8 + size))
            elif name == b"strh" and data[at + 8 : at + 12] == b"vids":
                scale, rate = struct.unpack_from("<II", data, at + 8 + 20)
                fps = rate / scale
            elif name == b"ICMT" and data.startswith(COMMENT, at + 8):
                length = int(data[at + 8 + len(COMMENT) : at + 8 + size].rstrip(b"\0"))
            elif name == b"idx1":
                index = np.frombuffer(data, "<u4", size // 16 * 4, at + 8).reshape(-1, 4)
            at += 8 + size + size % 2
    if len(index) and movi is None:
        raise ValueError("an index without frames")
    places = index[:, 2].astype(np.int64) + (movi or 0) + 8
    return Video(fps, length, list(zip(places.tolist(), index[:, 3].tolist())), data)


@dataclass
class Scan:
    """What a frame's header says: sizes, a lookup of codes (by table and 16 bits: length << 8 | symbol), and for each
    block of a unit its component, and the lookups of its first and other coefficients."""

    height: int
    width: int
    units: int
    restart: int
    component: np.ndarray
    first: np.ndarray
    others: np.ndarray
    lookup: np.ndarray
    quantiser: np.ndarray


def _lookups(body: bytes) -> dict[int, np.ndarray]:
    """Huffman tables of a DHT segment, by class and id."""
    found, at = {}, 0
    while at < len(body):
        counts, code, table = body[at + 1 : at + 17], 0, np.zeros(1 << 16, np.uint16)
        symbol = at + 17
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                table[code << 16 - length : code + 1 << 16 - length] = length << 8 | body[symbol]
                code, symbol = code + 1, symbol + 1
            code <<= 1
        found[body[at]] = table
        at = symbol
    return found


def parse_header(jpeg: bytes | memoryview, at: int) -> tuple[Scan, int]:
    """(what the header that begins at a place says, where its scan begins)."""
    tables, quantisers, restart, frame = {}, {}, 0, None
    if bytes(jpeg[at : at + 2]) != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    at += 2
    while True:
        if jpeg[at] != 0xFF:
            raise ValueError("a marker was expected")
        marker, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        body = bytes(jpeg[at + 4 : at + 2 + size])
        at += 2 + size
        if marker == 0xC4:
            tables |= _lookups(body)
        elif marker == 0xDB:
            place = 0
            while place < len(body):
                wide = 2 if body[place] >> 4 else 1
                quantisers[body[place] & 15] = np.frombuffer(body, ">u2" if wide == 2 else "u1", 64, place + 1).astype(np.float32)
                place += 1 + 64 * wide
        elif marker in (0xC0, 0xC1):
            height, width, n = struct.unpack_from(">HHB", body, 1)
            frame = height, width, {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only baseline frames are decoded")
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            break
    if frame is None:
        raise ValueError("a scan without a frame")
    height, width, parts = frame
    used = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, 16 | body[2 + 2 * i] & 15) for i in range(body[0])]
    wide, high = (max(p[k] for p in parts.values()) for k in (0, 1))
    if len(used) == 1:  # a scan of one component isn't interleaved
        (name, _, _), = used
        across, down, repeat = -(-width * parts[name][0] // (8 * wide)), -(-height * parts[name][1] // (8 * high)), [1]
    else:
        across, down, repeat = -(-width // (8 * wide)), -(-height // (8 * high)), [parts[name][0] * parts[name][1] for name, _, _ in used]
    order = sorted(tables)
    try:
        first, others = ([order.index(u[k]) for u in used] for k in (1, 2))
    except ValueError as error:
        raise ValueError("a frame without its own Huffman tables") from error
    blocks = np.repeat(np.arange(len(used)), repeat)
    return Scan(height, width, across * down, restart, blocks, np.array(first)[blocks], np.array(others)[blocks], np.concatenate([tables[k] for k in order]), quantisers[parts[used[0][0]][2]]), at


@dataclass
class Coefficients:
    """Of several frames: where each frame's blocks begin; each block's component and its first coefficient; and those of
    the others that aren't 0, as block, place in file order, value. They are quantised; quantiser: of the first component."""

    begin: np.ndarray
    component: np.ndarray
    mean: np.ndarray
    block: np.ndarray
    place: np.ndarray
    value: np.ndarray
    quantiser: np.ndarray


def _stretches(scans: list[memoryview]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scans without stuffing and markers: (bytes, where each stretch between restart markers begins, its scan)."""
    raw = np.frombuffer(b"".join(scans), np.uint8)
    sizes = np.array([len(s) for s in scans])
    begin = np.cumsum(sizes) - sizes
    keep = np.ones(len(raw) + 1, bool)
    marks = np.flatnonzero(raw == 0xFF)
    after = raw[np.minimum(marks + 1, len(raw) - 1)]
    keep[marks[after == 0] + 1] = False
    restarts = marks[(after >= 0xD0) & (after <= 0xD7)]
    ends = marks[(after == 0xD9) | (after == 0xFF)]
    for gone in (restarts, ends):
        keep[gone] = keep[np.minimum(gone + 1, len(raw))] = False
    places = np.concatenate([[0], np.cumsum(keep)])
    start = np.sort(np.concatenate([begin, restarts + 2]))
    return raw[keep[:-1]], places[start], np.searchsorted(begin, start, "right") - 1


def decode_scans(spec: Scan, scans: list[memoryview]) -> Coefficients:
    """All scans of one header together: a lane a stretch, and a symbol of each lane at a step."""
    data, start, owner = _stretches(scans)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    window = padded[:-4] << np.uint64(32) | padded[1:-3] << np.uint64(24) | padded[2:-2] << np.uint64(16) | padded[3:-1] << np.uint64(8) | padded[4:]
    unit, per = len(spec.component), spec.restart or spec.units
    total = spec.units * unit
    nth = np.arange(len(start)) - np.searchsorted(owner, owner)  # of its scan
    todo = np.clip(spec.units - nth * per, 0, per) * unit  # blocks of each lane
    base = owner.astype(np.int64) * total + nth * per * unit
    if (np.bincount(owner, todo, len(scans)) != total).any():
        raise ValueError("a scan of too few stretches")
    mean = np.zeros(total * len(scans), np.int32)
    lane = np.flatnonzero(todo > 0)
    bit, done, k = start[lane].astype(np.int64) * 8, np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64)
    limit, base = todo[lane], base[lane]
    before = np.zeros((len(lane), int(spec.component.max()) + 1), np.int32)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(lane):
        kind = done % unit if unit > 1 else np.zeros(len(done), np.int64)
        table = np.where(k == 0, spec.first[kind], spec.others[kind])
        eight, off = np.minimum(bit >> 3, len(window) - 1), bit & 7
        held = window[eight]
        entry = spec.lookup[(table << 16) + (held >> (24 - off).astype(np.uint64) & np.uint64(0xFFFF)).astype(np.int64)]
        length, symbol = (entry >> 8).astype(np.int64), (entry & 255).astype(np.int64)
        if not length.all() or (bit > 8 * len(data)).any():
            raise ValueError("a scan with a code that isn't in its table, or that is cut")
        size = np.where(k == 0, symbol, symbol & 15)
        raw = (held >> (40 - off - length - size).astype(np.uint64)).astype(np.int64) & ((1 << size) - 1)
        value = np.where(raw < (1 << size) >> 1, raw - (1 << size) + 1, raw)
        bit += length + size
        leads = np.flatnonzero(k == 0)
        if len(leads):
            part = spec.component[kind[leads]]
            before[leads, part] += value[leads].astype(np.int32)
            mean[base[leads] + done[leads]] = before[leads, part]
        run = symbol >> 4
        stop = (k > 0) & (size == 0) & (run != 15)
        some = np.flatnonzero((k > 0) & (size > 0))
        if len(some):
            at = k[some] + run[some]
            if (at > 63).any():
                raise ValueError("a block of too many coefficients")
            found.append((base[some] + done[some], at, value[some]))
        k = np.where(k == 0, 1, np.where(stop, 64, k + run + 1))
        over = k >= 64
        done += over
        k[over] = 0
        gone = done == limit
        if gone.any():
            keep = ~gone
            lane, bit, done, k, limit, base, before = (x[keep] for x in (lane, bit, done, k, limit, base, before))
    block, place, value = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return Coefficients(np.arange(len(scans) + 1) * total, np.tile(np.tile(spec.component, spec.units), len(scans)), mean, block, place, value, spec.quantiser)


def decode_frames(frames: list[tuple[bytes, int, int]]) -> list[tuple[list[int], Coefficients]]:
    """frames (data, place, length) -> (which of them, their coefficients) for each different header."""
    groups: dict[bytes, tuple[Scan, list[int], list[memoryview]]] = {}
    head: bytes | None = None
    for i, (data, at, size) in enumerate(frames):
        if head is None or not data.startswith(head, at):
            spec, begin = parse_header(data, at)
            head = data[at:begin]
            groups.setdefault(head, (spec, [], []))
        _, which, scans = groups[head]
        which.append(i)
        scans.append(memoryview(data)[at + len(head) : at + size])
    return [(which, decode_scans(spec, scans)) for spec, which, scans in groups.values()]


def histograms(found: Coefficients) -> np.ndarray:
    """frames x BINS: how many pixels of the first component are of each shade; a last column: the sum of shades."""
    frames = len(found.begin) - 1
    frame = np.repeat(np.arange(frames), np.diff(found.begin))
    shade = np.clip(np.rint(found.mean * (found.quantiser[0] / 8)) + 128, 0, 255).astype(np.int64)
    plain = found.component == 0
    detailed = np.unique(found.block)
    detailed = detailed[plain[detailed]]
    plain[detailed] = False
    count = np.bincount(frame[plain] * BINS + shade[plain] // (256 // BINS), minlength=frames * BINS) * 64
    total = np.bincount(frame[plain], shade[plain], frames).astype(float) * 64
    for a in range(0, len(detailed), 4096):  # the inverse transform, where there is more than a mean
        some = detailed[a : a + 4096]
        values = np.zeros((len(some), 64), np.float32)
        values[:, 0] = found.mean[some]
        mine = np.flatnonzero(np.isin(found.block, some))
        values[np.searchsorted(some, found.block[mine]), found.place[mine]] = found.value[mine]
        pixels = np.clip(np.rint(values * found.quantiser @ INVERSE) + 128, 0, 255).astype(np.int64)
        count += np.bincount((frame[some][:, None] * BINS + pixels // (256 // BINS)).ravel(), minlength=frames * BINS)
        total += np.bincount(frame[some], pixels.sum(1), frames)
    return np.concatenate([count.reshape(frames, BINS), total[:, None].astype(np.int64)], 1)


def shots(histogram: np.ndarray) -> list[int]:
    """First frames of the shots. histogram: frames x BINS."""
    share = histogram / histogram.sum(1, keepdims=True)
    change = np.abs(np.diff(share, axis=0)).sum(1) / 2
    total, square = np.concatenate([[0], np.cumsum(change)]), np.concatenate([[0], np.cumsum(change**2)])
    i = np.arange(len(change))
    low = np.maximum(0, i - WINDOW)
    n = np.maximum(1, i - low)
    mean = (total[i] - total[low]) / n
    deviation = np.sqrt(np.maximum(0, (square[i] - square[low]) / n - mean**2))
    return [0, *(np.flatnonzero(change > np.maximum(LEAST_DIFFERENCE, mean + DEVIATIONS * deviation)) + 1).tolist()]


@dataclass
class Shown:
    """A file read: its payload, if it says that it has one; frames a shade; and shots."""

    payload: bytes | None
    histogram: np.ndarray
    starts: list[int]
    fps: float

    @property
    def clips(self) -> list[tuple[int, int, int, int]]:
        """(number, start and end in milliseconds, frames) of each shot."""
        edges = [*self.starts, len(self.histogram)]
        return [(k, int(a * 1000 / self.fps), int(b * 1000 / self.fps), b - a) for k, (a, b) in enumerate(zip(edges, edges[1:]))]

    @property
    def light(self) -> float:
        return float(self.histogram[:, BINS].sum() / max(1, self.histogram[:, :BINS].sum()))


def read_avis(files: list[bytes]) -> list[Shown]:
    """Files parsed, and all of their frames decoded together."""
    videos = [parse_avi(f) for f in files]
    decoded = decode_frames([(v.data, p, n) for v in videos for p, n in v.frames])
    count = sum(len(v.frames) for v in videos)
    shades, stored = np.zeros((count, BINS + 1), np.int64), [b""] * count
    for which, found in decoded:
        shades[which] = histograms(found)
        raw = (found.mean + 128).astype(np.uint8).tobytes()
        for i, a, b in zip(which, found.begin.tolist(), found.begin[1:].tolist()):
            stored[i] = raw[a:b]
    out, at = [], 0
    for v in videos:
        end = at + len(v.frames)
        mine = shades[at:end]
        payload = None if v.payload_bytes is None else b"".join(stored[at:end])[: v.payload_bytes]
        out.append(Shown(payload, mine, shots(mine[:, :BINS]) if len(mine) else [], v.fps))
        at = end
    return out


# ---- columns ---------------------------------------------------------------------------------------------------------


def text_payload(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    return raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw)), len(raw)


def digests(texts: list[str | None]) -> list[tuple]:
    """Of each text: what its payload, its file, and the file read again are."""
    payloads = [text_payload(t) for t in texts]
    files = write_avis([p for p, _ in payloads])
    out = []
    for (_, n), media, shown in zip(payloads, files, read_avis(files)):
        back = shown.payload
        feature = f"frames={len(shown.histogram)};shots={','.join(map(str, shown.starts))};light={round(shown.light, 3)}"
        clips = [dict(zip(("clip", "start_ms", "end_ms", "frames"), c)) for c in shown.clips]
        out.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, clips))
    return out


_CLIPS = pa.list_(pa.struct([(n, pa.int64()) for n in ("clip", "start_ms", "end_ms", "frames")]))
FIELDS = (
    ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()),
    ("media_sha256", pa.string()), ("feature", pa.string()), ("clips", _CLIPS),
)
SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips array<struct<clip:long,start_ms:long,end_ms:long,frames:long>>"
#: Text whose files are written and read together.
TOGETHER = 1 << 20


def as_video(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, media (the AVI file)."""

    def run(batches):
        for batch in slices(batches, limit=TOGETHER):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(write_avis([text_payload(t)[0] for t in batch.column(1).to_pylist()]), pa.binary())], ["doc_id", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, media binary")


def clips(videos: DataFrame) -> DataFrame:
    """videos (doc_id, media) -> a row a shot: doc_id, clip, start_ms, end_ms, frames. A null file has no rows."""

    def run(batches):
        for batch in slices(batches, "media", TOGETHER):
            known = [(i, m) for i, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if m is not None]
            rows = [(i, *c) for (i, _), shown in zip(known, read_avis([m for _, m in known])) for c in shown.clips]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], ["doc_id", "clip", "start_ms", "end_ms", "frames"])

    return videos.select("doc_id", "media").mapInArrow(run, "doc_id long, clip long, start_ms long, end_ms long, frames long")


def op5_avi_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches):
        for batch in slices(batches, limit=TOGETHER):
            rows = zip(*digests(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, (_, t) in zip(rows, FIELDS))], ["doc_id", *(n for n, _ in FIELDS)])

    return documents(spark, sf_dir, "doc_id", "text").mapInArrow(run, SCHEMA)


QUERIES = {"op5_avi_clips": op5_avi_clips}
SQL: dict[str, str] = {}
