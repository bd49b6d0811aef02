import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from tilespark.llm import media


def slow_decode(jpeg):
    """Baseline scans one symbol at a time: (component, 64 coefficients) of each block, in the scan's order."""
    at, tables, restart = 2, {}, 0
    while True:
        marker, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        body = jpeg[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC4:
            place = 0
            while place < len(body):
                code, codes, symbol = 0, {}, place + 17
                for length, n in enumerate(body[place + 1 : place + 17], 1):
                    for _ in range(n):
                        codes[length, code] = body[symbol]
                        code, symbol = code + 1, symbol + 1
                    code <<= 1
                tables[body[place]] = codes
                place = symbol
        elif marker == 0xC0:
            height, width = struct.unpack_from(">HH", body, 1)
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15) for i in range(body[5])]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            use = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, 16 | body[2 + 2 * i] & 15) for i in range(body[0])}
            break
    wide, high = max(p[1] for p in parts), max(p[2] for p in parts)
    unit = [i for i, (_, h, v) in enumerate(parts) for _ in range(h * v)] if len(parts) > 1 else [0]
    units = -(-width // (8 * wide)) * -(-height // (8 * high)) if len(parts) > 1 else -(-width // 8) * -(-height // 8)
    bits = nbits = 0
    before = [0] * len(parts)
    out = []

    def take(n):
        nonlocal bits, nbits, at
        while nbits < n:
            b = jpeg[at]
            at += 2 if b == 0xFF and jpeg[at + 1] == 0 else 1
            bits, nbits = bits << 8 | b, nbits + 8
        nbits -= n
        value = bits >> nbits
        bits &= (1 << nbits) - 1
        return value

    def symbol(codes):
        code = 0
        for length in range(1, 17):
            code = code << 1 | take(1)
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError

    def signed(n):
        value = take(n) if n else 0
        return value if not n or value >> n - 1 else value - (1 << n) + 1

    for u in range(units):
        if restart and u and u % restart == 0:
            bits = nbits = 0
            before = [0] * len(parts)
            at += 2
        for c in unit:
            block = [0] * 64
            before[c] += signed(symbol(tables[use[parts[c][0]][0]]))
            block[0] = before[c]
            k = 1
            while k < 64:
                run, n = divmod(symbol(tables[use[parts[c][0]][1]]), 16)
                if not n and run != 15:
                    break
                k += run
                if n:
                    block[k] = signed(n)
                k += 1
            out.append((c, block))
    return out


def other_writer(rng, width, height, sampling, restart):
    """A frame from other tables than this writer's: codes of eight bits for every category and every run, random blocks."""
    used = [r << 4 | s for r in range(16) for s in range(1, 8)] + [0x00, 0xF0]
    rng.shuffle(used)
    lengths = {6: 20, 9: len(used) - 20}  # two lengths
    lead = {4: 10}
    table = lambda kind, counts, symbols: media._segment(0xC4, bytes([kind, *(counts.get(n, 0) for n in range(1, 17))]) + bytes(symbols))
    codes = lambda counts, symbols: dict(_canonical(counts, symbols))
    dc, ac = codes(lead, range(10)), codes(lengths, used)
    n = len(sampling)
    head = b"\xff\xd8" + media._segment(0xDB, bytes([0]) + bytes(rng.randrange(1, 9) for _ in range(64)))
    head += media._segment(0xC0, struct.pack(">BHHB", 8, height, width, n) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling)))
    head += table(0x00, lead, range(10)) + table(0x11, lengths, used)
    head += media._segment(0xDD, struct.pack(">H", restart)) if restart else b""
    head += media._segment(0xDA, bytes([n]) + b"".join(bytes([i + 1, 0x01]) for i in range(n)) + b"\0\x3f\0")
    wide, high = max(h for h, _ in sampling), max(v for _, v in sampling)
    unit = [i for i, (h, v) in enumerate(sampling) for _ in range(h * v)] if n > 1 else [0]
    units = -(-width // (8 * wide)) * -(-height // (8 * high)) if n > 1 else -(-width // 8) * -(-height // 8)
    bits, body, before, blocks = "", b"", [0] * n, []

    def number(v):
        size = abs(v).bit_length()
        return size, format(v if v >= 0 else v + (1 << size) - 1, f"0{size}b") if size else ""

    def flush(bits):
        bits += "1" * (-len(bits) % 8)
        return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")

    for u in range(units):
        if restart and u and u % restart == 0:
            body += flush(bits) + bytes([0xFF, 0xD0 + (u // restart - 1) % 8])
            bits, before = "", [0] * n
        for c in unit:
            block = [rng.randrange(-120, 120)] + [rng.choice([0] * rng.choice([1, 20]) + [rng.randrange(-100, 100)]) for _ in range(63)]
            blocks.append((c, block))
            size, tail = number(block[0] - before[c])
            before[c] = block[0]
            bits += dc[size] + tail
            zeros = 0
            last = max([k for k in range(1, 64) if block[k]], default=0)
            for k in range(1, last + 1):
                if not block[k]:
                    zeros += 1
                    continue
                while zeros > 15:
                    bits, zeros = bits + ac[0xF0], zeros - 16
                size, tail = number(block[k])
                bits += ac[zeros << 4 | size] + tail
                zeros = 0
            if last < 63:
                bits += ac[0]
    return head + body + flush(bits) + b"\xff\xd9", blocks


def _canonical(counts, symbols):
    code, symbols = 0, iter(symbols)
    for length in range(1, 17):
        for _ in range(counts.get(length, 0)):
            yield next(symbols), format(code, f"0{length}b")
            code += 1
        code <<= 1


def dense(found):
    out = np.zeros((len(found.mean), 64), int)
    out[:, 0] = found.mean
    out[found.block, found.place] = found.value
    return out


@pytest.mark.parametrize(("sampling", "restart"), [([(1, 1)], 0), ([(1, 1)], 3), ([(2, 2), (1, 1), (1, 1)], 0), ([(2, 1), (1, 1), (1, 1)], 2)])
def test_frames_of_another_writer(sampling, restart):
    rng = random.Random(len(sampling) * 10 + restart)
    frames, blocks = zip(*(other_writer(random.Random(3) if k == 0 else rng, 40, 24, sampling, restart) for k in range(3)))
    data = b"".join(frames)
    places = np.cumsum([0, *map(len, frames)])
    got = [None] * 3
    for which, found in media.decode_frames([(data, int(a), int(b - a)) for a, b in zip(places, places[1:])]):
        values = dense(found)
        for i, a, b in zip(which, found.begin, found.begin[1:]):
            got[i] = [(int(c), v.tolist()) for c, v in zip(found.component[a:b], values[a:b])]
    for mine, want, jpeg in zip(got, blocks, frames):
        assert mine == want == slow_decode(jpeg)


@pytest.mark.parametrize("payload", [bytes(64), bytes(range(256)), b"\xff" * 640, b"abc" * 64 * 30, random.Random(1).randbytes(64 * 50), b"\x00\xff" * 320])
def test_payload_comes_back_and_slow_decoding_agrees(payload):
    (file,) = media.write_avis([payload])
    (shown,) = media.read_avis([file])
    assert shown.payload == payload
    video = media.parse_avi(file)
    slow = [b[0] + 128 for p, n in video.frames for _, b in slow_decode(file[p : p + n])]
    assert bytes(slow)[: len(payload)] == payload and len(slow) == 256 * len(video.frames)


def test_broken_frames_are_told():
    (file,) = media.write_avis([bytes(range(256))])
    ((p, n),) = media.parse_avi(file).frames
    jpeg = file[p : p + n]
    for broken in (b"no" + jpeg, jpeg.replace(b"\xff\xc0", b"\xff\xc2"), jpeg[: len(media.HEADER)] + jpeg[-2:], jpeg.replace(b"\xff\xd3", b"")):
        with pytest.raises(ValueError):
            media.decode_frames([(broken, 0, len(broken))])
    with pytest.raises(ValueError):
        media.parse_avi(b"RIFF....")


def test_shades_equal_those_of_the_pixels():
    rng = random.Random(9)
    jpeg, blocks = other_writer(rng, 64, 64, [(1, 1)], 0)
    ((_, found),) = media.decode_frames([(jpeg, 0, len(jpeg))])
    pixels = np.clip(np.rint(np.array([b for _, b in blocks], np.float32) * found.quantiser @ media.INVERSE) + 128, 0, 255).astype(int)
    want = np.bincount(pixels.ravel() // 16, minlength=16)
    got = media.histograms(found)[0]
    assert got[:16].tolist() == want.tolist() and got[16] == pixels.sum()


def test_inverse_transform():
    flat = np.zeros((1, 64), np.float32)
    flat[0, 0] = 80
    assert (np.rint(flat @ media.INVERSE) == 10).all()
    assert np.allclose(media.INVERSE @ media.INVERSE.T, np.eye(64), atol=1e-5)
    assert sorted(media.ZIGZAG.tolist()) == list(range(64)) and media.ZIGZAG[:6].tolist() == [0, 1, 8, 16, 9, 2] and media.ZIGZAG[-1] == 63


def plain_shots(frames):
    """Histograms, differences and thresholds by plain loops over grey values."""
    shares = []
    for f in frames:
        bins = [0] * media.BINS
        for v in f:
            bins[v * media.BINS // 256] += 1
        shares.append([b / len(f) for b in bins])
    change = [sum(abs(a - b) for a, b in zip(x, y)) / 2 for x, y in zip(shares, shares[1:])]
    out = [0]
    for i, c in enumerate(change):
        recent = change[max(0, i - media.WINDOW) : i] or [0.0]
        mean = sum(recent) / len(recent)
        deviation = max(0.0, sum(x * x for x in recent) / len(recent) - mean**2) ** 0.5
        if c > max(media.LEAST_DIFFERENCE, mean + media.DEVIATIONS * deviation) + 1e-12:
            out.append(i + 1)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_shots_equal_plain_loops(seed):
    rng = random.Random(seed)
    frames = []
    while len(frames) < 60:
        low = rng.randrange(200)
        frames += [bytes(rng.randrange(low, low + 50) for _ in range(256)) for _ in range(rng.choice([1, 4, 9]))]
    (shown,) = media.read_avis(media.write_avis([b"".join(frames)]))
    assert shown.starts == plain_shots(frames) and len(shown.starts) > 1
    assert sum(c[3] for c in shown.clips) == len(frames) and shown.light == pytest.approx(np.mean([list(f) for f in frames]))


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é" * 5000, "x"), (4, "é" * 5000, "x"), (None, "a" * 2_000_000, "x"), (1, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media string")
    videos = media.as_video(docs)
    cuts = media.clips(videos).collect()
    for i, text, _ in rows:
        ((n, length, digest, tail, size, stored, feature, clips),) = media.digests([text])
        payload = (text or "").encode()
        payload += bytes(max(64, -(-len(payload) // 64) * 64) - len(payload))
        assert (n, length, digest, tail) == (len((text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        mine = {(c.clip, c.start_ms, c.end_ms, c.frames) for c in cuts if c.doc_id == i}
        assert mine == {tuple(c.values()) for c in clips}
        assert sum(c["frames"] for c in clips) == -(-length // 256)
        assert f"shots={','.join(str(round(c['start_ms'] * media.FPS / 1000)) for c in clips)};" in feature
    assert media.digests(["é" * 5000, "x"])[0] == media.digests(["é" * 5000])[0]
    assert media.clips(videos.limit(0)).collect() == []
