import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilespark.llm import fingerprints as f
from tilespark.llm.text_arrays import BYTE_VALUE


def names(text, levels=3):
    symbols, first = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    for _ in range(levels):
        symbols, first = f.parse(symbols, first)
    return symbols.tolist()


def test_equal_substrings_share_interior_names():
    rng = random.Random(0)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = word(3000)
    for offset in (0, 1, 7, 40):
        other = names(word(offset) + shared + word(50))
        mine = names(shared)
        inner = mine[4:-4]
        at = other.index(inner[0])
        assert other[at : at + len(inner)] == inner


def test_phrases_are_short_and_not_empty():
    rng = random.Random(1)
    for text in ("a" * 1000, "ab" * 500, "".join(rng.choices("ab", k=4000)), "".join(rng.choices("abcdefghijklmnop", k=4000))):
        symbols = np.frombuffer(text.encode(), np.uint8)
        out, first = f.parse(symbols, np.array([0, len(symbols)]))
        assert 1 <= len(out) <= len(symbols) and first.tolist() == [0, len(out)]
        if len(set(text)) > 4:
            assert len(symbols) / 14 <= len(out) <= len(symbols) / 1.5


def test_texts_of_a_batch_do_not_mix():
    texts = ["", "a", "aa", "hello world, hello", "é" * 30, "", "hello world, hello"]
    for text, sketch in zip(texts, f._sketch_texts(texts)):
        assert f.to_text(sketch) == f.to_text(f._sketch_texts([text])[0])
    assert len(BYTE_VALUE) == len(set(BYTE_VALUE.tolist()))


MASK = (1 << 64) - 1


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_parse(symbols, as_bytes):
    """One level of one text, by plain loops."""
    runs = []
    for x in symbols:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    value = [int(BYTE_VALUE[x]) if as_bytes else x for x, _ in runs]
    value = [v if n == 1 else plain_mix((v + n) & MASK) for v, (_, n) in zip(value, runs)]

    def toss(own, left):
        bit = ((own ^ left) & -(own ^ left)).bit_length() - 1
        return 2 * bit + (own >> bit & 1)

    low = [x & 255 for x, _ in runs]
    labels = [toss(low[i], low[i - 1]) if i and low[i] != low[i - 1] else toss(runs[i][0], runs[i - 1][0]) if i else toss(low[0], low[0] ^ 1) for i in range(len(runs))]
    for _ in range(2):
        labels = [toss(x, labels[i - 1] if i else x ^ 1) for i, x in enumerate(labels)]
    starts = [i for i in range(len(runs)) if not i or (i + 1 < len(runs) and labels[i - 1] < labels[i] >= labels[i + 1])]
    out = []
    for a, b in zip(starts, [*starts[1:], len(runs)]):
        out.append(plain_mix(sum(value[i] * int(f._OFFSETS[(i - a) % len(f._OFFSETS)]) for i in range(a, b)) & MASK))
    return out


def plain_sketch(text):
    symbols, names = list(text.encode()), set()
    for level in range(1, max(f.LEVELS) + 1):
        symbols = plain_parse(symbols, level == 1)
        if level in f.LEVELS:
            names |= {plain_mix((x + level) & MASK) >> 32 for x in symbols}
    return sorted(names)[: f.SKETCH]


def test_fingerprints_equal_plain_loops():
    rng = random.Random(7)
    texts = ["", "a", "aaaa", "é" * 40, "ab" * 300] + ["".join(rng.choices(alphabet, k=rng.randrange(2, 900))) for alphabet in ("ab", "abc ", "abcdefghijklmnop qrst", "éüß漢字 x") for _ in range(6)]
    texts.append("".join(rng.choices("abcdefgh ", k=20_000)))
    for text, sketch in zip(texts, f._sketch_texts(texts)):
        assert sketch.tolist() == plain_sketch(text)


def held_against_plain(docs, rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    got = sorted(map(tuple, f.with_next(docs).collect()), key=repr)
    want = []
    sketch = lambda t: f._sketch_texts([t])[0]
    for (i, t, _), (_, n, _) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f.to_text(sketch(t)), f.to_text(sketch(edited)), f.likeness(sketch(t), sketch(edited)), f.likeness(sketch(t), sketch(n))))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("range_bytes", [32 << 20, 300])
def test_rows(spark, monkeypatch, range_bytes):
    """Unique, repeated and null ids, equal rows, a very long text; in few ranges and in many."""
    monkeypatch.setattr(f, "RANGE_BYTES", range_bytes)
    rng = random.Random(2)
    text = lambda n: "".join(rng.choices("abcdé fgh", k=n))
    rows = [(i * 7 % 101, text(rng.choice([0, 1, 2, 50, 900]))) for i in range(90)] + [(500, None), (501, "y" * 30_000), (502, text(2_000_000))]
    rows += [(None, text(40)) for _ in range(40)] + [(600, text(60)) for _ in range(40)] + [(700, "same row")] * 25 + [(-(1 << 63), "least"), ((1 << 63) - 1, "largest"), (-5, "below zero")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, bucket string, hash int").repartition(7)
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    held_against_plain(docs, [(i, t, hashes[t]) for i, t in rows])


def test_small_tables(spark):
    schema = "doc_id long, text string"
    assert f.with_next(spark.createDataFrame([], schema)).collect() == []
    one = f.with_next(spark.createDataFrame([(1, "alone here")], schema)).first()
    assert one.near_next == 1.0
    twice = f.with_next(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], schema)).collect()
    assert sorted(r.doc_id for r in twice) == [1, 1, 2]
