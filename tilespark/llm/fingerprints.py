"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases by deterministic coin tossing: runs of one symbol become one symbol; every symbol is
relabelled by the lowest bit in which it differs from its left neighbour, and that bit's value, until labels are small;
phrases begin where the label peaks. A phrase's name is a hash of its symbols, and the names are parsed again in the
same way. Where to cut depends on a few neighbours only, so equal substrings get equal names but near their ends,
wherever they stand. The fingerprint is a bottom-k sketch of the names of two levels; likeness is the sketches'
estimate of the names in common among all names.

Each document's successor is found by ranges of the order: a first pass over ids and hashes of texts tells where the
ranges begin, as many as the text's bytes ask for; a second one fingerprints each text where it lies and sends it to
its range, and the first row of each range to the one before it as well. A range is read as a stream, row by row.

Defined cases: null text is empty; an empty text has the empty fingerprint, whose likeness is 1 to itself and 0 to any
other; rows with one id follow each other by a hash of their text; null ids come last, and like rows of any one id are
spread over ranges by that hash; rows equal in both are neighbours; with one row, the next document is itself; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shuffle_width, slices, utf8
from .text_arrays import BYTE_VALUE, U, mix, powers

LEVELS = (2, 3)
SKETCH = 64
#: Text of a range; many ranges are one task's where texts are short.
RANGE_BYTES = 32 << 20
_OFFSETS = powers(4_096, U(0xD6E8FEB86659FD93))


def _toss_table() -> np.ndarray:
    """Labels of eight bits at most: [own, left] -> the new label."""
    own, left = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    low = own ^ left
    bit = np.zeros((256, 256), np.uint8)
    for k in range(7, -1, -1):
        bit[(low >> k & 1) == 1] = k
    return (2 * bit + (own >> bit & 1)).astype(np.uint8).reshape(-1)


_TOSS = _toss_table()


def _labels(symbols: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Three tosses: labels from 0 to 7; the first symbol of a text tosses against a fixed stranger.

    Neighbours differ, nearly always in their low bytes, which then decide; where those agree, all bits are compared.
    """
    label = symbols.astype(np.uint8)
    for toss in range(3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[head] = label[head] ^ 1
        same = np.flatnonzero(label == before) if not toss else ()
        after = _TOSS[label.astype(np.uint16) << np.uint16(8) | before]
        if len(same):
            own = symbols[same].astype(np.uint64)
            differ = own ^ symbols[same - 1].astype(np.uint64)
            bit = np.frexp((differ & (~differ + U(1))).astype(np.float64))[1].astype(np.uint64) - U(1)
            after[same] = (U(2) * bit + (own >> bit & U(1))).astype(np.uint8)
        label = after
    return label


def parse(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level for many texts at once, from bytes or 64-bit names: (names, first name of each text)."""
    n = len(symbols)
    if not n:
        return symbols.astype(np.uint64), first
    begin = np.empty(n, bool)
    begin[0] = True
    np.not_equal(symbols[1:], symbols[:-1], out=begin[1:])
    heads = first[:-1][np.diff(first) > 0]
    begin[heads] = True
    runs = np.flatnonzero(begin)
    single = len(runs) == n
    kept = symbols if single else symbols[runs]
    head = np.zeros(len(runs), bool)
    head[np.searchsorted(runs, heads)] = True
    values = BYTE_VALUE[kept] if kept.dtype == np.uint8 else kept
    if not single:
        length = np.diff(runs, append=n)
        long = np.flatnonzero(length > 1)
        values = values.copy()
        values[long] = mix(values[long] + length[long].astype(np.uint64))
    begin = head.copy()
    if len(runs) > 2:
        label = _labels(kept, head)
        begin[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:]) & ~head[2:]
    starts = np.flatnonzero(begin)
    place = np.arange(len(runs), dtype=np.int32)
    place -= np.repeat(starts.astype(np.int32), np.diff(starts, append=len(runs)))
    names = mix(np.add.reduceat(values * _OFFSETS[place % len(_OFFSETS)], starts))
    return names, np.searchsorted(runs[starts], first)


def sketches(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sketch of each text: its least 32-bit name hashes, rising."""
    symbols, first = data, offsets
    levels = []
    for level in range(1, max(LEVELS) + 1):
        symbols, first = parse(symbols, first)
        if level in LEVELS:
            levels.append(((mix(symbols + U(level)) >> U(32)).astype(np.uint32), first))
    return [np.unique(np.concatenate([names[at[i] : at[i + 1]] for names, at in levels]))[:SKETCH] for i in range(len(offsets) - 1)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SKETCH]
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _sketch_texts(texts: list[str]) -> list[np.ndarray]:
    return sketches(*utf8(pa.array(texts, pa.large_string()))) if texts else []


def fingerprint(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fingerprint."""

    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(to_text, sketches(*utf8(batch.column(1)))), pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


#: Whose rising order is that of falling ids, nulls last, then of the texts' hashes.
_KEYS = np.dtype([("none", np.uint64), ("id", np.uint64), ("hash", np.uint64)])


def _keys(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    out = np.empty(len(ids), _KEYS)
    signed = lambda x: x.astype(np.int64).view(np.uint64) ^ U(1 << 63)
    out["none"] = ids.is_null().to_numpy(zero_copy_only=False)
    out["id"] = signed(~ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    out["hash"] = signed(hashes.to_numpy(zero_copy_only=False))
    return out


def _place(starts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The range of each key: the last that begins at it or before."""
    every, index = np.unique(np.concatenate([starts, keys]), return_inverse=True)
    begins = np.zeros(len(every), np.int64)
    np.add.at(begins, index[: len(starts)], 1)
    return np.maximum(np.cumsum(begins)[index[len(starts) :]] - 1, 0)


def range_starts(docs: DataFrame, count: int) -> np.ndarray:
    """The least keys of count ranges of about as many rows each, in order; fewer, where rows are equal. The driver gets
    one key a range."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]

    def least(batches):
        best = None
        for batch in batches:
            if batch.num_rows:
                keys = _keys(batch.column(0), batch.column(1))
                first = keys[np.lexsort((keys["hash"], keys["id"], keys["none"]))[:1]]
                best = first if best is None else np.sort(np.concatenate([best, first]))[:1]
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(best[c].view(np.int64), pa.int64()) for c in _KEYS.names], list(_KEYS.names))

    found = docs.select("doc_id", "hash").repartitionByRange(count, *order).mapInArrow(least, "none long, id long, hash long").toArrow()
    out = np.empty(found.num_rows, _KEYS)
    for c in _KEYS.names:
        out[c] = found[c].to_numpy().view(np.uint64)
    return np.unique(out)


def _dealt(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, hash, text, sketch, range, guest: in the order of ranges, each of which ends with
    the first row of the next one, a guest; the last with that of the first."""
    spark = docs.sparkSession
    known = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    starts = range_starts(known, max(shuffle_width(spark), -(-size // RANGE_BYTES)))
    count = max(1, len(starts))
    shipped = spark.sparkContext.broadcast(starts)  # 24 bytes a range
    schema = "doc_id long, hash long, text string, sketch binary, range int, guest boolean"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        begin, sent = shipped.value, set()
        for batch in slices(batches):
            keys = _keys(batch.column(0), batch.column(1))
            place = _place(begin, keys)
            own = pa.array([x.astype(">u4").tobytes() for x in sketches(*utf8(batch.column(2)))], pa.binary())
            columns = [*batch.columns, own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(place, pa.int32()), pa.array(np.zeros(len(keys), bool))], names)
            guests = [i for i in np.flatnonzero(keys == begin[place]).tolist() if place[i] not in sent and not sent.add(place[i])]  # one of equal rows will do
            if guests:
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(guests)) for c in columns), pa.array((place[guests] - 1) % len(begin), pa.int32()), pa.array(np.ones(len(guests), bool))], names)

    return known.mapInArrow(run, schema).repartitionById(count, F.col("range")).sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "hash")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, and how near it is to its edited text's and to the next row's."""

    def run(batches):
        held: list[tuple] = []  # the row before this slice: range, guest, id, text, sketch
        for batch in slices(batches):
            ids, texts, own, place, guest = (batch.column(i).to_pylist() for i in range(5))
            rows = held + list(zip(place, guest, ids, texts, [np.frombuffer(x, ">u4").astype(np.uint32) for x in own]))
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
            edited = [edit(a[3], b[3]) for a, b in pairs]
            fresh = {t: i for i, t in enumerate(dict.fromkeys(edited))}  # equal neighbours have equal edits
            found = _sketch_texts(list(fresh))
            out = []
            for (a, b), e in zip(pairs, edited):
                s = found[fresh[e]]
                out.append((a[2], len(a[3]), hashlib.sha256(e.encode()).hexdigest(), to_text(a[4]), to_text(s), likeness(a[4], s), likeness(a[4], b[4])))
            held = rows[-1:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()))], [f.split()[0] for f in SCHEMA.split(", ")])

    return _dealt(docs).select("doc_id", "text", "sketch", "range", "guest").mapInArrow(run, SCHEMA)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(documents(spark, sf_dir, "doc_id", "text"))


QUERIES = {"op9_fingerprints": op9_fingerprints}
SQL: dict[str, str] = {}
