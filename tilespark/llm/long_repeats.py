"""Finding every long window that also stands earlier in the corpus.

Windows are found through anchors: the least hash among the grams of a window is the same in equal windows. Three steps
share one partitioning of the texts, by buckets of a hash of the id:

1. anchors, counted over the corpus in packed cells, by ranges of the anchor; each bucket is told which of its anchors
   stand more than once;
2. each bucket ships a snippet for each such anchor: the symbols of the windows that chose it. Equal snippets of a
   bucket are shipped once, since all but the first are repeats. A shard holds all snippets of its anchors. It settles
   equal snippets by the least place, then builds an index over the different ones and streams them through it:
   matching statistics above the threshold, with earlier places only, are the repeats;
3. each bucket unites the intervals that it is told.

An anchor that stands more than HOT times isn't shipped as snippets to one shard: its windows are dealt by their own
hash, after each bucket has kept the least place of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, give_back, shuffle_width, utf8
from .packed import bounds, pack, ranges, rising, risen, unpack
from .text_arrays import BYTE_VALUE, SPACE, U, Words, inside, mix, powers, sliding_min, windows
from .text_index import RunIndex, WaveletIndex, earlier_matches

HOT = 4_096
#: Text read at once: its windows take some hundred bytes each. Longer texts are read in pieces.
PIECE_BYTES = 1 << 20
#: Text of a bucket; a longer text is a bucket's only one, mostly.
BUCKET_BYTES = 3 << 20
PART_ENTRIES = 1 << 17
INDEX_SYMBOLS = 1 << 19
_NONE = np.iinfo(np.int64).max  # a null id counts as the largest
_GRAIN = U(0xA24BAED4963EE407)
_GRAIN_INVERSE = U(pow(int(_GRAIN), -1, 2**64))


@dataclass(frozen=True)
class Unit:
    """What a window is made of. places: a place within the same text may be the earlier one."""

    window: int
    gram: int
    places: bool
    bytes_per_anchor: int
    index: type

    def pieces(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """A long text as (symbols, a hash of each, place of the first): every window is in one of the pieces."""
        if self.index is RunIndex:
            for at in range(0, len(data), PIECE_BYTES):
                part = data[at : at + PIECE_BYTES + self.window - 1]
                yield part, BYTE_VALUE[part], at
            return
        at, count, tail = 0, 0, np.zeros(0, np.uint64)
        while at < len(data):
            end = at + PIECE_BYTES
            while end < len(data):  # behind a word
                space = np.flatnonzero(SPACE[data[end : end + PIECE_BYTES]])
                if len(space):
                    end += int(space[0])
                    break
                end += PIECE_BYTES
            own = Words(data[at:end], np.array([0, min(end, len(data)) - at])).hashes
            hashes = np.concatenate([tail, own])
            yield (hashes >> U(32)).astype(np.uint32), hashes, count - len(tail)
            at, count, tail = end, count + len(own), hashes[len(hashes) - min(len(hashes), self.window - 1) :]

    def read_all(self, batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple]:
        """(batch, symbols, a hash of each, first symbol of each text, place of the first symbol in its text)."""
        for batch in cut(batches, text, PIECE_BYTES):
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            if batch.num_rows == 1 and len(data) > PIECE_BYTES:
                for symbols, hashes, at in self.pieces(data):
                    yield batch, symbols, hashes, np.array([0, len(symbols)]), at
            else:
                yield batch, *self.read(data, offsets), 0

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, a hash of each, first symbol of each text)."""
        if self.index is RunIndex:
            return data, BYTE_VALUE[data], offsets
        words = Words(data, offsets)
        return (words.hashes >> U(32)).astype(np.uint32), words.hashes, words.first


BYTES = Unit(100, 32, True, 35, RunIndex)
WORDS = Unit(50, 8, False, 130, WaveletIndex)


def anchors(unit: Unit, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows, times) of each run of windows with one anchor, no longer than a window.

    times: 2 if the run, or the piece of a longer one, may repeat within itself, else 1.
    """
    empty = np.zeros(0, np.int64)
    count = len(hashes) - unit.window + 1
    if count <= 0:
        return empty.astype(np.uint64), empty, empty, empty
    width = unit.window - unit.gram + 1
    grams = windows(hashes, unit.gram)
    least = sliding_min(grams, width)
    ok = np.flatnonzero(inside(first, unit.window, count))
    if not len(ok):
        return empty.astype(np.uint64), empty, empty, empty
    chosen = least[ok]
    new = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (ok[1:] != ok[:-1] + 1)])
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(ok))
    pieces = -(-length // width)  # a periodic text keeps one anchor for long
    run = np.repeat(np.arange(len(at)), pieces)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    piece = at[run] + nth * width
    key, begin, size = chosen[piece], ok[piece], np.minimum(width, length[run] - nth * width)
    times = np.ones(len(key), np.int64)
    if unit.places:
        # if a window stands twice in a piece, so does the gram with which the piece's last window begins: it starts in
        # both, as a piece is no longer than a window has grams
        same = grams[ok] == np.repeat(grams[begin + size - 1], size)
        times += np.add.reduceat(same.astype(np.int32), piece) > 1
    return key, begin, size, times


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Keys are often the least of many, and so are mixed before they are dealt."""
    return ((mix(keys) >> U(32)) * U(parts) >> U(32)).astype(np.int32)


def cells_of(part: np.ndarray, order_key: np.ndarray, make: Callable[[np.ndarray], bytes]) -> tuple[list[int], list[bytes]]:
    """Deal rows into cells, sorted by key within each."""
    order = np.lexsort((order_key, part))
    cut = bounds(part[order])
    return [int(part[order[a]]) for a in cut[:-1]] if len(part) else [], [make(order[a:b]) for a, b in zip(cut, cut[1:])] if len(part) else []


def _content(symbols_hash: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each stretch of symbols."""
    total = np.zeros(len(symbols_hash) + 1, np.uint64)
    np.cumsum(symbols_hash * powers(len(symbols_hash), _GRAIN), out=total[1:])
    inverse = powers(len(symbols_hash) + 1, _GRAIN_INVERSE)
    return mix((total[start + length] - total[start]) * inverse[start] + length.astype(np.uint64))


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


# ---- 1: anchors ------------------------------------------------------------------------------------------------------


def _emit_anchors(unit: Unit, parts: int):
    def run(batches):
        give_back()
        for batch, _, hashes, first, _ in unit.read_all(batches, "text"):
            key, at, _, often = anchors(unit, hashes, first)
            if not len(key):
                continue
            text = np.searchsorted(first, at, "right") - 1
            bucket = batch.column(0).to_numpy(zero_copy_only=False)[text].astype(np.uint32)
            order = np.lexsort((text, bucket, key))
            key, bucket, text, fresh = key[order], bucket[order], text[order], often[order]
            if not unit.places:  # an anchor counts once a text
                fresh[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            group = bounds((key ^ mix(bucket.astype(np.uint64) + U(1))))
            key, bucket, times = key[group[:-1]], bucket[group[:-1]], np.minimum(np.add.reduceat(fresh, group[:-1]), 65_535).astype(np.uint16)
            names, cells = cells_of(part_of(key, parts), key, lambda i: pack(rising(key[i]), bucket[i], times[i]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(cells, pa.binary())], ["part", "cell"])

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """All cells of a part -> for each bucket, its anchors that stand more than once, and whether they are hot."""
    keys, buckets, times = (np.concatenate(x) for x in zip(*((risen(k), b, t) for k, b, t in map(unpack, _column(table, "cell")))))
    order = np.argsort(keys)
    keys, buckets, times = keys[order], buckets[order], times[order]
    cut = bounds(keys)
    total = np.repeat(np.add.reduceat(times.astype(np.int64), cut[:-1]), np.diff(cut))
    keep = total > 1
    keys, buckets, hot = keys[keep], buckets[keep], (total[keep] > HOT)
    names, cells = cells_of(buckets, keys, lambda i: pack(rising(keys[i]), hot[i].astype(np.uint8)))
    return pa.table({"bucket": pa.array(names, pa.int32()), "told": pa.array(cells, pa.binary())})


# ---- 2: snippets -----------------------------------------------------------------------------------------------------
# kinds of cells: 0 snippets, 1 windows of hot anchors, 2 repeats already settled in the bucket


def _settled(bucket: int, ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    order = np.lexsort((start, ids))
    return pack(np.array([bucket], np.int64), rising(ids[order]), start[order].astype(np.int32), (end - start)[order].astype(np.int32))


def _least_of_groups(unit: Unit, group: list[np.ndarray], ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each row is of the least text (or place) in its group of equals."""
    order = np.lexsort((start, ids, *group))
    same = np.ones(len(order), bool)
    for g in group:
        same[1:] &= g[order][1:] == g[order][:-1]
    same[0] = False
    cut = np.flatnonzero(~same)
    first = np.repeat(cut, np.diff(cut, append=len(order)))
    least = ids[order] == ids[order][first]
    if unit.places:
        least &= start[order] == start[order][first]
    out = np.empty(len(order), bool)
    out[order] = least
    return out


def _emit_snippets(unit: Unit, parts: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        out: tuple[list[int], list[int], list[bytes]] = ([], [], [])
        cells = [unpack(c) for c in _column(told, "told")]
        if docs.num_rows and cells:
            keys = np.concatenate([risen(k) for k, _ in cells])
            hot = np.concatenate([h for _, h in cells]).astype(bool)
            order = np.argsort(keys)
            keys, hot = keys[order], hot[order]
            bucket = int(docs.column("bucket")[0].as_py())
            gathered = []
            for batch, symbols, hashes, first, base in unit.read_all(docs.to_batches(), "text"):
                key, at, n, often = anchors(unit, hashes, first)
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                keep = keys[place] == key
                key, at, n, often, warm = key[keep], at[keep], n[keep], often[keep], hot[place[keep]]
                text = np.searchsorted(first, at, "right") - 1
                ids = batch.column("doc_id").fill_null(_NONE).to_numpy(zero_copy_only=False)[text]
                start = at - first[text] + base
                span = n + unit.window - 1
                value = windows(hashes, unit.window)[ranges(at[warm], n[warm])] if warm.any() else None
                gathered.append((key, ids, start, span, warm, _content(hashes, at, span), at, symbols, value, n, often))
            settled = []
            many = lambda i: np.concatenate([g[i][~g[4]] for g in gathered])
            key, ids, start, span, content = (many(i) for i in (0, 1, 2, 3, 5))
            if len(key):
                source = np.concatenate([np.full((~g[4]).sum(), k) for k, g in enumerate(gathered)])
                at, often = many(6), many(10)
                least = _least_of_groups(unit, [content, key], ids, start)
                settled.append((ids[~least], start[~least], start[~least] + span[~least]))
                held = np.flatnonzero(least)
                part = part_of(key[held], parts)

                def ship(i):
                    i = held[i]
                    body = [gathered[source[j]][7][at[j] : at[j] + span[j]] for j in i]
                    names, which = np.unique(ids[i], return_inverse=True)
                    return pack(np.array([bucket], np.int64), rising(key[i]), rising(names), which.astype(np.uint32), start[i].astype(np.int32), span[i].astype(np.uint16), often[i].astype(np.uint8), np.concatenate(body))

                names, cells = cells_of(part, key[held], ship)
                out[0].extend(names), out[1].extend([0] * len(names)), out[2].extend(cells)
            warm = [(g, np.flatnonzero(g[4])) for g in gathered if g[4].any()]
            if warm:
                value = np.concatenate([g[8] for g, _ in warm])
                ids = np.concatenate([np.repeat(g[1][i], g[9][i]) for g, i in warm])
                start = np.concatenate([ranges(g[2][i], g[9][i]) for g, i in warm])
                least = _least_of_groups(unit, [value], ids, start)
                settled.append((ids[~least], start[~least], start[~least] + unit.window))
                value, ids, start = value[least], ids[least], start[least]

                def deal(i):
                    names, which = np.unique(ids[i], return_inverse=True)
                    return pack(np.array([bucket], np.int64), rising(value[i]), rising(names), which.astype(np.uint32), start[i].astype(np.int32))

                names, cells = cells_of(part_of(value, parts), value, deal)
                out[0].extend(names), out[1].extend([1] * len(names)), out[2].extend(cells)
            if any(len(s[0]) for s in settled):
                out[0].append(bucket % parts), out[1].append(2)
                out[2].append(_settled(bucket, *(np.concatenate(x) for x in zip(*settled))))
        return pa.table({"part": pa.array(out[0], pa.int32()), "kind": pa.array(out[1], pa.int32()), "cell": pa.array(out[2], pa.binary())})

    return run


def _shard_matches(unit: Unit, key: np.ndarray, ids: np.ndarray, start: np.ndarray, span: np.ndarray, often: np.ndarray, offset: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different snippets, sorted by anchor -> (snippet, begin, end) of what stands at an earlier place.

    The first snippet of an anchor is in the index only: nothing with that anchor is earlier, unless within itself.
    """
    flat = symbols[ranges(offset, span)]
    if unit.index is RunIndex:
        text, count = flat.astype(np.uint8) + np.uint8(1), 256  # UTF-8 has no byte 255
    else:
        names, flat = np.unique(flat, return_inverse=True)
        text, count = flat + 1, len(names)
    n = len(span)
    at = np.concatenate([[0], np.cumsum(span + 1)[:-1]])  # a separator behind each
    whole = np.zeros(int(span.sum()) + n, text.dtype)
    whole[ranges(at, span)] = text
    owner = np.repeat(np.arange(n), span + 1)
    place = np.arange(len(whole)) - at[owner] + start[owner]
    if unit.places:
        order = np.lexsort((place, ids[owner]))
        same = np.concatenate([[False], (place[order][1:] == place[order][:-1]) & (ids[owner][order][1:] == ids[owner][order][:-1])])
        keys = np.empty(len(whole), np.int32)
        keys[order] = np.cumsum(~same)
    else:
        keys = np.unique(ids, return_inverse=True)[1].astype(np.int32)[owner]
    stream = np.flatnonzero(~_least_of_groups(unit, [key], ids, start) | (often > 1))
    which, begin, end = earlier_matches(unit.index, whole, count, keys, keys, at[stream], span[stream], unit.window)
    return stream[which], begin, end


def _settle(unit: Unit):
    def run(table: pa.Table) -> pa.Table:
        told: list[tuple[np.ndarray, ...]] = []  # bucket, id, start, end
        kinds = np.array(_column(table, "kind"), np.int32)
        cells = table.column("cell")
        snippets, hot = [], []
        for i in range(table.num_rows):
            cell = unpack(cells[i].as_py())
            if kinds[i] == 2:
                told.append((np.full(len(cell[1]), cell[0][0]), risen(cell[1]), cell[2].astype(np.int64), cell[2].astype(np.int64) + cell[3]))
            elif kinds[i] == 1:
                hot.append((np.full(len(cell[1]), cell[0][0]), risen(cell[1]), risen(cell[2])[cell[3]], cell[4].astype(np.int64)))
            else:
                snippets.append((np.full(len(cell[1]), cell[0][0]), risen(cell[1]), risen(cell[2])[cell[3]], cell[4].astype(np.int64), cell[5].astype(np.int64), cell[6], cell[7]))
        if hot:
            bucket, value, ids, start = (np.concatenate(x) for x in zip(*hot))
            late = ~_least_of_groups(unit, [value], ids, start)
            told.append((bucket[late], ids[late], start[late], start[late] + unit.window))
        if snippets:
            bucket, key, ids, start, span, often, symbols = (np.concatenate(x) for x in zip(*snippets))
            offset = np.cumsum(span) - span
            content = _content(BYTE_VALUE[symbols] if unit.index is RunIndex else mix(symbols.astype(np.uint64)), offset, span)
            least = _least_of_groups(unit, [content, key], ids, start)
            told.append((bucket[~least], ids[~least], start[~least], start[~least] + span[~least]))
            # equal snippets of the least text share one entry in the index, and its matches
            order = np.flatnonzero(least)
            order = order[np.lexsort((content[order], key[order]))]
            one = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])])
            distinct, member = order[one], np.cumsum(one) - 1
            variants = np.diff(bounds(key[distinct]))
            pick = np.flatnonzero((np.repeat(variants, variants) > 1) | (often[distinct] > 1))  # else nothing to match
            at = 0
            while at < len(pick):
                size = np.cumsum(span[distinct[pick[at:]]] + 1)
                end = at + max(1, int(np.searchsorted(size, INDEX_SYMBOLS, "right")))
                while end < len(pick) and key[distinct[pick[end]]] == key[distinct[pick[end - 1]]]:
                    end += 1  # an anchor's snippets stay together
                chosen = distinct[pick[at:end]]
                which, begin, stop = _shard_matches(unit, key[chosen], ids[chosen], start[chosen], span[chosen], often[chosen], offset[chosen], symbols)
                which = pick[at:end][which]  # of distinct
                low = np.searchsorted(member, which)
                times = np.searchsorted(member, which, "right") - low
                rows = order[ranges(low, times)]
                told.append((bucket[rows], ids[rows], start[rows] + np.repeat(begin, times), start[rows] + np.repeat(stop, times)))
                at = end
        if not told:
            return pa.table({"bucket": pa.array([], pa.int32()), "repeats": pa.array([], pa.binary())})
        bucket, ids, start, end = (np.concatenate(x) for x in zip(*told))
        names, out = cells_of(bucket, ids, lambda i: pack(*_joined(ids[i], start[i], end[i])))
        return pa.table({"bucket": pa.array(names, pa.int32()), "repeats": pa.array(out, pa.binary())})

    return run


def _joined(ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping intervals of one text united: (rising ids, start, length)."""
    order = np.lexsort((end, start, ids))
    ids, start, end = ids[order], start[order], end[order]
    text = np.cumsum(np.concatenate([[0], ids[1:] != ids[:-1]])).astype(np.int64)
    reach = np.maximum.accumulate(end + text * (1 << 40)) - text * (1 << 40)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (start[1:] > reach[:-1])
    cut = np.flatnonzero(new)
    last = np.append(cut[1:], len(ids)) - 1
    return rising(ids[cut]), start[cut].astype(np.int32), (reach[last] - start[cut]).astype(np.int32)


# ---- 3: uniting ------------------------------------------------------------------------------------------------------


def _unite(finish: Callable, names: list[str]):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        cells = [unpack(c) for c in _column(told, "repeats")]
        ids = np.concatenate([risen(c[0]) for c in cells]) if cells else np.zeros(0, np.int64)
        start = np.concatenate([c[1] for c in cells]).astype(np.int64) if cells else ids
        end = start + (np.concatenate([c[2] for c in cells]) if cells else ids)
        order = np.argsort(ids, kind="stable")
        ids, start, end = ids[order], start[order], end[order]
        rows = []
        for doc, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
            own = _NONE if doc is None else doc
            a, b = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
            rows.append((doc, *finish(text or "", start[a:b], end[a:b])))
        columns = zip(*rows) if rows else [[]] * len(names)
        kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def united(count: int, start: np.ndarray, end: np.ndarray) -> tuple[list[int], list[int]]:
    """The maximal runs of places, of count, that lie in an interval: where they start and end."""
    start, end = np.minimum(start, count), np.minimum(end, count)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new].tolist(), reach[np.append(np.flatnonzero(new)[1:], len(new)) - 1].tolist()


def left_over(count: int, starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """What lies between the runs."""
    return list(zip([0, *ends], [*starts, count]))


def find_repeats(unit: Unit, docs: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """docs (doc_id, text) -> one row a text: finish(text, starts, ends of its repeats)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-size // BUCKET_BYTES))
    parts = max(shuffle_width(spark), -(-size // (unit.bytes_per_anchor * PART_ENTRIES)))
    known = docs.select(F.pmod(F.xxhash64(F.coalesce("doc_id", F.crc32("text"))), F.lit(buckets)).cast("int").alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    told = known.mapInArrow(_emit_anchors(unit, parts), "part int, cell binary").groupBy("part").applyInArrow(_repeated, "bucket int, told binary")
    by_bucket = known.groupBy("bucket")
    shipped = by_bucket.cogroup(told.groupBy("bucket")).applyInArrow(_emit_snippets(unit, parts), "part int, kind int, cell binary")
    repeats = shipped.groupBy("part").applyInArrow(_settle(unit), "bucket int, repeats binary")
    names = [f.split()[0] for f in schema.split(", ")]
    return by_bucket.cogroup(repeats.groupBy("bucket")).applyInArrow(_unite(finish, names), schema)
