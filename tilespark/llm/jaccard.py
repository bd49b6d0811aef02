"""N-gram Jaccard join and its components: a size-aware heavy-light join over sets of word shingles.

Equal sets are one class from the start. A pair with a Jaccard index of at least 0.8 shares a shingle among the first
fifth of both sets, in any common order of shingles; two of them, for sets of two and more, in one more. So small sets
list all pairs of that prefix as keys (fixed-size subsets), and large sets list its single shingles (inverted lists);
sets just above the boundary list both. The boundary is where subsets become dearer than lists, whose mean length is
measured. The order puts shingles of many classes last: they are counted first, and a list is long only where classes
consist of common shingles.

With one shingle more in the prefix, a pair shares one list more. Larger sets list a tenth of their size more, and a
class with fewer shared lists than that has no partner: those that share a passage only are done with.

A list isn't expanded into pairs. The class of a list whose own lists are longest in sum is its hub, as the text that
near copies were made from would be. Each class is compared exactly with the hub that it shares most lists with, which
joins groups of near copies into components. Then only the pairs of a list that lie in different components are left;
all of them that share lists enough are compared, so no link between components is lost.

Defined cases: null text, and text without words, has an empty set and no links; under five words, the whole sequence is
the one shingle; rows of equal sets are one component whatever their number; a null id is no component's least id unless
all are null; an empty table gives an empty result; other columns are ignored. Shingles are 64-bit
hashes, of which lists and comparisons use 48 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, marked_slots, materialise, shuffle_width, slices, utf8
from .components import components
from .long_repeats import cells_of, part_of
from .packed import bounds, pack, rising, risen, unpack
from .text_arrays import U, Words, mix, powers, windows

GRAM = 5
#: Jaccard of at least 80 / 100.
SHARE, WHOLE = 80, 100
#: Common shingles are told to every worker, at most so many; the count from which one is common rises until they fit.
MAX_COMMON = 1 << 20
SLOTS = 1 << 20
LEAST_COMMON = 32
PART_ENTRIES = 1 << 20
#: Sets of a block, and requests that a task answers on it.
BLOCK_SETS = 4_000
BLOCK_REQUESTS = 4_000
#: Text whose classes are one bucket's, where what is known of classes meets.
BUCKET_BYTES = 64 << 20
#: Pairs of lists that a task holds before it packs them.
HELD_PAIRS = 1 << 21
_KEY_BITS = U(16)  # keys are the upper 48 bits: a clash only adds a candidate
#: From this size on, sets list their shingles one by one.
MAX_SMALL = 10


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, rising, in one array; and where each set begins."""
    words = Words(*utf8(column), lower=True)
    grams = windows(words.hashes, GRAM)
    sets, first = [], [0]
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= GRAM:
            s = np.sort(grams[a : b - GRAM + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            s = mix(np.add.reduce(words.hashes[a:b] * powers(b - a), keepdims=True) ^ U(0xD1B54A32D192ED03 + b - a))
        else:
            s = grams[:0]
        sets.append(s)
        first.append(first[-1] + len(s))
    return np.concatenate(sets) if sets else grams[:0], np.array(first)


def class_names(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 63-bit name of each set, 0 for the empty one."""
    size = np.diff(first)
    out = np.zeros(len(size), np.int64)
    full = np.flatnonzero(size)
    if len(full):
        total = np.add.reduceat(mix(flat ^ U(0x8CB92BA72F3D8DD7)), first[:-1][full])
        out[full] = (mix(total + size[full].astype(np.uint64)) >> U(1)).astype(np.int64)
    return out


def classes(docs: DataFrame) -> DataFrame:
    """A row a text: doc_id, text_hash, n_shingles, cls (null if empty)."""

    def run(batches):
        for batch in slices(batches):
            flat, first = shingle_sets(batch.column(2))
            names = class_names(flat, first)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(first), pa.int64()), pa.array(names, pa.int64(), mask=names == 0)], ["doc_id", "text_hash", "n_shingles", "cls"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, "doc_id long, text_hash long, n_shingles long, cls long")


def _distinct_sets(batch: pa.RecordBatch):
    """(class, its shingles) of a slice, each class once."""
    flat, first = shingle_sets(batch.column(0))
    names = class_names(flat, first)
    _, rows = np.unique(names, return_index=True)
    return [(names[i], flat[first[i] : first[i + 1]]) for i in rows if names[i]]


def _count_cells(parts: int, drop: np.uint64):
    def run(batches):
        for batch in slices(batches):
            keys = [s for _, s in _distinct_sets(batch)]
            if not keys:
                continue
            keys = np.concatenate(keys) >> drop
            names, cells = cells_of(part_of(keys, parts), keys, lambda i: pack(rising(keys[i])))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(cells, pa.binary())], ["part", "cell"])

    return run


def _common(least: int):
    def run(table: pa.Table) -> pa.Table:
        keys = np.sort(np.concatenate([risen(unpack(c)[0]) for c in table.column("cell").to_pylist()]))
        cut = bounds(keys)
        times = np.diff(cut)
        common = times > least
        # a last row says how many entries, and how many different ones, the part has
        key = np.append(keys[cut[:-1]][common], U(len(cut) - 1)).astype(np.int64)
        return pa.table({"key": key, "times": np.append(times[common], len(keys)), "common": np.append(np.ones(common.sum(), bool), False)})

    return run


def prefix_size(n: int, shared: int = 1) -> int:
    """The first so many of n shingles hold `shared` of those in common with any partner."""
    return n - -(-SHARE * n // WHOLE) + shared


def boundary(mean_list: float) -> int:
    """The least size from which listing pairs of the prefix costs more than scanning the lists of its shingles."""
    n = 2
    while math.comb(prefix_size(n, 2), 2) <= prefix_size(n) * mean_list and n < MAX_SMALL:
        n += 1
    return n


def shared_lists(n: int | np.ndarray) -> int | np.ndarray:
    """How many lists a set of n shares with a partner of its size or more, at least."""
    return 1 + n // MAX_SMALL


def keys_of(shingles: np.ndarray, common: np.ndarray, times: np.ndarray, small: int, drop: np.uint64) -> np.ndarray:
    """The keys that a set is listed under. common, times: the common shingles without their low bits, sorted, and their
    counts."""
    n = len(shingles)
    if n < 2:
        return shingles[:0]  # only an equal set is near enough, and that is the same class
    key = shingles >> _KEY_BITS
    want = prefix_size(n, max(2, shared_lists(n)))
    if len(common):
        counted = shingles >> drop
        place = np.minimum(np.searchsorted(common, counted), len(common) - 1)
        heavy = common[place] == counted
        light = key[~heavy][:want]
        if len(light) < want:
            rest = np.flatnonzero(heavy)
            order = np.lexsort((key[rest], times[place[rest]]))
            light = np.concatenate([light, key[rest][order][: want - len(light)]])
        key = light
    key = key[:want]
    singles, pairs = key[: prefix_size(n, shared_lists(n))], key[:0]
    if n * SHARE < small * WHOLE:  # small, or near enough to a small set
        key = key[: prefix_size(n, 2)]
        i, j = np.triu_indices(len(key), 1)
        low, high = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
        pairs = mix(low * U(0x9E3779B97F4A7C15) + high) >> _KEY_BITS
        if n < small:
            singles = key[:0]
    return np.unique(np.concatenate([singles, pairs]))


def _list_cells(parts: int, shipped, small: int, drop: np.uint64):
    def run(batches):
        common, times = shipped.value
        for batch in slices(batches):
            sets = _distinct_sets(batch)
            listed = [keys_of(s, common, times, small, drop) for _, s in sets]
            keys = np.concatenate(listed) if listed else np.zeros(0, np.uint64)
            if not len(keys):
                continue
            which = np.repeat(np.arange(len(sets)), [len(k) for k in listed])
            names, size = np.array([c for c, _ in sets]), np.array([len(s) for _, s in sets], np.int32)

            def cell(i):
                own, index = np.unique(which[i], return_inverse=True)  # sets stand in the order of their names
                return pack(rising(keys[i]), index.astype(np.uint16 if len(own) < 1 << 16 else np.uint32), rising(names[own]), size[own])

            dealt, cells = cells_of(part_of(keys, parts), keys, cell)
            yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), pa.array(cells, pa.binary())], ["part", "cell"])

    return run


def _by_class(names: np.ndarray, buckets: int, *columns: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Rows of classes, packed by buckets of the class."""
    return cells_of((names % buckets).astype(np.int32), names, lambda i: pack(rising(names[i]), *(c[i] for c in columns)))


def _lists(buckets: int):
    """A part's lists of two and more classes; and by bucket, how many each class has there, and their length in all."""

    def run(table: pa.Table) -> pa.Table:
        keys, names, size = [], [], []
        for cell in table.column("cell").to_pylist():
            k, index, name, n = unpack(cell)
            keys.append(risen(k)), names.append(risen(name)[index]), size.append(n[index])
        keys, names, size = (np.concatenate(x) for x in (keys, names, size))
        order = np.lexsort((names, keys))
        keys, names, size = keys[order], names[order], size[order]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])])
        keys, names, size = keys[fresh], names[fresh], size[fresh]
        length = np.diff(bounds(keys))
        keep = np.repeat(length, length) > 1
        names, size, length = names[keep], size[keep], length[length > 1]
        own, first, index = np.unique(names, return_index=True, return_inverse=True)
        total = np.bincount(index, weights=np.repeat(length, length), minlength=len(own)).astype(np.int64)
        told, cells = _by_class(own, buckets, np.bincount(index, minlength=len(own)).astype(np.int32), total, size[first])
        part = table.column("part")[0].as_py()
        whole = [pack(length.astype(np.uint32), index.astype(np.uint32), rising(own), size[first])] if len(own) else []
        return pa.table({"part": pa.array([part] * len(whole) + [None] * len(told), pa.int32()), "bucket": pa.array([None] * len(whole) + told, pa.int32()), "cell": pa.array(whole + cells, pa.binary())})

    return run


def _class_totals(table: pa.Table) -> pa.Table:
    """A bucket's classes that can have a partner: cls, weight (the length of their lists in all)."""
    cells = [unpack(c) for c in table.column("cell").to_pylist()]
    names, lists, total, size = (np.concatenate(x) for x in zip(*((risen(c[0]), *c[1:]) for c in cells)))
    own, first, index = np.unique(names, return_index=True, return_inverse=True)
    # a partner may have four fifths of a class's size, and then shares a fifth fewer lists
    alive = np.bincount(index, weights=lists) >= shared_lists(-(-size[first].astype(np.int64) * SHARE // WHOLE))
    return pa.table({"cls": pa.array(own[alive], pa.int64()), "weight": pa.array(np.bincount(index, weights=total).astype(np.int64)[alive], pa.int64())})


def _ask(buckets: int):
    """Which classes a part has, by bucket of the class."""

    def run(batches):
        for batch in batches:
            for part, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                told, cells = _by_class(risen(unpack(cell)[2]), buckets)
                yield pa.RecordBatch.from_arrays([pa.array(told, pa.int32()), pa.array([part] * len(told), pa.int32()), pa.array(cells, pa.binary())], ["bucket", "part", "cell"])

    return run


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """To each part, the values of those of its classes that have one."""
    node, value = (known.column(c).to_numpy() for c in ("cls", "value"))
    order = np.argsort(node)
    node, value = node[order], value[order]
    parts, cells = [], []
    for part, cell in zip(asked.column("part").to_pylist(), asked.column("cell").to_pylist()):
        at = np.flatnonzero(np.isin(node, risen(unpack(cell)[0])))
        if len(at):
            parts.append(part), cells.append(pack(rising(node[at]), value[at]))
    return pa.table({"part": pa.array(parts, pa.int32()), "told": pa.array(cells, pa.binary())})


def _told_lists(lists: DataFrame, known: DataFrame, buckets: int, work, schema: str) -> DataFrame:
    """work on each part's lists, and on the values (cls, value) of its classes."""
    asked = lists.mapInArrow(_ask(buckets), "bucket int, part int, cell binary")
    known = known.withColumn("bucket", F.pmod("cls", F.lit(buckets)).cast("int"))
    told = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_answer, "part int, told binary")
    return lists.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(work, schema)


def _known_members(listed: pa.Table, told: pa.Table):
    """Of each cell of a part: its lists, reduced to the classes that have a value, and of two classes at least.

    Gives (where each list begins, members as indexes, classes, sizes, a value for each member).
    """
    cells = [unpack(c) for c in told.column("told").to_pylist()]
    if not cells:
        return
    node, value = (np.concatenate(x) for x in zip(*((risen(n), v) for n, v in cells)))
    order = np.argsort(node)
    node, value = node[order], value[order]
    for cell in listed.column("cell").to_pylist():
        length, index, own, size = unpack(cell)
        own = risen(own)
        place = np.minimum(np.searchsorted(node, own), len(node) - 1)
        alive = (node[place] == own)[index]
        of = np.repeat(np.arange(len(length)), length)[alive]
        index = index[alive]
        count = np.diff(bounds(of))
        keep = np.repeat(count, count) > 1
        index, count = index[keep], count[count > 1]
        if len(count):
            yield np.concatenate([[0], np.cumsum(count)]), index, own, size, value[place][index]


def _stars(buckets: int):
    """By bucket of the class: (class, hub, lists of that hub which the class is in)."""

    def run(listed: pa.Table, told: pa.Table) -> pa.Table:
        names, cells = [], []
        for begin, index, own, _, weight in _known_members(listed, told):
            of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
            order = np.lexsort((index, -weight, of))
            hub = np.repeat(index[order][begin[:-1]], np.diff(begin))
            pair = index[order].astype(np.int64) * len(own) + hub
            pair, times = np.unique(pair[index[order] != hub], return_counts=True)
            told_, cells_ = _by_class(own[pair // len(own)], buckets, own[pair % len(own)], times.astype(np.int32))
            names += told_
            cells += cells_
        return pa.table({"bucket": pa.array(names, pa.int32()), "cell": pa.array(cells, pa.binary())})

    return run


def _best_hub(blocks: int):
    def run(table: pa.Table) -> pa.Table:
        u, v, times = (np.concatenate(x) for x in zip(*((risen(u), v, t) for u, v, t in (unpack(c) for c in table.column("cell").to_pylist()))))
        u, v, times = _summed(u, v, times)
        order = np.lexsort((v, -times, u))
        first = order[bounds(u[order])[:-1]]
        return _requests(u[first], v[first], blocks)

    return run


def _requests(u: np.ndarray, v: np.ndarray, blocks: int) -> pa.Table:
    """Pairs to compare, a row for each u and block of classes v."""
    block = v % blocks
    order = np.lexsort((v, block, u))
    u, v, block = u[order], v[order], block[order]
    first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (block[1:] != block[:-1])])) if len(u) else np.zeros(0, np.int64)
    cells = [pack(rising(v[a:b])) for a, b in zip(first, np.append(first[1:], len(u)))]
    return pa.table({"block": pa.array(block[first], pa.int32()), "u": pa.array(u[first], pa.int64()), "cell": pa.array(cells, pa.binary())})


def _summed(u: np.ndarray, v: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((v, u))
    u, v, times = u[order], v[order], times[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])) if len(u) else np.zeros(0, np.int64)
    return u[first], v[first], np.add.reduceat(times, first) if len(first) else times


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (cls, doc_id): each class's shingles, from one of its texts.

    A bitmap of SLOTS bits over hashes of the wanted ids spares most other texts; it never exceeds that, and where it
    is full, all texts are read and the join decides. Only sets are dealt, not texts.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    shipped = docs.sparkSession.sparkContext.broadcast(np.packbits(marked_slots(wanted.select(slot.alias("slot")), SLOTS)))

    def run(batches):
        mark = np.unpackbits(shipped.value).astype(bool)
        for batch in batches:
            for part in slices(iter([batch.filter(pa.array(mark[batch.column(0).to_numpy()]))])):
                flat, first = shingle_sets(part.column(2))
                names = class_names(flat, first)
                packed = [pack(rising(flat[a:b] >> _KEY_BITS)) for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), part.column(1), pa.array(packed, pa.binary())], ["cls", "doc_id", "shingles"])

    sets = docs.select(slot.alias("slot"), "doc_id", "text").mapInArrow(run, "cls long, doc_id long, shingles binary")
    keys = wanted.select("cls", F.col("doc_id").alias("_id")).hint("merge")
    return sets.join(keys, (sets["cls"] == keys["cls"]) & sets["doc_id"].eqNullSafe(keys["_id"])).select(sets["cls"], "shingles")


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Of two rising sets: is their Jaccard index at least SHARE / WHOLE?"""
    if min(len(a), len(b)) * WHOLE < max(len(a), len(b)) * SHARE:
        return False
    place = np.searchsorted(a, b)
    place[place == len(a)] = 0
    both = int((a[place] == b).sum()) if len(a) else 0
    return WHOLE * both >= SHARE * (len(a) + len(b) - both)


def _compare(requests: pa.Table, block: pa.Table) -> pa.Table:
    """Requests (u, cell, own) to a block of sets (cls, shingles) -> the pairs that are near enough."""
    at = {c: i for i, c in enumerate(block.column("cls").to_pylist())}
    sets: dict[int, np.ndarray] = {}
    packed, found = block.column("shingles"), []
    for u, cell, shingles in zip(*(requests.column(c).to_pylist() for c in ("u", "cell", "own"))):
        own = risen(unpack(shingles)[0])
        for v in risen(unpack(cell)[0]).tolist():
            if v not in sets:
                sets[v] = risen(unpack(packed[at[v]].as_py())[0])
            if near(own, sets[v]):
                found.append((u, v))
    return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("uv")})


def links(requests: DataFrame, sets: DataFrame, blocks: int) -> DataFrame:
    """The pairs (u, v) whose sets are near enough, compared in full: a request's set goes to each block of sets that it
    has partners in, so pairs are never rows. A block with many requests is answered in several tasks."""
    requests = materialise(requests)
    busy = requests.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_REQUESTS).cast("int").alias("salts")).filter("salts > 1")
    busy = materialise(busy.select(F.col("block").alias("_block"), "salts"))  # a row for BLOCK_REQUESTS requests at most
    salted = lambda rows: rows.join(busy, rows["block"] == busy["_block"], "left").withColumn("salts", F.coalesce("salts", F.lit(1))).drop("_block")
    # a merge at every size: what could be broadcast grows with the corpus
    left = salted(requests).hint("merge").join(sets.select(F.col("cls").alias("u"), F.col("shingles").alias("own")), "u").withColumn("salt", F.pmod(F.xxhash64("u"), F.col("salts")).cast("int")).drop("salts")
    right = salted(sets.withColumn("block", F.pmod("cls", F.lit(blocks)).cast("int"))).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return left.groupBy("block", "salt").cogroup(right.groupBy("block", "salt")).applyInArrow(_compare, "u long, v long")


def _crossing(buckets: int):
    """The pairs of a part's lists that lie in different components, by bucket: how many lists they share here, and
    must share in all."""

    def run(listed: pa.Table, told: pa.Table) -> pa.Table:
        names, cells = [], []
        for begin, index, own, size, home in _known_members(listed, told):
            mixed = np.minimum.reduceat(home, begin[:-1]) != np.maximum.reduceat(home, begin[:-1])
            found: list[np.ndarray] = []

            def tell() -> None:
                pair, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                found.clear()
                x, y = pair // len(own), pair % len(own)
                need = shared_lists(np.minimum(size[x], size[y]).astype(np.int64))
                told_, cells_ = _by_class(own[x], buckets, own[y], times.astype(np.int32), need.astype(np.int32))
                names.extend(told_)
                cells.extend(cells_)

            held = 0
            for a, b in zip(begin[:-1][mixed].tolist(), begin[1:][mixed].tolist()):
                member, where, n = index[a:b].astype(np.int64), home[a:b], b - a
                many = size[member].astype(np.int64)
                for low in range(0, n, 256):
                    part, own_size = slice(low, min(n, low + 256)), many[low : low + 256, None]
                    near_size = np.minimum(own_size, many) * WHOLE >= np.maximum(own_size, many) * SHARE
                    i, j = np.nonzero((where[part, None] != where) & near_size & (np.arange(low, part.stop)[:, None] < np.arange(n)))
                    x, y = member[i + low], member[j]
                    found.append(np.minimum(x, y) * len(own) + np.maximum(x, y))
                    held += len(x)
                    if held > HELD_PAIRS:
                        tell()
                        held = 0
            tell()
        return pa.table({"bucket": pa.array(names, pa.int32()), "cell": pa.array(cells, pa.binary())})

    return run


def _enough(blocks: int):
    """A bucket's pairs that share lists enough."""

    def run(table: pa.Table) -> pa.Table:
        u, v, times, need = (np.concatenate(x) for x in zip(*((risen(c[0]), *c[1:]) for c in (unpack(c) for c in table.column("cell").to_pylist()))))
        left = _summed(u, v, times)
        needed = _summed(u, v, need)[2] // _summed(u, v, np.ones(len(u), np.int64))[2]  # the same in each part
        keep = left[2] >= needed
        return _requests(left[0][keep], left[1][keep], blocks)

    return run


def _homes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, text) -> (what classes() gives, a row a class: cls, root, component_id)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    named = materialise(classes(docs))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_width(spark), math.ceil(size / 8 / PART_ENTRIES))
    # counted by six bits more than number them all: a clash only moves both shingles in the order
    drop = U(max(16, 64 - max(32, math.ceil(math.log2(size / 2 + 2)) + 6)))

    counted = docs.select("text").mapInArrow(_count_cells(parts, drop), "part int, cell binary").groupBy("part").applyInArrow(_common(LEAST_COMMON), "key long, times long, common boolean")
    counted = materialise(counted)
    entries, different = counted.filter("not common").agg(F.coalesce(F.sum("times"), F.lit(0)), F.coalesce(F.sum("key"), F.lit(0))).first()
    told = counted.filter("common").select("key", "times")
    steps = told.groupBy(F.floor(F.log2("times") * 4).alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()  # four for each doubling
    fitting, run = None, 0
    for r in steps:
        run += r.n
        if run > MAX_COMMON:
            break
        fitting = r.step
    told = told.filter(F.floor(F.log2("times") * 4) >= fitting) if fitting is not None else told.limit(0)
    told = told.orderBy("key").toPandas()  # MAX_COMMON rows at most
    shipped = sc.broadcast((told["key"].to_numpy(np.uint64), told["times"].to_numpy(np.int64)))
    small = boundary(entries / different if different else 1.0)

    buckets = max(shuffle_width(spark), math.ceil(size / BUCKET_BYTES))
    listed = docs.select("text").mapInArrow(_list_cells(parts, shipped, small, drop), "part int, cell binary").groupBy("part").applyInArrow(_lists(buckets), "part int, bucket int, cell binary")
    listed = materialise(listed)
    lists = listed.filter("part is not null").select("part", "cell")
    partners = listed.filter("bucket is not null").groupBy("bucket").applyInArrow(_class_totals, "cls long, weight long")
    owners = named.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    alive = materialise(partners.join(owners, "cls"))
    sets = materialise(_sets_of(docs, alive))
    hubs = _told_lists(lists, alive.select("cls", F.col("weight").alias("value")), buckets, _stars(buckets), "bucket int, cell binary")
    blocks = max(1, math.ceil(alive.count() / BLOCK_SETS))
    asked = "block int, u long, cell binary"
    edges = materialise(links(hubs.groupBy("bucket").applyInArrow(_best_hub(blocks), asked), sets, blocks))
    roots = components(edges)
    homes = alive.join(roots, alive["cls"] == roots["node"], "left").select("cls", F.coalesce("root", "cls").alias("value"))
    crossing = _told_lists(lists, homes, buckets, _crossing(buckets), "bucket int, cell binary")
    more = materialise(links(crossing.groupBy("bucket").applyInArrow(_enough(blocks), asked), sets, blocks))
    roots = components(edges.unionByName(more))
    home = owners.join(roots, owners["cls"] == roots["node"], "left").select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
    least_id = home.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named, home.join(least_id, "root").select("cls", "root", "component_id")


def link_components(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id."""
    named, home = _homes(docs)
    return named.join(home.drop("root"), "cls", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """docs with its columns: one row of each component, the one of the least id (null last), then of the least hash of
    its text, then of the least other columns. Rows without words are linked with nothing, and all stay."""
    named, home = _homes(docs)
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    chosen = named.join(home, "cls").groupBy("root", own.alias("r")).agg(F.count("*").alias("n"))
    chosen = chosen.groupBy("root").agg(F.min(F.struct("r", "n")).alias("best"))
    chosen = materialise(chosen.select(F.col("best.r.doc_id").alias("_id"), F.col("best.r.text_hash").alias("_hash"), F.col("best.n").alias("_n")))
    wordy = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    held = lambda some: docs.filter(wordy).join(some, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash")), "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    several = held(chosen.filter("_n > 1")).groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *rest)).alias("_rest"))
    several = several.select(*(F.col(f"_rest.`{c}`").alias(c) if c in rest else F.col(c) for c in docs.columns))
    return docs.filter(~wordy).unionByName(held(chosen.filter("_n = 1"))).unionByName(several)


def op8_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(documents(spark, sf_dir, "doc_id", "text"))


def brute(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """The same by comparing all pairs of sets of word tuples; tests compare with it."""
    import re

    sets: dict[int, frozenset] = {}
    for i, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets[i] = frozenset(tuple(words[k : k + GRAM]) for k in range(max(1, len(words) - GRAM + 1))) if words else frozenset()
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * WHOLE >= max(len(a), len(b)) * SHARE:
                both = len(a & b)
                if WHOLE * both >= SHARE * (len(a) + len(b) - both):
                    p, q = sorted((find(i), find(j)))
                    root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


QUERIES = {"op8_jaccard_components": op8_jaccard_components}
SQL = {
    "op8_jaccard_components": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM d),
f AS (SELECT doc_id, i, n, string_agg(word, ' ') OVER g AS sh, count(*) OVER g AS c FROM u WINDOW g AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
s AS (SELECT DISTINCT doc_id, md5_number(sh) AS sh FROM f WHERE c = 5 OR (n < 5 AND i = 0)),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id
"""
}
