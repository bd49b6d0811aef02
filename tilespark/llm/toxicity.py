"""Toxicity by nearest labelled examples.

A bounded sample of labelled rows gives the examples: TF-IDF vectors over all their terms, each term weighted by the
strength of its link with the label besides (a power of 1 + chi-squared, so that no term's weight is 0). Every document
is compared with the examples by exact cosine, the norm taken over all its terms, through a block-max inverted index:
the largest weight of a term in a block bounds what the block can score, and blocks whose bound doesn't reach the worst
neighbour kept stay closed. Neighbours vote with their cosine; an isotonic curve, fitted on leave-one-out votes, turns
votes into rates; the nearest examples are kept as evidence.

Defined cases: null or empty text, and text without any known term, gets the toxic rate of examples without known
terms; ties between neighbours go to the example first in the index; without usable labels every score is 0; null ids
are not held out; repeated rows each get their row, and are learned from as one: a labelled id's least text; other
columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, give_back, materialise, slices
from .jaccard import near, shingle_sets
from .packed import bounds, ranges
from .text_arrays import U, mix

#: Labelled rows that the model is fitted on, by order of a hash of their id; everything else covers all rows.
MAX_LABELLED = 20_000
NEIGHBOURS = 25
#: Power of 1 + chi-squared in a term's weight: how far words that tell the label outweigh the rest of a long text.
STRENGTH = 1.5
BLOCK = 64
#: A term that stands in more than one of so many examples is searched for by dense blocks.
DENSE = 16
#: Vectors put into the index at once.
BUILT = 1024
#: Texts searched for at once.
TOGETHER = 128
#: Postings read at once.
POSTINGS = 1 << 18
PREDICT_AT = 0.3
EVIDENCE = 3
CACHED = 10_000
#: Slices of text after which a worker gives back what it has freed.
TURNS = 3
_WORDS = re.compile(r"\w+").findall


def tokens(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


def keys_of(terms) -> np.ndarray:
    """A 64-bit hash of each term; equality of hashes stands for that of terms."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def places_of(keys: np.ndarray, terms) -> np.ndarray:
    """Of each term, its place among the sorted keys; -1 if it isn't there."""
    if not len(keys):
        return np.full(len(terms), -1, np.int64)
    sought = keys_of(terms)
    place = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return np.where(keys[place] == sought, place, -1)


class BlockMaxIndex:
    """Exact top-k by cosine over sparse vectors {term: weight}; vectors are normalised here.

    Terms that stand in more than one of DENSE vectors are rows of dense blocks, with the largest weight of each in each
    block; the others have postings. What a block can score is bounded by its largest weights and what its postings
    scored. Blocks are opened for many queries at once, in single precision; what comes near the k-th is scored again.
    """

    def __init__(self, vectors: list[dict[int, float]], terms: int, block: int = BLOCK):
        n = np.array([len(v) for v in vectors], np.int64)
        flat = lambda of, kind: np.fromiter((x for v in vectors for x in of(v)), kind, int(n.sum()))
        weight = flat(dict.values, np.float64)
        self._build(n, flat(dict.keys, np.int64), lambda a, b: weight[a:b], terms, block)

    @classmethod
    def of(cls, n: np.ndarray, term: np.ndarray, weigh: Callable[[int, int], np.ndarray], terms: int, block: int = BLOCK) -> BlockMaxIndex:
        """From flat vectors; n: number of terms of each; weigh: the weights from one place to another."""
        out = cls.__new__(cls)
        out._build(n, term, weigh, terms, block)
        return out

    def _build(self, n: np.ndarray, term: np.ndarray, weigh: Callable[[int, int], np.ndarray], terms: int, block: int) -> None:
        """Some vectors at a time, into arrays of their final size."""
        self.block, self.size = block, len(n)
        begin = np.concatenate([[0], np.cumsum(n)])
        often = np.bincount(term, minlength=terms)
        head = np.flatnonzero(often * DENSE > self.size)
        self.place = np.full(terms, -1, np.int32)  # row of a dense term
        self.place[head] = np.arange(len(head), dtype=np.int32)
        often[head] = 0
        self.first = np.concatenate([[0], np.cumsum(often)])
        self.posted, self.posted_weight = np.empty(self.first[-1], np.int32), np.empty(self.first[-1])
        free = self.first[:-1].copy()  # where each term's next posting goes
        blocks = -(-self.size // block)
        self.dense = np.zeros((blocks, len(head), block), np.float32)
        own, own_weight, own_count = [np.zeros(0, np.int32)], [np.zeros(0)], [np.zeros(1, np.int64)]
        for a in range(0, self.size, BUILT):
            b = min(self.size, a + BUILT)
            owner = np.repeat(np.arange(a, b, dtype=np.int32), n[a:b])
            here, weight = term[begin[a] : begin[b]], weigh(int(begin[a]), int(begin[b]))
            weight = weight / np.repeat(np.sqrt(np.bincount(owner - a, weight * weight, b - a)), n[a:b])
            rows = self.place[here]
            dense = rows >= 0
            # dense terms vector by vector, and in blocks
            own.append(rows[dense]), own_weight.append(weight[dense]), own_count.append(np.bincount(owner[dense] - a, minlength=b - a))
            self.dense[owner[dense] // block, rows[dense], owner[dense] % block] = weight[dense]
            # the others by term
            here, owner, weight = here[~dense], owner[~dense], weight[~dense]
            order = np.argsort(here, kind="stable")
            here = here[order]
            cut = bounds(here)
            times = np.diff(cut)
            at = np.arange(len(here)) + np.repeat(free[here[cut[:-1]]] - cut[:-1], times)
            self.posted[at], self.posted_weight[at] = owner[order], weight[order]
            free[here[cut[:-1]]] += times
        self.own, self.own_weight, self.own_first = np.concatenate(own), np.concatenate(own_weight), np.cumsum(np.concatenate(own_count))
        self.most = np.ascontiguousarray(self.dense.max(2).T) if blocks else np.zeros((len(head), 0), np.float32)
        self.slack = 2e-7 * (len(head) + 8)  # of sums in single precision

    def search(self, vector: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example) of the k best above 0, by falling cosine, then by place in the index."""
        weight = np.array(list(vector.values()), np.float64)
        norm = np.sqrt((weight * weight).sum())
        return self.search_many([(np.array(list(vector), np.int64), weight / norm if norm else weight)], k, [without])[0]

    def search_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """search() of each (terms, weights over the norm)."""
        out: list[list[tuple[float, int]]] = []
        for a in range(0, len(queries), TOGETHER):
            out += self._search(queries[a : a + TOGETHER], k, without[a : a + TOGETHER] if without else [-1] * TOGETHER)
        return out

    def _search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> list[list[tuple[float, int]]]:
        if not self.size:
            return [[] for _ in queries]
        blocks, rows, block = self.dense.shape
        heads, rest = np.zeros((len(queries), rows)), np.zeros((len(queries), blocks * block))
        for i, (term, weight) in enumerate(queries):
            place = self.place[term]
            heads[i, place[place >= 0]] = weight[place >= 0]
            term, weight = term[place < 0], weight[place < 0]
            low = self.first[term]
            n = self.first[term + 1] - low
            ends = np.cumsum(n)
            cuts = np.searchsorted(ends, np.arange(POSTINGS, ends[-1] if len(ends) else 0, POSTINGS))
            for a, b in zip([0, *cuts], [*cuts, len(n)]):  # a long text has millions
                at = ranges(low[a:b], n[a:b])
                rest[i] += np.bincount(self.posted[at], self.posted_weight[at] * np.repeat(weight[a:b], n[a:b]), blocks * block)
            if without[i] >= 0:
                rest[i, without[i]] = -4.0  # below any that counts
        single = heads.astype(np.float32)
        scores = rest.reshape(len(queries), blocks, block).astype(np.float32)
        most = single @ self.most + scores.max(2)
        opened = np.zeros(most.shape, bool)

        def open_(need: np.ndarray) -> np.ndarray:
            """Open what is needed."""
            for b in np.flatnonzero(need.any(0)).tolist():
                who = np.flatnonzero(need[:, b])
                scores[who, b] += single[who] @ self.dense[b]
            opened[need] = True

        best = np.zeros(most.shape, bool)
        seeds = min(blocks, -(-k // block) + 1)
        seed = np.argpartition(-most, seeds - 1, 1)[:, :seeds]
        np.put_along_axis(best, seed, True, 1)
        open_(best)
        first = np.take_along_axis(scores, seed[:, :, None], 1).reshape(len(queries), -1)
        # the k-th best of the blocks opened first; that of all is no less
        least = np.partition(first, first.shape[1] - k, 1)[:, -k] if first.shape[1] > k else np.full(len(queries), -1.0, np.float32)
        open_((most >= (least - 2 * self.slack)[:, None]) & (most > 0) & ~opened)
        flat, out = scores.reshape(len(queries), -1), []  # scores of closed blocks lack what is dense, and so are too small
        for i in range(len(queries)):
            near = np.flatnonzero(flat[i] >= max(least[i] - 2 * self.slack, 1e-13))
            if len(near) > k:
                found = flat[i, near]
                near = near[found >= np.partition(found, len(found) - k)[-k] - 2 * self.slack]
            low = self.own_first[near]
            n = self.own_first[near + 1] - low
            at = ranges(low, n)
            dense = np.bincount(np.repeat(np.arange(len(near)), n), heads[i][self.own[at]] * self.own_weight[at], len(near))
            exact = np.round(rest[i, near] + dense, 12)
            order = np.lexsort((near, -exact))[:k]
            out.append([(s, j) for s, j in zip(exact[order].tolist(), near[order].tolist()) if s > 0])
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step curve nearest to y, by pooling neighbours that fall: (x, value) of its steps, each
    halfway between the values that it parts."""
    pools: list[list[float]] = []  # mean, weight, least x, largest x
    for v in np.unique(x):
        here = y[x == v]
        pools.append([float(here.mean()), float(len(here)), float(v), float(v)])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, w, _, last = pools.pop()
            p = pools[-1]
            p[0], p[1], p[3] = (p[0] * p[1] + m * w) / (p[1] + w), p[1] + w, last
    starts = [p[2] if not i else (pools[i - 1][3] + p[2]) / 2 for i, p in enumerate(pools)]
    return np.array(starts), np.array([p[0] for p in pools])


class Model:
    def __init__(self, keys: np.ndarray, clean: np.ndarray, toxic: np.ndarray, totals: tuple[int, int], examples: pa.Table):
        """keys: the terms' hashes, rising, with the clean and toxic examples that each stands in; examples: doc_id,
        toxic, t, n."""
        self.keys = keys
        rows, ever = sum(totals), clean + toxic
        self.strength = (1 + np.log((1 + rows) / (1 + ever))) * (1 + chi_squared(clean, toxic, *totals)) ** STRENGTH
        self.unseen = 1 + float(np.log(1 + rows))  # the same of a term that stands nowhere
        self.labels, self.ids = examples["toxic"].to_numpy().astype(float), examples["doc_id"].to_numpy()
        self.n = np.diff(np.concatenate([[0], np.cumsum(examples["t"].combine_chunks().value_lengths().to_numpy())])) if rows else np.zeros(0, np.int64)
        flat = lambda c: examples[c].combine_chunks().flatten().to_numpy().astype(np.int32) if rows else np.zeros(0, np.int32)
        self.term, self.count = flat("t"), flat("n")
        self.prior = float(self.labels.mean()) if rows else 0.0
        plain = self.labels[self.n == 0]
        self.plain = float((plain.sum() + self.prior) / (len(plain) + 1)) if rows else 0.0
        self.steps = (np.array([0.0]), np.array([self.prior]))
        self._order()

    def _order(self) -> None:
        """Examples without terms go; the others by their strongest common term, so that blocks hold what is alike."""
        first = np.concatenate([[0], np.cumsum(self.n)])
        keep = np.flatnonzero(self.n > 0)
        often = np.bincount(self.term, minlength=len(self.keys)) * DENSE > len(self.n)
        weight = np.where(often[self.term], self.weigh(self.term, self.count), 0.0)
        owner = np.repeat(np.arange(len(self.n)), self.n)
        order = np.lexsort((self.term, weight, owner))
        strongest = self.term[order[first[keep + 1] - 1]] if len(keep) else np.zeros(0, np.int32)
        keep = keep[np.lexsort((self.ids[keep], strongest))]
        at = ranges(first[keep], self.n[keep])
        self.term, self.count, self.n, self.labels, self.ids = self.term[at], self.count[at], self.n[keep], self.labels[keep], self.ids[keep]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "index"}

    def __getattr__(self, name: str):
        """The index is built where it is used."""
        if name != "index":
            raise AttributeError(name)
        self.index = BlockMaxIndex.of(self.n, self.term, lambda a, b: self.weigh(self.term[a:b], self.count[a:b]), len(self.keys))
        return self.index

    def only_search(self) -> None:
        """Build the index, and drop what only it and the calibration need."""
        if "index" not in self.__dict__:
            self.index  # noqa: B018
            self.term = self.count = None
            give_back()

    def weigh(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        out = np.log(count.astype(np.float64))
        out += 1
        out *= self.strength[term]
        return out

    def vector(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The known terms and their weights, over the norm of all terms."""
        counts = Counter(words)
        term = places_of(self.keys, counts.keys())
        count = np.array(list(counts.values()), np.int64)
        known = term >= 0
        weight = self.weigh(term[known], count[known])
        others = (1 + np.log(count[~known])) * self.unseen
        norm = np.sqrt((weight * weight).sum() + (others * others).sum())
        return term[known], weight / norm if norm else weight

    def votes_without_own(self, places: np.ndarray) -> np.ndarray:
        """What the other examples say of these."""
        first = np.concatenate([[0], np.cumsum(self.n)])
        queries = []
        for i in places.tolist():
            term = self.term[first[i] : first[i + 1]]
            weight = self.weigh(term, self.count[first[i] : first[i + 1]])
            queries.append((term, weight / np.sqrt((weight * weight).sum())))
        return np.array([self.vote(near) for near in self.index.search_many(queries, NEIGHBOURS, places.tolist())])

    def vote(self, near: list[tuple[float, int]]) -> float:
        weight = sum(c for c, _ in near)
        return float((sum(c * self.labels[i] for c, i in near) + self.prior) / (weight + 1))

    def verdict(self, near: list[tuple[float, int]]) -> tuple[float, list[tuple[int, float, int]]]:
        if not near:
            return self.plain, []
        value = self.steps[1][max(0, int(np.searchsorted(self.steps[0], self.vote(near) + 1e-12, "right")) - 1)]
        return min(1.0, max(0.0, float(value))), [(int(self.ids[i]), c, int(self.labels[i])) for c, i in near[:EVIDENCE]]


def chi_squared(clean: np.ndarray, toxic: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Of terms that stand in so many of n0 clean and n1 toxic rows."""
    a, b = toxic.astype(float), clean.astype(float)
    c, d = n1 - a, n0 - b
    return (n0 + n1) * (a * d - b * c) ** 2 / np.maximum(float(n0) * n1 * (a + b) * np.maximum(c + d, 1.0), 1.0)


class Scorer:
    """Texts -> (score, evidence) of each; equal texts are searched for once."""

    def __init__(self, model: Model):
        self.model, self.known, self.turn = model, {}, 0
        model.only_search()

    def __call__(self, texts: list[str | None]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        keys = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in texts]
        if len(self.known) >= CACHED:
            self.known.clear()
        self.turn += 1
        if self.turn % TURNS == 0:
            give_back()
        new = {k: t for k, t in zip(keys, texts) if k not in self.known}
        near = self.model.index.search_many([self.model.vector(tokens(t)) for t in new.values()], NEIGHBOURS)
        self.known.update(zip(new, map(self.model.verdict, near)))
        return [self.known[k] for k in keys]


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _sign(batches):
    """Rows with a hash of two min-hashes of their shingles: near copies nearly always share it."""
    for batch in slices(batches):
        flat, first = shingle_sets(batch.column(1))
        signs = np.zeros(batch.num_rows, np.uint64)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            least = [np.minimum.reduceat(h, first[:-1][full]) for h in (flat, mix(flat ^ U(0x6A09E667F3BCC909)))]
            signs[full] = mix(least[0] * U(3) + least[1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((signs >> U(1)).astype(np.int64), pa.int64())], ["doc_id", "text", "toxic", "sign"])


def _without_copies(table: pa.Table) -> pa.Table:
    """Rows of one label and sign (some of MAX_LABELLED): those that are near no row kept before, in the order of ids."""
    table = table.select(["doc_id", "text", "toxic"]).sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    flat, first = shingle_sets(table.column("text"))
    kept: list[tuple[int, np.ndarray]] = []
    for i, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
        own = flat[a:b]
        if not any(near(own, other) if len(own) or len(other) else True for _, other in kept):
            kept.append((i, own))
    return table.take(pa.array([i for i, _ in kept]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """docs (doc_id, text), labels (doc_id, toxic). Rows with crc32(doc_id) mod 4 = 2 are never learned from."""
    chosen = labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(MAX_LABELLED)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most MAX_LABELLED ids
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")  # an id's least text, should rows repeat it

    # copies, even near ones, would make their rare words look like signs of a label: one of each group is learned from
    signed = rows.mapInArrow(_sign, "doc_id long, text string, toxic int, sign long")
    rows = materialise(signed.groupBy("sign", "toxic").applyInArrow(_without_copies, "doc_id long, text string, toxic int"))

    def count(batches):
        for batch in slices(batches):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                seen[toxic > 0].update(set(tokens(text)))
            names = list(set(seen[0]) | set(seen[1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[0][t] for t in names], pa.int64()), pa.array([seen[1][t] for t in names], pa.int64())], ["term", "clean", "toxic"])

    n0, n1 = rows.agg(F.count_if(F.col("toxic") <= 0), F.count_if(F.col("toxic") > 0)).first()
    if not n0 or not n1:
        none = pa.table({"doc_id": pa.array([], pa.int64()), "toxic": pa.array([], pa.int32()), "t": pa.array([], pa.list_(pa.int32())), "n": pa.array([], pa.list_(pa.int32()))})
        return Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), (0, 0), none)
    terms = rows.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).mapInArrow(_hashed, "key long, clean long, toxic long").toArrow()  # the words of MAX_LABELLED texts
    keys = terms["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, clean, toxic = keys[order], terms["clean"].to_numpy()[order], terms["toxic"].to_numpy()[order]
    shipped = docs.sparkSession.sparkContext.broadcast(keys)  # as above

    def vectors(batches):
        for batch in slices(batches):
            found = [Counter(tokens(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int(y > 0) for y in batch.column(2).to_pylist()], pa.int32()), pa.array([places_of(shipped.value, f.keys()) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))], ["doc_id", "toxic", "t", "n"])

    examples = rows.mapInArrow(vectors, "doc_id long, toxic int, t array<int>, n array<int>").toArrow().sort_by([("doc_id", "ascending"), ("toxic", "descending")])
    shipped.destroy()
    model = Model(keys, clean, toxic, (n0, n1), examples)
    return calibrate(docs.sparkSession, model)


def _hashed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(keys_of(batch.column(0).to_pylist()).view(np.int64), pa.int64()), batch.column(1), batch.column(2)], ["key", "clean", "toxic"])


def calibrate(spark: SparkSession, model: Model) -> Model:
    """Fit the curve on what the other examples say of each."""
    shipped = spark.sparkContext.broadcast(model)  # at most MAX_LABELLED vectors

    def run(batches):
        for batch in batches:
            places = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shipped.value.votes_without_own(places), pa.float64())], ["id", "vote"])

    if len(model.n):
        votes = spark.range(len(model.n)).mapInArrow(run, "id long, vote double").toArrow()
        model.steps = isotonic(votes["vote"].to_numpy(), model.labels[votes["id"].to_numpy()])
    shipped.destroy()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with doc_id and text: doc_id, score, predicted, evidence (nearest examples: id, cosine, label)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LABELLED vectors
    near = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        scorer = Scorer(shipped.value)
        for batch in slices(batches):
            out = scorer(batch.column(1).to_pylist())
            values = [v for v, _ in out]
            found = [[{"doc_id": i, "cosine": c, "label": y} for i, c, y in e] for _, e in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64()), pa.array([int(v >= PREDICT_AT) for v in values], pa.int32()), pa.array(found, near)], ["doc_id", "score", "predicted", "evidence"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, evidence array<struct<doc_id:long,cosine:double,label:int>>")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """docs with a text column, without the rows that are predicted toxic."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # as in score()
    at = docs.columns.index("text")

    def run(batches):
        scorer = Scorer(shipped.value)
        for batch in slices(batches):
            yield batch.filter(pa.array([v < PREDICT_AT for v, _ in scorer(batch.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


QUERIES = {"op1_toxicity": op1_toxicity}
SQL: dict[str, str] = {}
