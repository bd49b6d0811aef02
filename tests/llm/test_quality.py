import collections
import math
import random
import re

import numpy as np
import pytest

from tilespark.llm import quality
from tilespark.llm.text_arrays import U, mix
from tilespark.llm.toxicity import held_out


def test_kth_largest(spark):
    rng = random.Random(0)
    values = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(500)] + [5] * 20
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 100, 250, 500, 519, 520):
        value, left = quality.kth_largest(keys, k)
        assert value == ranked[k - 1] and left == k - sum(v > value for v in values)
    assert quality.kth_largest(keys, 521) is None and quality.kth_largest(keys, 0) is None


def test_bits_keep_the_order():
    values = np.array([-math.inf, -1e300, -2000.5, -1.0, -1e-300, 0.0, 1e-300, 1.0, 999.0, 1001.0, 1e300])
    assert (np.diff(quality.ordered_bits(values)) > 0).all()
    assert quality.ordered_bits(np.array([-0.0]))[0] == quality.ordered_bits(np.array([0.0]))[0]


def corpus(rng):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 80]))) if i % 5 else " ".join(w + "%%%" for w in rng.choices(words, k=80)), "x") for i in range(600)]
    rows += [(1000, None, "x"), (1001, "", "x"), (None, " ".join(words), "x"), (7, rows[7][1], "x"), (2000, "Word " * 100_000, "x"), (2001, " ".join(rng.choices(words, k=60_000)), "x")]
    return rows, [(i, int(i % 5 > 0)) for i in range(0, 600)]


def brute(rows, labels, chosen_from, seed):
    """Log weights and keys by plain counting of n-grams."""
    count = lambda texts: collections.Counter(g for t in texts for g in grams(t))

    def hashed(word):
        from tilespark.llm.text_arrays import Words

        raw = np.frombuffer(word.encode(), np.uint8)
        return Words(raw, np.array([0, len(raw)])).hashes[0]

    cache = {}

    def grams(text):
        words = [w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        for w in set(words) - set(cache):
            cache[w] = hashed(w)
        h = [cache[w] for w in words]
        out = [int(x % U(quality.BUCKETS)) for x in h]
        with np.errstate(over="ignore"):
            return out + [int(mix(np.array([a * U(3) + b]))[0] % U(quality.BUCKETS)) for a, b in zip(h, h[1:])]

    raw, target = count(t for _, t, _ in rows), count(t for i, t, _ in rows if i in chosen_from)
    p = lambda c, g: math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * quality.BUCKETS))
    ratio = {g: p(target, g) - p(raw, g) for g in raw}
    out = []
    for i, text, _ in rows:
        found = grams(text)
        if not found:
            out.append((i, None, None))
            continue
        weight = round(sum(ratio[g] for g in found), 9)
        noise = quality.gumbel(np.array([i or 0]), np.array([i is not None]), seed)[0]
        out.append((i, weight, weight + noise))
    return out


def test_weights_and_rows_equal_plain_counting(spark):
    rows, labels = corpus(random.Random(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    learned = {r.doc_id for r in table.filter(~held_out()).collect()}
    good = {i for i, q in labels if q and i in learned}
    want = brute(rows, labels, good, 7)
    k = round(len(good) / len(learned) * len(rows))
    best = sorted(want, key=lambda r: (r[2] is None, -(r[2] or 0), r[0] is None, r[0] or 0))[:k]
    got = quality.resample(docs, table).collect()
    assert len(got) == k and sorted(repr(r.doc_id) for r in got) == sorted(repr(r[0]) for r in best)
    by = {r[0]: r for r in want}
    for r in got:
        assert r.log_weight == pytest.approx(by[r.doc_id][1], abs=1e-5) and r.gumbel_key == pytest.approx(by[r.doc_id][2], abs=1e-5)
    assert max(abs(r.log_weight) for r in got) > 1000  # long texts keep their whole weight
    again = quality.resample(docs.repartition(3), table).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_junk_goes(spark):
    rows, labels = corpus(random.Random(2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    kept = {r.doc_id for r in quality.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    good = {i for i in range(600) if i % 5}
    assert len(kept & good) >= 0.98 * len(good) and len(kept & set(range(600)) - good) <= 10
    assert 1000 not in kept and 1001 not in kept


def test_ties_at_the_border(spark):
    keyed = spark.createDataFrame([(3, 1.0, 5), (1, 1.0, 5), (1, 1.0, 5), (None, 1.0, 5), (2, 2.0, 9), (4, 0.0, 1)], "doc_id long, w double, key long")
    ids = lambda k: sorted(r.doc_id if r.doc_id is not None else 99 for r in quality.keep_largest(keyed, k).collect())
    assert [ids(k) for k in range(8)] == [[], [2], [1, 2], [1, 1, 2], [1, 1, 2, 3], [1, 1, 2, 3, 99], [1, 1, 2, 3, 4, 99], [1, 1, 2, 3, 4, 99]]


def test_sampling_is_in_proportion_to_the_weights():
    """The largest key is each row's with the probability of its share of the weights; the two largest as drawn in turn."""
    weights = np.array([1.0, 2.0, 4.0, 8.0])
    ids, runs = np.arange(4), 20_000
    order = np.array([np.argsort(-(np.log(weights) + quality.gumbel(ids, np.ones(4, bool), seed))) for seed in range(runs)])
    share = weights / weights.sum()
    assert np.allclose(np.bincount(order[:, 0], minlength=4) / runs, share, atol=0.015)
    second = [sum(share[j] * share[i] / (1 - share[j]) for j in range(4) if j != i) for i in range(4)]
    assert np.allclose(np.bincount(order[:, 1], minlength=4) / runs, second, atol=0.015)


def test_no_labels_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.resample(docs, none).count() == 2
    assert quality.resample(docs.limit(0), none).count() == 0
