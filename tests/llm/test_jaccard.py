import random

import duckdb
import pytest

from tilespark.llm import jaccard
from tilespark.llm.components import components


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    passage = [word() for _ in range(30)]
    rows, i = [], 0

    def add(words):
        nonlocal i
        rows.append((i * 3 % 997, rng.choice([" ", "\n"]).join(words), "x"))
        i += 1

    for size in (1, 2, 3, 4, 5, 6, 7, 9, 12, 20, 40, 80, 150):
        base = [word() for _ in range(size)]
        for _ in range(8):
            edited = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                edited[rng.randrange(size)] = word()
            add(edited if rng.random() < 0.7 else [w.upper() for w in edited])
    for _ in range(60):
        add([word() for _ in range(20)] + passage + [word() for _ in range(rng.choice([0, 1, 20]))])
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, " \n ", "x"), (2003, "long " * 30_000, "x"), (2004, "long " * 20_000, "x")]
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("least", [2, 32])
def test_equals_brute_force(spark, monkeypatch, seed, least):
    monkeypatch.setattr(jaccard, "LEAST_COMMON", least)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(5)
    want = jaccard.brute([(i, t) for i, t, _ in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(docs).collect()} == want


def test_empty_null_and_repeated(spark):
    schema = "doc_id long, text string"
    assert jaccard.link_components(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "A B C D E F")]
    assert {(r.doc_id, r.component_id) for r in jaccard.link_components(spark.createDataFrame(rows, schema)).collect()} == {(None, 3), (7, 3), (3, 3)}


def test_prefix_holds_common_shingles():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(10, 200)
        a = set(rng.sample(range(10_000), n))
        b = set(a)
        for x in rng.sample(sorted(a), n // 12):
            b.discard(x)
            b.add(rng.randrange(10_000))
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        size = lambda s: jaccard.prefix_size(len(s), jaccard.shared_lists(len(s)))
        pa, pb = (set(sorted(s)[: size(s)]) for s in (a, b))
        assert len(pa & pb) >= min(jaccard.shared_lists(len(a)), jaccard.shared_lists(len(b)))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(300, 299), (299, 298)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {j: 100 for j in range(101, 130)} | {300: 298, 299: 298}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize(("requests", "bucket", "pairs"), [(4_000, 64 << 20, 1 << 21), (3, 2_000, 5)])
def test_many_blocks_buckets_and_salts(spark, monkeypatch, requests, bucket, pairs):
    """Hubs whose requests are split, many small buckets, pairs told in many cells; and rows kept of each component."""
    for name, value in (("BLOCK_SETS", 10), ("BLOCK_REQUESTS", requests), ("BUCKET_BYTES", bucket), ("HELD_PAIRS", pairs), ("LEAST_COMMON", 2)):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(5)
    want = jaccard.brute([(i, t) for i, t, _ in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(docs).collect()} == want
    assert sorted(r.doc_id for r in jaccard.representatives(docs).collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_query_equals_its_sql(spark, tmp_path):
    rows = [(i, t) for i, t, _ in corpus(4) if len(t or "") < 10_000]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got, want = jaccard.op8_jaccard_components(spark, str(tmp_path)), con.sql(jaccard.SQL["op8_jaccard_components"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
