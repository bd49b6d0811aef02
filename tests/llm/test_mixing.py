import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilespark.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, target long"


def fair_targets(sizes):
    """Reshare the excess by weight until no source is above its cap; sizes: source -> size, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, left = {}, dict(sizes)
    total = sum(sizes.values())
    while left:
        share = (total - sum(full.values())) / sum(weight[s] for s in left)
        over = [s for s in left if share * weight[s] > 3 * sizes[s]]
        if not over:
            return full | {s: share * weight[s] for s in left}
        for s in over:
            full[s] = 3.0 * sizes[s]
            del left[s]
    return full


def run(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    sized = mixing.sizes(docs)
    return mixing.with_copies(sized, mixing.thresholds(sized)).collect()


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_takings(spark, seed):
    import random

    rng = random.Random(seed)
    sources = ["a", "B", "é", None, "hot"]
    rows = [(i, rng.choice([*sources, *["hot"] * 3]), " ".join(["w"] * rng.choice([0, 1, 5, 40])), "x", 7) for i in range(300)]
    rows += [(5, "a", "same id", "x", 1), (None, "a", "null id", "x", 1), (900, None, None, "x", 1), (901, "empty", "", "x", 1)]
    out = run(spark, rows)
    assert len(out) == len(rows)
    sizes = {}
    for _, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = fair_targets(sizes)
    taken = {}
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for s, n in taken.items():
        assert abs(n - want[s]) <= 42  # a document's size, and one id's second row


def test_empty_table(spark):
    assert run(spark, []) == []


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8))
@settings(max_examples=20, deadline=None)
def test_water_filling(spark, sizes):
    table = {f"s{i}": n for i, n in enumerate(sizes)}
    rows = spark.createDataFrame([(s, n, i % 3 + 1) for i, (s, n) in enumerate(table.items())], "source string, source_size long, weight int")
    got = {r.source: r.target for r in mixing.targets(rows).select("source", F.col("target")).collect()}
    assert got == pytest.approx(fair_targets(table))
    assert sum(got.values()) == pytest.approx(sum(sizes))


def test_repeated_rows_long_texts_and_clashing_names(spark):
    rows = [(i, f"s{i % 4}", "w " * 50, "x", 7) for i in range(400)] + [(5, "s1", "same row", "x", 1)] * 30 + [(900, "s2", "long " * 400_000, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit("mine")).withColumn("source_size", F.lit(-1))
    sized = mixing.sizes(docs)
    mixed = mixing.with_copies(docs, mixing.thresholds(sized))
    assert sorted(mixed.columns) == sorted([*docs.columns]) and mixed.count() == len(rows)
    out = mixed.collect()
    assert len({r.copies for r in out if r.doc_id == 5 and r.text == "same row"}) == 1  # taken together
    sizes = {}
    for _, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    assert all(r.source_size == sizes[r.source] and r.target == pytest.approx(fair_targets(sizes)[r.source]) and 0 <= r.copies <= 3 for r in out)
    again = {(r.doc_id, r.text[:9], r.copies) for r in mixing.with_copies(docs.repartition(3), mixing.thresholds(sized)).collect()}
    assert again == {(r.doc_id, r.text[:9], r.copies) for r in out}


def test_query_equals_its_sql(spark, tmp_path):
    rows = [(i, [f"s{i % 5}", None, "hot", "hot"][i % 4], " ".join(["w"] * (i * 7 % 60))) for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got, want = mixing.op10_mix_sources(spark, str(tmp_path)), con.sql(mixing.SQL["op10_mix_sources"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
