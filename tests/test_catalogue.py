"""Every query with SQL gives the rows that DuckDB gives for it."""

import math
import os

import duckdb
import pytest

from tilespark.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(norm(v[i]) for i in order) for v in values), key=repr)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, oracle, sf_dir, name):
    got = catalogue.QUERIES[name](spark, sf_dir)
    want = oracle.sql(catalogue.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_worklist_split_with_odd_ids(spark, tmp_path):
    """Rows without an id come last, as in the SQL; ids repeat and lie at both ends of their type."""
    ids = [None] * 7 + [4] * 9 + [-(2**63), 2**63 - 1, -5] + list(range(30))
    spark.createDataFrame([(i,) for i in ids], "doc_id long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("q05_worklist_split", "q06_split_counts"):
        got, want = catalogue.QUERIES[name](spark, str(tmp_path)), con.sql(catalogue.SQL[name])
        assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
