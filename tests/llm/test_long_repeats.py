import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from tilespark.llm import byte_dedup, long_repeats, word_dedup


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdéfg", k=rng.choice([1, 2, 3])))
    text = lambda n: [word() for _ in range(n)]
    passages = [text(n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(70):
        words = text(rng.choice([0, 3, 60, 120]))
        for _ in range(rng.choice([0, 1, 2])):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a:] if rng.random() < 0.4 else p
            words += text(rng.choice([0, 2, 30]))
        rows.append((i * 37 % 1009, " ".join(words), "x"))
    for i in range(12):  # near copies
        words = rows[i][1].split(" ")
        if len(words) > 10:
            words[rng.randrange(len(words))] = word()
        rows.append((2000 + i, " ".join(words), "x"))
    rows += [(3000, rows[0][1], "x"), (3001, None, "x"), (3002, "", "x"), (3003, "ab " * 400, "x"), (3004, "z" * 3000, "x"), (3005, "ab " * 2000, "x"), (3006, "q" * 99, "x"), (3007, "q" * 101, "x")]
    return rows


@pytest.mark.parametrize("module", [word_dedup, byte_dedup])
@pytest.mark.parametrize(("seed", "hot", "piece", "bucket"), [(0, 4096, 1 << 20, 3 << 20), (1, 4096, 256, 600), (2, 3, 1 << 20, 600), (3, 0, 300, 3 << 20)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, module, seed, hot, piece, bucket):
    """With few and many buckets, texts whole and in pieces, anchors in the index and not."""
    monkeypatch.setattr(long_repeats, "HOT", hot)
    monkeypatch.setattr(long_repeats, "PIECE_BYTES", piece)
    monkeypatch.setattr(long_repeats, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(long_repeats, "INDEX_SYMBOLS", 3000)
    rows = corpus(seed)
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, bucket string").repartition(4).write.parquet(path)
    query = next(iter(module.QUERIES.values()))
    got = {r[0]: tuple(r)[1:] for r in query(spark, str(tmp_path)).collect()}
    assert got == module.brute([(i, t) for i, t, _ in rows])


@pytest.mark.parametrize("module", [word_dedup, byte_dedup])
def test_empty_and_null_ids(spark, tmp_path, module):
    query = next(iter(module.QUERIES.values()))
    schema = "doc_id long, text string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "a/documents.parquet"))
    assert query(spark, str(tmp_path / "a")).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    spark.createDataFrame([(None, text), (5, text), (5, text)], schema).write.parquet(str(tmp_path / "b/documents.parquet"))
    out = query(spark, str(tmp_path / "b")).collect()
    assert sorted((r[0] is None, r[2] > 0) for r in out) == [(False, False), (False, False), (True, True)]


def broken_periods():
    """Texts of a pattern for over 100 bytes, a short break, and the pattern again."""
    rng = random.Random(11)
    out = []
    for i in range(300):
        letters = f"{i:03d}".translate(str.maketrans("0123456789", "abcdefghij"))  # no window is shared between texts
        period = letters + "".join(rng.choices("klmnopq", k=rng.randint(0, 12)))
        gap = letters.upper() + "".join(rng.choices("KLMNOPQ", k=rng.randint(1, 30)))
        out.append((period * 40)[: rng.randint(101, 260)] + gap + (period * 40)[: rng.randint(1, 120)])
    return out


def test_a_piece_that_repeats_within_itself_is_told():
    unit = long_repeats.BYTES
    for text in broken_periods():
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        _, hashes, first = unit.read(data, np.array([0, len(data)]))
        for _, at, n, times in zip(*long_repeats.anchors(unit, hashes, first)):
            if len({raw[i : i + unit.window] for i in range(at, at + n)}) < n:
                assert times == 2


def test_broken_periods_equal_brute_force(spark, tmp_path):
    rows = list(enumerate(broken_periods()))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r[0]: tuple(r)[1:] for r in byte_dedup.op4_byte_dedup(spark, str(tmp_path)).collect()}
    assert got == byte_dedup.brute(rows)


@pytest.mark.parametrize("module", [word_dedup, byte_dedup])
def test_query_equals_its_sql(spark, tmp_path, module):
    rows = [(i, t) for i, t, _ in corpus(5)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    (name, query), = module.QUERIES.items()
    got, want = query(spark, str(tmp_path)), con.sql(module.SQL[name])
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("unit", [long_repeats.BYTES, long_repeats.WORDS])
def test_a_very_long_text_takes_bounded_memory(unit):
    """All steps on one text of 20 MB, half of it a repeat of the other half."""
    rng = np.random.default_rng(0)
    half = " ".join(np.char.add("w", rng.integers(0, 1 << 30, 900_000).astype(str)).tolist())[: 10 << 20]
    docs = pa.table({"bucket": pa.array([0], pa.int32()), "doc_id": pa.array([1]), "text": pa.array([half + " " + half])})
    long_repeats.powers(1)
    tracemalloc.start()
    parts, pack = 64, lambda t: t.combine_chunks()
    cells = pa.Table.from_batches(list(long_repeats._emit_anchors(unit, parts)(docs.to_batches())))
    by = lambda t, column, k: pack(t.filter(pa.compute.equal(t.column(column), k)))
    told = pa.concat_tables([long_repeats._repeated(by(cells, "part", k)) for k in range(parts)])
    shipped = long_repeats._emit_snippets(unit, parts)(docs, told)
    repeats = pa.concat_tables([long_repeats._settle(unit)(by(shipped, "part", k)) for k in set(shipped.column("part").to_pylist())])
    finish = byte_dedup.finish if unit.places else word_dedup.finish
    out = long_repeats._unite(finish, ["doc_id", "n", "n_removed", "n_spans", "kept_sha256"] if unit.places else ["doc_id", "n", "n_removed", "kept_sha256"])(docs, repeats)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    removed = out.column("n_removed")[0].as_py()
    assert removed == len(half) if unit.places else removed == 0
    assert peak < 1 << 30
