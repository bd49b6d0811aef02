import random

import corpus_pipeline
import numpy as np

from tilespark.llm import bpe, jaccard, mixing, secret_scan


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(400):
        text = rng.choices(words, k=60)
        if i % 9 == 0:
            text += rng.sample(["vile", "scum", "loser"], 2)
        if i % 11 == 0:
            text += ["password=abcdefghijkl"]
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 0))
    rows += [(1000 + i, rows[i][1], "en", "s0", 0) for i in range(1, 60, 2)] + [(2000, None, "en", None, 0), (2001, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 9 == 0), 1) for i in range(400)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    tables = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        tables.append(docs)
        if k < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    clean, single, masked, mixed, encoded = (t.collect() for t in tables)
    assert {r.doc_id for r in clean} == {i for i, t, *_ in rows if not set((t or "").split()) & {"vile", "scum", "loser"}}
    want = jaccard.brute([(r.doc_id, r.text) for r in clean])
    assert {r.doc_id for r in single} == {i for i, (_, c) in want.items() if i == c}
    assert len(masked) == len(single)
    before = {r.doc_id: r.text for r in single}
    for r in masked:
        t = before[r.doc_id]
        assert r.text == (None if t is None else secret_scan.redact_text(t, [(a, b) for _, a, b in secret_scan.scan_text(t)]))
    sized = mixing.sizes(tables[2])
    copies = {r.doc_id: r.copies for r in mixing.with_copies(sized, mixing.thresholds(sized)).collect()}
    assert sorted(r.doc_id for r in mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    vocabulary = bpe.codec(*bpe.default_vocabulary())[0].transducer.bytes_of
    texts = {r.doc_id: r.text for r in mixed}
    for r in encoded:
        assert b"".join(vocabulary[i] for i in np.frombuffer(r.ids, "<u4").tolist()).decode() == (texts[r.doc_id] or "")
    assert sorted(r.doc_id for r in encoded) == sorted(r.doc_id for r in mixed)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(encoded)


ROW = "doc_id long, text string, lang string, source string, n_chars long"


def through(spark, tmp_path, rows, labels=((1, 0, 1),), schema=ROW):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(labels), "doc_id long, toxic int, quality int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    docs, out = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.mode("overwrite").parquet(str(tmp_path / f"odd{k}"))
        docs = spark.read.parquet(str(tmp_path / f"odd{k}"))
        out.append(docs)
    return out


def test_no_rows(spark, tmp_path):
    assert [t.count() for t in through(spark, tmp_path, [])] == [0] * 5


def test_one_row_of_each_group_stays(spark, tmp_path):
    text, near = " ".join(f"w{i}" for i in range(100)), " ".join([*(f"w{i}" for i in range(99)), "end"])
    other = " ".join(f"x{i}" for i in range(50))
    rows = [(9, text, "en", "s", 1), (7, text, "fr", "s", 1), (7, text, "en", "s", 1), (7, near, "en", "s", 1), (None, text, "en", "s", 1), (None, other, "en", "s", 1), (None, other, "en", "s", 1), (5, None, "en", "s", 0), (5, None, "en", "s", 0), (None, " \t", "en", "s", 2)]
    kept = [tuple(r)[:3] for r in through(spark, tmp_path, rows)[1].collect()]
    assert len(kept) == 5  # one of the seven, one of the two, and three without words
    linked = [r for r in kept if r[1] in (text, near)]
    assert len(linked) == 1 and linked[0][0] == 7
    assert sorted(r[0] or 0 for r in kept if r[1] == other or not (r[1] or "").split()) == [0, 0, 5, 5]


def test_long_texts_extra_columns_and_ties(spark, tmp_path):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(150_000))  # about a megabyte
    rows = [(i, t, "en", f"s{i % 2}", 0, 1, 2, 3) for i, t in enumerate([long, long[:-7] + " endings", "a b c", "a b c d e f", "é" * 200_000, "password=abcdefghijkl " * 3])]
    tables = through(spark, tmp_path, rows, schema=ROW + ", copies int, findings int, ids int")
    assert all(t.columns == list(corpus_pipeline.COLUMNS) for t in tables[:4])
    single, masked, encoded = (tables[k].collect() for k in (1, 2, 4))
    assert sorted(r.doc_id for r in single) == [0, 2, 3, 4, 5]
    assert all("password" not in r.text for r in masked)
    assert {r.doc_id for r in encoded} == {r.doc_id for r in tables[3].collect()}
