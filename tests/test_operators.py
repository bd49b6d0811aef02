import random
import warnings

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilespark.functions import color, paths, resolution
from tilespark.operators import classify, encoder, exclusion, masks, matching, quality, sampling, scatter, tiling, tracking
from tilespark.plans import slide_pipeline


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("out")).first().out


@pytest.mark.parametrize(("path", "stem", "shell", "ext"), [("/a/b.svs", "b", "b", ".svs"), ("b.svs.bak", "b.svs", "b.svs", ".bak"), ("/x/.hidden", ".hidden", "", ""), ("plain", "plain", "plain", ""), ("/d/e.f/g", "g", "g", "")])
def test_names(spark, path, stem, shell, ext):
    p = F.col("p")
    assert one(spark, paths.stem(p), p=path) == stem
    assert one(spark, paths.shell_stem(p), p=path) == shell
    assert one(spark, paths.extension(p), p=path) == ext


def test_every_mark_goes(spark):
    assert one(spark, paths.result_name(F.col("p"), "_vec"), p="a_vec_b_vec") == "a_b"


@pytest.mark.parametrize(("value", "label", "size"), [(None, None, 512), (0.0, None, 1024), (0.25, "40x", 1024), (0.5, "20x", 512), (0.2, "60x", 1024), (0.38, "25x", 512), (1.0, "~10x", 512), (0.3, "~33x", 1024)])
def test_magnification_and_size(spark, value, label, size):
    m = F.col("m").cast("double")
    assert one(spark, resolution.magnification(m), m=value) == label
    assert one(spark, resolution.patch_size(m), m=value) == size


def test_scaling_rounds_up(spark):
    assert one(spark, resolution.scaled_size(F.lit(512), F.col("m"), 0.5), m=0.2631) == 974
    assert one(spark, resolution.scaled_size(F.lit(512), F.col("m"), 0.5), m=0.25) == 1024
    assert one(spark, resolution.scaled_size(F.lit(512), F.col("m").cast("double"), 0.5), m=None) == 512


@pytest.mark.parametrize(("w", "tiles", "exclusive"), [(9, 0, 0), (10, 1, 0), (11, 1, 1), (20, 2, 1), (30, 3, 2), (0, 0, 0)])
def test_grid_edges(spark, w, tiles, exclusive):
    slides = spark.createDataFrame([(w, 10)], "w long, h long")
    assert tiling.grid(slides, F.lit(10)).count() == tiles
    wide = spark.createDataFrame([(w, 11)], "w long, h long")
    assert tiling.grid(wide, F.lit(10), exclusive=True).count() == exclusive


def test_level_choice(spark):
    levels = "array(struct(1D as downsample), struct(4D as downsample), struct(16D as downsample))"
    for want, level in ((16, 2), (15, 1), (1, 0), (0.5, 0)):
        assert spark.range(1).select(tiling.best_level(F.expr(levels), want).alias("l")).first().l == level


def test_exclusion_language():
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert exclusion.parse("x:>:1000,Y:<:500,bad,x:!:3,x:<:q, x:<:2") == [("x", ">", 1000), ("y", "<", 500), ("x", "<", 2)]
        assert len(told) == 3
    assert exclusion.parse("") == exclusion.parse(None) == []


@given(st.lists(st.tuples(st.sampled_from("xy"), st.sampled_from(sorted(exclusion.OPERATORS)), st.integers(0, 9)), min_size=1, max_size=3))
@settings(max_examples=15, deadline=None)
def test_exclusion_modes(spark, terms):
    tiles = spark.createDataFrame([(x, y) for x in range(10) for y in range(10)], "x int, y int")
    hit = lambda x, y: [exclusion.OPERATORS[o]({"x": x, "y": y}[c], v) for c, o, v in terms]
    for mode, every in (("any", any), ("all", all)):
        got = {(r.x, r.y) for r in exclusion.exclude(tiles, ",".join(f"{c}:{o}:{v}" for c, o, v in terms), mode).collect()}
        assert got == {(x, y) for x in range(10) for y in range(10) if not every(hit(x, y))}
    assert exclusion.exclude(tiles, "z:<:1", "all").count() == 100


def numpy_cross(mask, choose, pad):
    p = np.pad(mask, 1, constant_values=pad)
    return choose.reduce([p[1:-1, 1:-1], p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]])


@pytest.mark.parametrize("kind", ["zero", "one", "checker", "random"])
def test_cleaning_and_region_means(spark, kind):
    rng = np.random.default_rng(0)
    shape = (13, 11)
    m = {"zero": np.zeros(shape, int), "one": np.ones(shape, int), "checker": np.indices(shape).sum(0) % 2, "random": (rng.random(shape) < 0.6).astype(int)}[kind]
    table = spark.createDataFrame([(1, y, x, int(m[y, x])) for y in range(13) for x in range(11)], "slide long, y long, x long, m int")
    want = m
    for choose, pad in ((np.minimum, 1), (np.maximum, 0), (np.maximum, 0), (np.minimum, 1)):
        want = numpy_cross(want, choose, pad)
    cleaned = masks.clean(table)
    got = np.zeros(shape, int)
    for r in cleaned.collect():
        got[r.y, r.x] = r.m
    assert (got == want).all()
    regions = spark.createDataFrame([(1, y, x) for y in range(9) for x in range(7)], "slide long, y long, x long")
    for size in (4, F.lit(4)):
        for r in masks.region_means(regions, table, size).collect():
            assert r.pct == pytest.approx(m[r.y : r.y + 4, r.x : r.x + 4].mean())


def test_strips_give_what_the_whole_gives(spark, monkeypatch):
    monkeypatch.setattr(masks, "STRIP", 3)
    rng = np.random.default_rng(1)
    m, there = (rng.random((20, 9)) < 0.6).astype(int), rng.random((20, 9)) < 0.95
    cells = [(s, y, x, int(m[y, x])) for s in (1, 2) for y in range(20) for x in range(9) if there[y, x]] + [(1, 30, 0, None)]
    table = spark.createDataFrame(cells, "slide long, y long, x long, m int")
    want = m
    for step in (masks.LEAST, masks.GREATEST, masks.GREATEST, masks.LEAST):
        want = masks.cross(want, there, step)
    got = masks.clean(table).collect()
    assert len(got) == len(cells) and all(r.m == (want[r.y, r.x] if r.y < 20 else None) for r in got)
    regions = spark.createDataFrame([(s, y, x, n) for s in (1, 2, 3) for y in (-2, 0, 2, 5, 17, 40) for x in (0, 4, 8) for n in (0, 1, 3, 8)], "slide long, y long, x long, n long")
    known = np.where(there, m, 0)
    for r in masks.region_means(regions, table, F.col("n")).collect():
        rows, columns = slice(max(0, r.y), max(0, r.y + r.n)), slice(r.x, r.x + r.n)
        if r.slide == 3 or not r.n or not there[rows, columns].any():
            assert r.pct is None
        else:
            assert r.pct == pytest.approx(known[rows, columns].sum() / r.n**2)
    assert masks.region_means(regions, table.limit(0), 2).filter("pct is not null").count() == 0


def test_mask_by_chunks_equals_the_whole_where_chunks_are_plain(spark):
    pixels = spark.createDataFrame([(1, y, x, 150, 70, 160) if (y // 16 + x // 16) % 2 else (1, y, x, 240, 240, 240) for y in range(64) for x in range(48)], "slide long, y long, x long, r int, g int, b int")
    got = {(r.y, r.x): r.m for r in masks.chunked(pixels, 16, 4).collect()}
    assert got == {(y, x): (y // 4 + x // 4) % 2 for y in range(16) for x in range(12)}
    assert masks.chunked(pixels.filter("y < 3 and x < 3"), 16, 4).count() == 0


def test_thresholds():
    with pytest.raises(ValueError):
        masks.enough_tissue(1.5)


def test_null_share_is_not_enough(spark):
    rows = spark.createDataFrame([(None,), (0.25,), (0.3,)], "pct double")
    assert rows.filter(masks.enough_tissue(0.25)).count() == 2
    assert rows.filter(masks.enough_tissue(0.25, strict=True)).count() == 1


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 1043])
def test_split_sizes(spark, n):
    rows = spark.range(n).select((F.col("id") * 3).alias("line_no"))
    out = sampling.split(rows, 10, "line_no").orderBy("line_no").collect()
    buckets = [r.bucket for r in out]
    assert buckets == sorted(buckets) and len(buckets) == n
    sizes = [buckets.count(b) for b in range(1, 11)]
    assert sizes == [n // 10 + (b < n % 10) for b in range(10)]


def test_split_of_skewed_and_repeated_orders(spark):
    values = [0] * 50 + list(range(1000)) + [10**12 + i for i in range(37)] + [None] * 3
    out = sampling.split(spark.createDataFrame([(v,) for v in values], "line_no long"), 7, "line_no").collect()
    by = {}
    for r in out:
        by.setdefault(r.bucket, []).append(-1 if r.line_no is None else r.line_no)
    assert [len(by[b]) for b in range(1, 8)] == [len(values) // 7 + (b < len(values) % 7) for b in range(7)]
    assert all(max(by[b]) <= min(by[b + 1]) for b in range(1, 7))


@pytest.fixture
def other_cuts_each_time(monkeypatch):
    """On a cluster the parts of a quantile sketch arrive in any order, so another evaluation gives other quantiles."""
    draw = F.udf(lambda values: sorted(random.SystemRandom().choices(values, k=255)) if values else None, "array<long>")
    monkeypatch.setattr(F, "percentile_approx", lambda column, *_: draw(F.collect_list(column)))


def test_split_whatever_the_cuts(spark, other_cuts_each_time):
    out = sampling.split(spark.range(0, 6007, 3, 5), 10, "id").orderBy("id").collect()
    assert [r.id for r in out] == list(range(0, 6007, 3))
    assert [r.bucket for r in out] == [b + 1 for b in range(10) for _ in range(2003 // 10 + (b < 3))]


def test_split_counts_whatever_the_cuts(spark, other_cuts_each_time):
    rows = spark.range(0, 6007, 3, 5).withColumn("id", F.when(F.col("id") % 9 > 0, F.col("id")))
    out = sampling.split_counts(sampling.split(rows, 10, "id", nulls_last=True), 12).orderBy("bucket").collect()
    assert [tuple(r) for r in out] == [(b + 1, 2003 // 10 + (b < 3) if b < 10 else 0) for b in range(12)]


def test_match_priorities(spark):
    slides = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "stem string")
    files = spark.createDataFrame([("a",), ("a_coords",), ("b_features",), ("b_patches",), ("c_z",), ("c_y",), ("dd",)], "file_stem string")
    got = {r.stem: (r.file_stem, r.priority) for r in matching.match(slides, files).collect()}
    assert got == {"a": ("a", 0), "b": ("b_patches", 2), "c": ("c_y", 4), "d": ("dd", 4), "e": (None, None)}


def test_scatter_keeps_mass(spark):
    rng = np.random.default_rng(2)
    rows = [(1, int(x), int(y), rng.random(3).tolist()) for x, y in rng.integers(0, 400, (60, 2))]
    placed = scatter.cells(spark.createDataFrame(rows, "slide long, x long, y long, f array<double>"), 100)
    grid = scatter.scatter_add(placed).collect()
    assert np.allclose(sum(np.array(r.f) for r in grid), sum(np.array(r[3]) for r in rows))
    assert sum(r.sx for r in grid) == sum(r[1] for r in rows)


def test_probabilities_and_ties(spark):
    model = classify.model_from(spark.createDataFrame([(0, "b"), (1, "a")], "idx int, label string"), spark.createDataFrame([(0, [1.0, 0.0], 0.0), (1, [1.0, 0.0], 0.0)], "idx int, w array<double>, b double"))
    rows = spark.createDataFrame([(1, [0.3, 9.0])], "id long, embedding array<double>")
    r = classify.predicted(classify.scored(rows, model)).first()
    assert r.predicted_organ == "a" and r.confidence == pytest.approx(0.5)
    assert len(r.top3_predictions) == 2 and sum(r.probabilities.values()) == pytest.approx(1)


def test_scores_of_odd_rows_and_wide_models(spark):
    rng = np.random.default_rng(4)
    weights, rows = rng.normal(size=(20, 768)), rng.normal(size=(30, 768)).astype(np.float32)
    model = spark.createDataFrame([([(f"c{i:02}", w.tolist(), float(i)) for i, w in enumerate(weights)],)], "classes array<struct<label:string,w:array<double>,b:double>>")
    frame = spark.createDataFrame([(i, r.tolist(), "kept") for i, r in enumerate(rows)] + [(100, None, "kept"), (101, [1.0], "kept"), (102, [float("nan")] * 768, "kept"), (103, [], "kept")], "id long, embedding array<float>, other string")
    got = {r.id: r for r in classify.scored(frame, model).collect()}
    for i, x in enumerate(rows):
        z = weights @ x.astype(float) + np.arange(20)
        p = np.exp(z - z.max())
        want = sorted(zip(-z, (f"c{k:02}" for k in range(20)), p / p.sum()))
        assert [s.label for s in got[i].scores] == [w[1] for w in want] and np.allclose([s.p for s in got[i].scores], [w[2] for w in want])
    assert all(got[i].scores is None and got[i].other == "kept" for i in (100, 101, 102, 103))
    plan = classify.scored(frame, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(ValueError):
        classify.scored(frame, model.union(model))
    with pytest.raises(ValueError):
        classify.scored(frame, model.limit(0))


def test_model_files(spark, tmp_path):
    labels = spark.createDataFrame([(0, "a")], "idx int, label string")
    classify.save(labels, spark.createDataFrame([(0, [1.0], 0.5)], "idx int, w array<double>, b double"), str(tmp_path / "m"))
    for path in (str(tmp_path / "m"), str(tmp_path / "none"), None):
        assert classify.load(spark, path, str(tmp_path / "m")).first().classes[0].b == 0.5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        classify.load(spark, str(tmp_path / "none"), str(tmp_path / "no default")).collect()


def test_modes_take_the_lower_of_equals(spark):
    rows = spark.createDataFrame([(1, 9, 5), (1, 7, 5), (1, 7, 6), (1, 9, 6)], "slide long, g int, b int")
    assert tuple(quality.modes(rows, "slide").first()) == (1, 7, 5)


def test_worker_rounding_is_half_to_even(spark):
    rows = spark.createDataFrame([("w", 0.25, 1), ("v", 0.0, 2)], "worker_id string, processing_time double, num_patches long")
    stats = tracking.worker_stats(rows)
    assert {r.worker_id: r.mean_time for r in stats.collect()} == {"w": 0.2, "v": 0.0}
    assert tracking.imbalance(stats).first().imbalance is None


def test_exit_codes():
    assert tracking.exit_code(1, 5) == 0 and tracking.exit_code(0, 5) == 1 and tracking.exit_code(1, 5, strict=True) == 1


def test_resize_keeps_constants_and_transform_shape():
    image = np.full((40, 50, 4), 77, np.uint8)
    assert (encoder.resize(image, 10, 13) == 77).all()
    assert encoder.transform(image, 16, [0.5] * 3, [0.5] * 3).shape == (3, 16, 16)


def test_hsv_of_plain_colours(spark):
    for rgb, want in (((255, 0, 0), (0, 255, 255)), ((0, 255, 0), (60, 255, 255)), ((0, 0, 255), (120, 255, 255)), ((9, 9, 9), (0, 0, 9)), ((0, 0, 0), (0, 0, 0))):
        row = spark.createDataFrame([rgb], "r int, g int, b int").select(*color.hsv(F.col("r"), F.col("g"), F.col("b"))).first()
        assert tuple(row) == want


def test_whole_pipeline(spark):
    meta = {"aperio.MPP": "0.5"}
    slides = spark.createDataFrame([(1, 160, 160, meta), (2, 160, 160, meta)], "slide long, w long, h long, metadata map<string,string>")
    pixels = spark.createDataFrame([(1, y, x, 150, 70, 160) if x < 10 else (1, y, x, 240, 240, 240) for y in range(20) for x in range(20)], "slide long, y long, x long, r int, g int, b int")
    config = slide_pipeline.Config(patch_size=32, downsample=8, threshold=0.5, inclusive=True, target_mpp=0.5)
    found = slide_pipeline.tiles(slides, slide_pipeline.tissue_mask(pixels, config), config)
    assert {(r.x, r.y) for r in found.collect()} == {(x, y) for x in (0, 32, 64) for y in range(0, 160, 32)}
    features = found.select("slide", "x", "y", F.array(F.col("x").cast("double"), F.lit(1.0)).alias("f"))
    model = classify.model_from(spark.createDataFrame([(0, "p"), (1, "q")], "idx int, label string"), spark.createDataFrame([(0, [1.0, 0.0], 0.0), (1, [0.0, 1.0], 0.0)], "idx int, w array<double>, b double"))
    out = {r.slide: r for r in slide_pipeline.predictions(slide_pipeline.embeddings(features), model, slides).collect()}
    assert out[1].predicted_organ == "p" and out[1].status is None and out[2].status == "failed"
