import importlib.util
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilespark.operators.encoder import resize
from tilespark.sources import foreign, listing, raster, scratch, tables, tiff, worklists
from tilespark.streaming import intake


def test_worklists(spark, tmp_path):
    (tmp_path / "w.txt").write_text("# comment\n /d/b.svs \n\n/d/a.svs\n/d/b.svs\nrel.svs\n")
    rows = worklists.read(spark, str(tmp_path / "w.txt"), base="/base")
    assert [r.path for r in rows.orderBy("line_no").collect()] == ["/d/b.svs", "/d/a.svs", "/d/b.svs", "/base/rel.svs"]
    assert [r.path for r in worklists.distinct_sorted(rows).collect()] == ["/base/rel.svs", "/d/a.svs", "/d/b.svs"]
    assert [r.path for r in worklists.first(rows, 3).collect()] == ["/base/rel.svs", "/d/a.svs", "/d/b.svs"]
    there = spark.createDataFrame([("/d/b.svs",)], "path string")
    assert worklists.existing(rows, there).count() == 2 and worklists.absent(rows, there).count() == 2
    assert {r.key for r in worklists.as_filter(rows).collect()} >= {"a", "/d/a.svs"}
    worklists.write_splits(rows, 3, str(tmp_path / "splits"))
    assert spark.read.text(str(tmp_path / "splits")).groupBy("bucket").count().count() == 3
    worklists.write_relative(rows, "/d/", str(tmp_path / "rel"))
    assert {r.value for r in spark.read.text(str(tmp_path / "rel")).collect()} == {"b.svs", "a.svs", "/base/rel.svs"}


def test_listing(spark, tmp_path):
    for name in ("a.svs", "b.SVS", "c.Svs", "d.svs.bak", "e.tif"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in listing.files(spark, str(tmp_path)).collect()] == ["a.svs", "b.SVS", "e.tif"]
    assert listing.single(spark, "/q/c.Svs").first().stem == "c"
    with pytest.raises(ValueError):
        listing.single(spark, "/q/c.doc")
    (tmp_path / "x_vec.pt").write_bytes(b"1")
    assert [r.stem for r in listing.stems(spark, str(tmp_path), "_vec.pt").collect()] == ["x"]


def test_tables(spark, tmp_path):
    (tmp_path / "c.csv").write_text("filename,needs_correction,g_modal,b_modal\na,True,1,2\nb,False,3,4\nc,,5,6\n")
    assert [r.filename for r in tables.read_flags(spark, str(tmp_path / "c.csv")).collect()] == ["a"]
    slides = spark.createDataFrame([("s", "p"), ("empty", "q")], "slide string, path string")
    tiles = spark.createDataFrame([("s", 0, 0, 8, 0, 0.5)], tables.TILES)
    tables.write_tiles(tiles, slides, str(tmp_path / "out"))
    counts = {r.slide: r.num_patches for r in spark.read.parquet(str(tmp_path / "out/slides")).collect()}
    assert counts == {"s": 1, "empty": 0}
    assert tables.read_tiles(spark, str(tmp_path / "out/tiles")).count() == 1
    assert tables.invalid_slides(tiles).count() == 0
    spark.createDataFrame([("a", [1.0]), ("b", None), ("c", [float("nan")])], "stem string, embedding array<double>").withColumn("metadata", F.lit(None).cast("map<string,string>")).withColumn("processing_info", F.lit(None).cast("map<string,string>")).write.parquet(str(tmp_path / "emb"))
    good, bad = tables.read_embeddings(spark, str(tmp_path / "emb"))
    assert (good.count(), bad.count()) == (1, 2)


@pytest.mark.parametrize(("tile", "deflate", "order", "samples"), [(16, True, "<", 3), (None, False, ">", 4), (32, False, "<", 1), (None, True, "<", 3)])
def test_tiff_levels_and_regions(tile, deflate, order, samples):
    rng = np.random.default_rng(samples)
    pages = [rng.integers(0, 256, (70 // k, 90 // k, samples)).astype(np.uint8) for k in (1, 2, 4)] + [np.zeros((5, 60, samples), np.uint8)]
    out = io.BytesIO()
    tiff.write(out, pages, tile, deflate, order)
    image = tiff.Tiff(out)
    assert [(w, h) for w, h, _ in image.levels] == [(90, 70), (45, 35), (22, 17)]  # the last page is of another shape
    for level, page in enumerate(pages[:3]):
        for x, y, w, h in ((0, 0, page.shape[1], page.shape[0]), (3, 5, 7, 11), (page.shape[1] - 1, page.shape[0] - 1, 1, 1), (14, 1, 5, 16)):
            assert (image.region(level, x, y, w, h) == page[y : y + h, x : x + w]).all()
    for bad in ((0, 80, 0, 20, 5), (0, -1, 0, 2, 2)):
        with pytest.raises(ValueError):
            image.region(*bad)
    with pytest.raises(ValueError):
        tiff.Tiff(io.BytesIO(b"neither one nor the other"))


def test_reduced_rows_are_those_of_the_whole(tmp_path):
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (101, 77, 3)).astype(np.uint8)
    raster.write_ppm(str(tmp_path / "s.ppm"), image)
    whole = resize(image, 101 // 4, 77 // 4)
    parts = [raster.reduced(raster.open_raster(str(tmp_path / "s.ppm")), 4, a, min(25, a + 7)) for a in range(0, 25, 7)]
    assert (np.concatenate(parts) == whole).all()
    d = np.abs((np.arange(101)[None, :] - ((np.arange(25) + 0.5) * 101 / 25 - 0.5)[:, None]) / (101 / 25))
    w = np.where(d < 4, np.sinc(d) * np.sinc(d / 4), 0)
    column = np.clip(np.rint((w / w.sum(1, keepdims=True)) @ image[:, 30, 0]), 0, 255)
    assert (resize(image[:, 30:31], 25, 1)[:, 0, 0] == column).all()


def test_levels_are_checked(spark):
    levels = F.expr("array(struct(1L as w), struct(2L as w))")
    assert spark.range(1).select(F.size(raster.check_level(levels, 1)).alias("n")).first().n == 2
    with pytest.raises(Exception, match="level 2 isn't there; the image has 2 levels"):
        spark.range(1).select(raster.check_level(levels, 2)).collect()


def test_other_tools_files_say_what_is_missing(spark, tmp_path):
    for source, name, package in ((foreign.TileFiles, "hdf5tiles", "h5py"), (foreign.TensorFiles, "tensors", "torch")):
        spark.dataSource.register(source)
        if importlib.util.find_spec(package) is None:
            with pytest.raises(Exception, match=f"need the package {package}"):
                spark.read.format(name).option("path", str(tmp_path)).load().collect()
    if importlib.util.find_spec("h5py") is None:
        with pytest.raises(ModuleNotFoundError, match="h5py"):
            foreign.write_tile_files(spark.range(1), str(tmp_path))


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    assert scratch.folder(spark) != scratch.folder(spark)
    assert scratch.base("hdfs:///shared/", "spark://host:7077") == "hdfs:///shared" and scratch.base(None, "local[4]")
    with pytest.raises(RuntimeError):
        scratch.base(None, "spark://host:7077")


def test_raster_source(spark, tmp_path):
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (48, 64, 3)).astype(np.uint8)
    raster.write_ppm(str(tmp_path / "s.ppm"), image)
    assert (raster.open_raster(str(tmp_path / "s.ppm")).region(0, 0, 0, 64, 48) == image).all()
    spark.dataSource.register(raster.RasterSource)
    row = spark.read.format("raster").option("path", str(tmp_path)).load().first()
    assert (row.w, row.h, row.levels[0].downsample) == (64, 48, 1.0)
    pixels = spark.read.format("raster").option("path", str(tmp_path)).option("factor", "4").load()
    assert pixels.count() == 12 * 16
    small = resize(image, 12, 16)
    for r in pixels.limit(20).collect():
        assert (r.r, r.g, r.b) == tuple(int(v) for v in small[r.y, r.x])


def test_incremental_intake(spark, tmp_path):
    inbox, done = tmp_path / "in", str(tmp_path / "done")
    inbox.mkdir()
    (inbox / "1.txt").write_text("/d/a.svs\n/d/a.svs\n#no\n")
    work = lambda rows: rows.select("stem", "path")
    run = lambda: intake.process_new(intake.worklist_stream(spark, str(inbox)), work, done, str(tmp_path / "ck")).awaitTermination()
    run()
    assert spark.read.parquet(done).count() == 1
    (inbox / "2.txt").write_text("/e/a.svs\n/d/b.svs\n")
    run()
    assert sorted(r.stem for r in spark.read.parquet(done).collect()) == ["a", "b"]


def test_pictures(spark, tmp_path):
    import struct
    import zlib

    from tilespark.sources import images

    rng = np.random.default_rng(3)
    for image in (rng.integers(0, 256, (5, 7, 3)).astype(np.uint8), rng.integers(0, 256, (4, 6)).astype(np.uint8)):
        data = images.png(image)
        assert struct.unpack_from(">II", data, 16) == (image.shape[1], image.shape[0])
        size = struct.unpack_from(">I", data, 33)[0]
        rows = np.frombuffer(zlib.decompress(data[41 : 41 + size]), np.uint8).reshape(image.shape[0], -1)
        assert (rows[:, 1:].reshape(image.shape) == image).all()
    drawn = images.overlay(np.zeros((10, 10, 3), np.uint8), np.array([2]), np.array([3]), 4, ["red"])
    assert (drawn[3, 2:7] == (255, 0, 0)).all() and (drawn[3:8, 6] == (255, 0, 0)).all() and not drawn[4:7, 3:6].any()
    tile = rng.integers(0, 256, (4, 3, 3)).astype(np.uint8)
    rows = spark.createDataFrame([("s/patch_0_0.png", bytearray(tile.tobytes()), 3)], "name string, pixels binary, width int")
    images.write_files(rows.select("name", images.tile_png("pixels", "width").alias("content")), str(tmp_path))
    assert (tmp_path / "s/patch_0_0.png").read_bytes() == images.png(tile)


def test_tiff_tag():
    import struct

    from tilespark.sources import images

    for order in "<>":
        entries = [(256, 3, 1, 5), (262, 3, 1, 2)]
        data = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HIH", 42, 8, 2) + b"".join(struct.pack(f"{order}HHIHH", t, k, n, v, 0) for t, k, n, v in entries) + bytes(4)
        out = images.tiff_with_tag(data)
        assert struct.unpack_from(f"{order}H", out, 10 + 12 + 8)[0] == 6 and len(out) == len(data)
        with pytest.raises(ValueError):
            images.tiff_with_tag(data, tag=999)
    with pytest.raises(ValueError):
        images.tiff_with_tag(b"no")
