"""Queries over files, sinks, rasters and streams, on files that each query writes from the shared tables.

The files go to the folder that driver and executors share; what is read back is held against SQL on the tables.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import functions as F

from ..functions import color
from ..operators import classify, encoder, exclusion, masks, matching, quality, sampling, tiling, tracking
from ..sources import images, listing, raster, scratch, tables, tiff, worklists
from ..streaming import intake
from . import catalogue as base
from .registry import SQL, query, table

# ---- worklists and folders -------------------------------------------------------------------------------------------

#: A worklist with blanks around paths, comments, blank lines and repeats.
_LINES = """WITH l AS (SELECT s_suppkey AS k, 0 AS kind, '  /data/b' || s_suppkey % 3 || '/S' || s_suppkey || '.svs ' AS line FROM supplier
UNION ALL SELECT s_suppkey, 1, '# case ' || s_suppkey FROM supplier WHERE s_suppkey % 4 = 0 UNION ALL SELECT s_suppkey, 2, '' FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT s_suppkey, 3, '/data/b' || s_suppkey % 3 || '/S' || s_suppkey || '.svs' FROM supplier WHERE s_suppkey % 6 = 0),
n AS (SELECT k, row_number() OVER (ORDER BY k, kind) AS line_no, trim(line) AS path FROM l),
w AS (SELECT k, line_no, path, regexp_extract(path, '([^/]+)$', 1) AS name FROM n WHERE path <> '' AND NOT starts_with(path, '#')) """


def _key(column: str = "s_suppkey") -> F.Column:
    return F.col(column)


def _path(key) -> F.Column:
    return F.concat(F.lit("/data/b"), (key % 3).cast("string"), F.lit("/S"), key.cast("string"), F.lit(".svs"))


def _worklist(spark, sf_dir) -> str:
    k, supplier = _key(), table(spark, sf_dir, "supplier")
    of = lambda rows, kind, line: rows.select(k.alias("k"), F.lit(kind).alias("kind"), line.alias("line"))
    lines = of(supplier, 0, F.concat(F.lit("  "), _path(k), F.lit(" ")))
    for rows, kind, line in ((supplier.filter(k % 4 == 0), 1, F.concat(F.lit("# case "), k.cast("string"))), (supplier.filter(k % 5 == 0), 2, F.lit("")), (supplier.filter(k % 6 == 0), 3, _path(k))):
        lines = lines.unionByName(of(rows, kind, line))
    folder = scratch.folder(spark)
    lines.repartition(1).sortWithinPartitions("k", "kind").select("line").write.text(folder)
    return folder


def _listed(spark, sf_dir):
    return table(spark, sf_dir, "supplier").filter("s_suppkey % 3 <> 0").select(_path(_key()).alias("path"))


@query(_LINES + "SELECT DISTINCT path, name, regexp_replace(name, '\\.[^.]*$', '') AS stem, '.svs' AS ext FROM w WHERE k % 3 <> 0")
def q50_worklist_scan(spark, sf_dir):
    rows = worklists.read(spark, _worklist(spark, sf_dir))
    return worklists.distinct_sorted(worklists.existing(rows, _listed(spark, sf_dir)))


@query(_LINES + "SELECT line_no, path FROM w")
def q51_worklist_in_order(spark, sf_dir):
    return worklists.read(spark, _worklist(spark, sf_dir)).select("line_no", "path")


@query(_LINES + "SELECT line_no, path FROM w WHERE k % 3 <> 0")
def q52_worklist_existing(spark, sf_dir):
    return worklists.existing(worklists.read(spark, _worklist(spark, sf_dir)), _listed(spark, sf_dir)).select("line_no", "path")


@query(_LINES + "SELECT DISTINCT unnest([path, regexp_replace(name, '\\.[^.]*$', '')]) AS key FROM w")
def q53_worklist_keys(spark, sf_dir):
    return worklists.as_filter(worklists.read(spark, _worklist(spark, sf_dir)))


_STEMS = "(SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'S' || s_suppkey ELSE '/data/b' || s_suppkey % 3 || '/S' || s_suppkey || '.svs' END AS key FROM supplier)"


@query(_LINES + f"SELECT s_suppkey FROM {_STEMS} s WHERE EXISTS (SELECT 1 FROM w WHERE s.key IN (path, regexp_replace(name, '\\.[^.]*$', '')) AND k % 3 <> 0)")
def q54_worklist_filter(spark, sf_dir):
    """Files named by path or by stem, kept if the worklist holds either."""
    k = _key()
    rows = worklists.existing(worklists.read(spark, _worklist(spark, sf_dir)), _listed(spark, sf_dir))
    files = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 2 == 0, F.concat(F.lit("S"), k.cast("string"))).otherwise(_path(k)).alias("key"))
    return matching.chosen(files, worklists.as_filter(rows), "key").select("s_suppkey")


_SUFFIXES = (".svs", ".SVS", ".Svs", ".tif", ".txt", ".svs.bak")
_FILES = "WITH f AS (SELECT s_suppkey AS k, 'F' || s_suppkey || " + f"list_extract({list(_SUFFIXES)}, (s_suppkey % 6 + 1)::INT) AS name, (s_suppkey % 7 + 1)::BIGINT AS length FROM supplier WHERE s_suppkey <= 60) "


def _folder(spark, sf_dir) -> str:
    k = _key()
    name = F.concat(F.lit("F"), k.cast("string"), F.element_at(F.array(*map(F.lit, _SUFFIXES)), (k % 6 + 1).cast("int")))
    folder = scratch.folder(spark)
    images.write_files(table(spark, sf_dir, "supplier").filter("s_suppkey <= 60").select(name.alias("name"), F.expr("unhex(repeat('00', s_suppkey % 7 + 1))").alias("content")), folder)
    return folder


@query(_FILES + r"SELECT name, regexp_replace(name, '\.[^.]*$', '') AS stem, regexp_extract(name, '(\.[^.]*)$', 1) AS ext, length FROM f WHERE k % 6 IN (0, 1, 3)")
def q55_folder_listing(spark, sf_dir):
    return listing.files(spark, _folder(spark, sf_dir)).select("name", "stem", "ext", "length")


@query("SELECT * FROM (VALUES ('/d/Case 1.SVS', 'Case 1', '.SVS'), ('/d/x.y.Tif', 'x.y', '.Tif')) t(path, stem, ext)")
def q56_single_file(spark, sf_dir):
    return listing.single(spark, "/d/Case 1.SVS").unionByName(listing.single(spark, "/d/x.y.Tif")).select("path", "stem", "ext")


_MODES = _FILES + r""", v AS (SELECT 'dir' AS mode, name FROM f WHERE k % 6 IN (0, 3) UNION ALL SELECT 'single', 'F6.svs' UNION ALL SELECT 'worklist', name FROM f WHERE k % 6 < 3 UNION ALL SELECT 'worklist', 'gone.svs')
SELECT mode, name FROM v"""


@query(_MODES.replace(") , v", "), v"))
def q57_input_modes(spark, sf_dir):
    """The same folder as a folder, by one of its files, and by a worklist of bare names and a whole path."""
    folder = _folder(spark, sf_dir)
    names = [r.name for r in table(spark, sf_dir, "supplier").filter("s_suppkey <= 60 and s_suppkey % 6 < 3").select(F.concat(F.lit("F"), _key().cast("string"), F.element_at(F.array(*map(F.lit, _SUFFIXES)), (_key() % 6 + 1).cast("int"))).alias("name")).collect()]  # 60 at most
    scratch.put(f"{folder}/list.txt", "\n".join(["# names", *names, "missing.svs", "/elsewhere/gone.svs"]).encode())
    out = None
    for path in (folder, f"{folder}/F6.svs", f"{folder}/list.txt"):
        rows = worklists.inputs(spark, path).select(F.lit(worklists.mode(path)).alias("mode"), "name")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- sinks -----------------------------------------------------------------------------------------------------------


@query("SELECT 'F' || event_id AS filename FROM events WHERE event_id % 4 < 2")
def q58_flagged_files(spark, sf_dir):
    i, folder = F.col("event_id"), scratch.folder(spark)
    flag = F.when(i % 4 == 0, "True").when(i % 4 == 1, "true").when(i % 4 == 2, "FALSE")
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("F"), i.cast("string")).alias("filename"), flag.alias("needs_correction"), (i % 256).alias("g_modal"), (i % 200).alias("b_modal"))
    rows.write.csv(folder, header=True)
    return tables.read_flags(spark, folder)


@query("SELECT 'F' || event_id AS filename, 'w' || user_id AS worker_id, value AS processing_time, event_id % 50 AS num_patches, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status FROM events")
def q59_tracking_files(spark, sf_dir):
    i, folder = F.col("event_id"), scratch.folder(spark)
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("F"), i.cast("string")).alias("filename"), F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("worker_id"), F.lit("a").alias("start_time"), F.lit("b").alias("end_time"), F.col("value").alias("processing_time"), (i % 50).alias("num_patches"), F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"))
    tables.write_tracking(rows.filter("status = 'success'"), rows.filter("status = 'error'"), rows, folder)
    return tables.read_timings(spark, f"{folder}/timings").select("filename", "worker_id", "processing_time", "num_patches", "status")


_GRID = base._grid_sql("0", "SELECT 'P' || p_partkey AS slide, x, y FROM g").replace("SELECT 'P'", ", t AS (SELECT 'P'") + ") "


def _stored(spark, sf_dir) -> str:
    folder = scratch.folder(spark)
    slides = base._slides(spark, sf_dir).withColumn("slide", F.concat(F.lit("P"), F.col("p_partkey").cast("string")))
    tiles = tiling.grid(slides, F.lit(256)).select("slide", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), F.lit(256).alias("patch_size"), F.lit(0).alias("level"), F.lit(0.5).cast("float").alias("tissue_pct"))
    tables.write_tiles(tiles, slides.select("slide"), folder)
    return folder


@query(_GRID + "SELECT 'P' || p_partkey AS slide, coalesce(n, 0)::BIGINT AS num_patches, n AS stored FROM part LEFT JOIN (SELECT slide, count(*) AS n FROM t GROUP BY 1) c ON c.slide = 'P' || p_partkey")
def q60_tile_store(spark, sf_dir):
    folder = _stored(spark, sf_dir)
    counts = tables.read_tiles(spark, f"{folder}/tiles").groupBy("slide").agg(F.count("*").alias("stored"))
    return spark.read.parquet(f"{folder}/slides").join(counts, "slide", "left").select("slide", "num_patches", "stored")


@query(_GRID + "SELECT slide, min(256) AS low, max(256) AS high, 1 AS level FROM t WHERE slide LIKE '%7' GROUP BY 1")
def q61_invalid_slides(spark, sf_dir):
    tiles = tables.read_tiles(spark, f"{_stored(spark, sf_dir)}/tiles")
    return tables.invalid_slides(tiles.withColumn("level", F.when(F.col("slide").endswith("7"), 1).otherwise(0)))


@query("SELECT page_id, url AS filename, page_id / 7.0::DOUBLE AS confidence FROM pages")
def q62_prediction_file(spark, sf_dir):
    folder = scratch.folder(spark)
    rows = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("filename"), (F.col("page_id") / F.lit(7.0)).alias("confidence"))
    tables.write_predictions(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


@query("SELECT vec_id, round(list_extract(embedding, 1)::DOUBLE, 6) AS first, vec_id % 3 <> 0 AS good, 'v' || vec_id AS path FROM embeddings")
def q63_embedding_store(spark, sf_dir):
    """Embeddings with their records beside them; those with a broken vector come back as rejects."""
    folder, i = scratch.folder(spark), F.col("vec_id")
    vector = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, sf_dir, "embeddings").select(i.cast("string").alias("stem"), F.when(i % 3 != 0, vector).otherwise(F.concat(vector, F.array(F.lit(float("nan"))))).alias("embedding"), F.create_map(F.lit("wsi_path"), F.concat(F.lit("v"), i.cast("string"))).alias("metadata"), F.create_map(F.lit("device"), F.lit("cpu")).alias("processing_info"))
    tables.write_embeddings(rows, folder)
    good, bad = tables.read_embeddings(spark, f"{folder}/embeddings")
    both = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
    records = spark.read.parquet(f"{folder}/records").select("stem", F.get_json_object("record", "$.metadata.wsi_path").alias("path"))
    return both.join(records, "stem").select(F.col("stem").cast("long").alias("vec_id"), F.round(F.col("embedding")[0], 6).alias("first"), "good", "path")


@query("SELECT label AS slide, count(*) AS n, round(sum(list_extract(embedding, 64)::DOUBLE), 6) AS last FROM embeddings GROUP BY 1")
def q64_feature_dump(spark, sf_dir):
    folder, i = scratch.folder(spark), F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("slide"), i.alias("x"), (i * 2).alias("y"), F.col("embedding").alias("f"), F.lit(0.5).alias("tissue_pct"))
    slides = rows.select("slide").distinct().select("slide", F.lit(512).alias("patch_size"), F.create_map(F.lit("a"), F.lit("b")).alias("metadata"))
    tables.write_features(rows, slides, folder)
    kept = spark.read.parquet(f"{folder}/features").join(spark.read.parquet(f"{folder}/slides").filter("patch_size = 512"), "slide")
    return kept.groupBy("slide").agg(F.count("*").alias("n"), F.round(F.sum(F.col("f")[63].cast("double")), 6).alias("last"))


@query("SELECT unnest(['Files: 3', 'Job: q65', repeat('=', 60)]) AS value UNION ALL SELECT '[' || CASE WHEN page_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END || '] P' || page_id || ' ' || page_id % 9 || '.5s' FROM pages")
def q65_batch_log(spark, sf_dir):
    i, folder = F.col("page_id"), scratch.folder(spark)
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("P"), i.cast("string")).alias("stem"), F.when(i % 5 == 0, "failed").otherwise("success").alias("status"), (i % 9 + F.lit(0.5)).alias("processing_time"))
    tables.write_log(rows, {"Job": "q65", "Files": "3"}, folder)
    return spark.read.text(folder)


@query("SELECT 's' || s_suppkey % 4 || '/patch_' || s_suppkey || '_0.png' AS name, (s_suppkey % 5 + 1)::BIGINT AS width, 2::BIGINT AS height FROM supplier WHERE s_suppkey <= 100")
def q66_tile_pictures(spark, sf_dir):
    k, folder = _key(), scratch.folder(spark)
    rows = table(spark, sf_dir, "supplier").filter("s_suppkey <= 100").select(F.concat(F.lit("s"), (k % 4).cast("string"), F.lit("/patch_"), k.cast("string"), F.lit("_0.png")).alias("name"), F.expr("unhex(repeat('0A141E', 2 * (s_suppkey % 5 + 1)))").alias("pixels"), (k % 5 + 1).alias("width"))
    images.write_files(rows.select("name", images.tile_png("pixels", "width").alias("content")), folder)
    number = lambda at: F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.regexp_extract("path", "(s[0-9]/[^/]+)$", 1).alias("name"), number(17).alias("width"), number(21).alias("height"))


@query(_LINES + "SELECT ntile(4) OVER (ORDER BY line_no)::INT AS bucket, path FROM w")
def q67_split_files(spark, sf_dir):
    folder = scratch.folder(spark)
    worklists.write_splits(worklists.read(spark, _worklist(spark, sf_dir)), 4, folder)
    return spark.read.text(folder).select(F.col("bucket").cast("int").alias("bucket"), F.col("value").alias("path"))


@query("SELECT s_suppkey, (s_suppkey % 3 + 1)::INT AS before, CASE WHEN s_suppkey % 4 <> 0 THEN 6 END::INT AS after FROM supplier")
def q68_tiff_tag(spark, sf_dir):
    """A file of one directory, with and without the tag."""
    k = _key()
    tag = F.when(k % 4 == 0, "0F01").otherwise("0601")
    content = F.unhex(F.concat(F.lit("49492A0008000000" "0200" "000103000100000005000000"), tag, F.lit("030001000000"), F.lpad(F.hex(k % 3 + 1), 2, "0"), F.lit("000000" "00000000")))
    value = lambda c: F.conv(F.hex(F.substring(c, 31, 1)), 16, 10).cast("int")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", content.alias("content"))
    return rows.withColumn("fixed", images.with_photometric("content")).select("s_suppkey", value("content").alias("before"), value("fixed").alias("after"))


@query(SQL["q45_timing_shares"])
def q69_report_file(spark, sf_dir):
    folder, report = scratch.folder(spark), base.q45_timing_shares(spark, sf_dir)
    tables.write_json(report, folder)
    return spark.read.schema(report.schema).json(folder)


# ---- pixels ----------------------------------------------------------------------------------------------------------

_CIRCLE = base._HSV.replace("30.0::DOUBLE", "(256 / 6.0::DOUBLE)").replace("hh + 180", "hh + 256")


@query(_CIRCLE + " SELECT event_id, hue, sat, val, hue BETWEEN 0 AND 180 AND sat BETWEEN 20 AND 255 AND val BETWEEN 30 AND 255 AS tissue FROM hsv")
def q70_hsv_full_circle(spark, sf_dir):
    channels = color.hsv(F.col("r"), F.col("g"), F.col("b"), color.FULL_BYTE)
    return base._raster(spark, sf_dir).select("event_id", *(c.alias(n) for c, n in zip(channels, ("hue", "sat", "val"))), color.in_box(channels, color.TISSUE_WIDE).alias("tissue"))


def _axis_sql(name: str, size: str) -> str:
    """Weights of each place of the reduced axis, at a factor of 4."""
    return f"""{name}t AS (SELECT slide, unnest(range(0, ({size} // 4)::BIGINT)) AS t, {size} AS n FROM sizes), {name}d AS (SELECT slide, t, n / (n // 4)::DOUBLE AS c, unnest(range(0, n)) AS s FROM {name}t),
{name}w AS (SELECT slide, t, s, ((s - ((t + 0.5::DOUBLE) * c - 0.5::DOUBLE)) / c) AS d FROM {name}d), {name}k AS (SELECT slide, t, s, CASE WHEN abs(d) >= 4 THEN 0 WHEN d = 0 THEN 1 ELSE (sin(pi() * d) / (pi() * d)) * (sin(pi() * d / 4) / (pi() * d / 4)) END AS k FROM {name}w),
{name} AS (SELECT slide, t, s, k / sum(k) OVER (PARTITION BY slide, t) AS k FROM {name}k)"""


@query(base._RASTER + ", sizes AS (SELECT slide, max(y) + 1 AS h, max(x) + 1 AS w FROM px GROUP BY 1), " + _axis_sql("ay", "h") + ", " + _axis_sql("ax", "w") + """,
p AS (SELECT px.slide, ay.t AS y, px.x, sum(ay.k * r) AS r, sum(ay.k * g) AS g, sum(ay.k * b) AS b FROM px JOIN ay ON ay.slide = px.slide AND ay.s = px.y WHERE ay.k <> 0 GROUP BY 1, 2, 3),
q AS (SELECT p.slide, p.y, ax.t AS x, sum(ax.k * r) AS r, sum(ax.k * g) AS g, sum(ax.k * b) AS b FROM p JOIN ax ON ax.slide = p.slide AND ax.s = p.x WHERE ax.k <> 0 GROUP BY 1, 2, 3)
SELECT slide, y, x, greatest(0, least(255, round(r)))::INT AS r, greatest(0, least(255, round(g)))::INT AS g, greatest(0, least(255, round(b)))::INT AS b FROM q""")
def q71_reduced_pixels(spark, sf_dir):
    pixels = base._raster(spark, sf_dir)
    sizes = pixels.groupBy("slide").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return encoder.reduce_pixels(pixels.join(sizes, "slide"), 4)


@query("SELECT s_suppkey, upper(repeat(lpad(to_hex(s_suppkey % 200 + 16), 2, '0') || '0B0C', 3)) AS rgb, upper(repeat(lpad(to_hex(s_suppkey % 200 + 16), 2, '0') || '0B0C', 16)) AS resized FROM supplier")
def q72_tile_arrays(spark, sf_dir):
    """Plain tiles of three pixels with alpha: without it, and as 2 x 2 squares made 4 x 4."""
    channel = F.hex(_key() % 200 + 16)
    pixel = F.concat(channel, F.lit("0B0C"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.unhex(F.repeat(F.concat(pixel, F.lit("7F")), F.lit(3))).alias("rgba"), F.unhex(F.repeat(pixel, F.lit(4))).alias("square"), F.lit(4).alias("four"), F.lit(2).alias("two"))
    return rows.select("s_suppkey", F.hex(encoder.without_alpha("rgba", "four")).alias("rgb"), F.hex(encoder.resized("square", "two", 4)).alias("resized"))


def _means():
    """A model that stands in for a tile encoder: the mean byte, and the number of bytes."""
    return lambda tiles: np.array([[np.frombuffer(t, np.uint8).mean(), len(t)] for t in tiles], np.float32)


@query("SELECT s_suppkey, round((s_suppkey % 200 + 26) / 2.0, 4)::DOUBLE AS mean, (2 * (s_suppkey % 6 + 1))::DOUBLE AS n FROM supplier")
def q73_encoded_tiles(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.unhex(F.repeat(F.concat(F.hex(_key() % 200 + 16), F.lit("0A")), (_key() % 6 + 1).cast("int"))).alias("image"))
    out = rows.withColumn("f", encoder.encode_tiles(_means, 4)("image"))
    return out.select("s_suppkey", F.round(F.col("f")[0].cast("double"), 4).alias("mean"), F.col("f")[1].cast("double").alias("n"))


_LEVEL = (96, 64)


def _pyramid(spark) -> str:
    """A TIFF file of two levels, whose pixels follow from their places; the second is by 4 smaller, and no mean."""
    out, pages = io.BytesIO(), []
    for scale in (1, 4):
        y, x = np.indices((_LEVEL[1] // scale, _LEVEL[0] // scale))
        pages.append(np.stack([(x * 7 + y * 13 + c * 29 + scale) % 251 for c in range(3)], 2).astype(np.uint8))
    tiff.write(out, pages, tile=32)
    folder = scratch.folder(spark)
    scratch.put(f"{folder}/slide.tif", out.getvalue())
    return folder


@query("SELECT 'slide.tif' AS name, 96::BIGINT AS w, 64::BIGINT AS h, * FROM (VALUES (0, 96::BIGINT, 64::BIGINT, 1.0::DOUBLE), (1, 24::BIGINT, 16::BIGINT, 4.0::DOUBLE)) l(level, level_w, level_h, downsample)")
def q74_raster_levels(spark, sf_dir):
    spark.dataSource.register(raster.RasterSource)
    rows = spark.read.format("raster").option("path", _pyramid(spark)).load().withColumn("levels", raster.check_level(F.col("levels"), 1))
    return rows.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "w", "h", F.posexplode("levels").alias("level", "l")).select("name", "w", "h", "level", F.col("l.w").alias("level_w"), F.col("l.h").alias("level_h"), F.col("l.downsample").alias("downsample"))


@query("SELECT y::INT AS y, x::INT AS x, ((x * 7 + y * 13 + 4) % 251)::INT AS r, ((x * 7 + y * 13 + 33) % 251)::INT AS g, ((x * 7 + y * 13 + 62) % 251)::INT AS b FROM range(16) a(y), range(24) b(x)")
def q75_thumbnail(spark, sf_dir):
    spark.dataSource.register(raster.RasterSource)
    return spark.read.format("raster").option("path", _pyramid(spark)).option("factor", "4").option("thumbnail", "true").load().drop("path")


def _tiles_of_file(spark):
    path = f"{_pyramid(spark)}/slide.tif"
    spread = spark.range(24).select((F.col("id") % 6 * 18).alias("x"), (F.floor(F.col("id") / 6) * 18).alias("y"))
    return raster.with_regions(spread.select(F.lit(path).alias("path"), "x", "y", F.lit(20).alias("size")))


@query("""WITH t AS (SELECT i % 6 * 18 AS x, i // 6 * 18 AS y FROM range(24) r(i)), v AS (SELECT x, y, x + 20 <= 96 AND y + 20 <= 64 AS ok FROM t)
SELECT x::BIGINT AS x, y::BIGINT AS y, NOT ok AS is_imputed, CASE WHEN ok THEN printf('%02X%02X%02X', (x * 7 + y * 13 + 1) % 251, (x * 7 + y * 13 + 30) % 251, (x * 7 + y * 13 + 59) % 251) ELSE '000000' END AS first,
CASE WHEN ok THEN printf('%02X%02X%02X', ((x + 19) * 7 + (y + 19) * 13 + 1) % 251, ((x + 19) * 7 + (y + 19) * 13 + 30) % 251, ((x + 19) * 7 + (y + 19) * 13 + 59) % 251) ELSE '000000' END AS last FROM v""")
def q76_imputed_tiles(spark, sf_dir):
    """Regions of a file; those that reach over its edge become zeros."""
    pixel = lambda at: F.hex(F.substring("pixels", at, 3))
    return raster.imputed(_tiles_of_file(spark)).select("x", "y", "is_imputed", pixel(1).alias("first"), pixel(1198).alias("last"))


@query("WITH t AS (SELECT i % 6 * 18 AS x, i // 6 * 18 AS y FROM range(24) r(i)) SELECT x::BIGINT AS x, y::BIGINT AS y, NOT (x + 20 <= 96 AND y + 20 <= 64) AS lost FROM t")
def q77_rejected_tiles(spark, sf_dir):
    good, bad = raster.rejected(_tiles_of_file(spark))
    return good.select("x", "y", F.lit(False).alias("lost")).unionByName(bad.filter("error is not null").select("x", "y", F.lit(True).alias("lost")))


@query(base._SLIDES.replace("p_retailprice::BIGINT", "round_even(p_retailprice, 0)::BIGINT") + " SELECT p_partkey, greatest(ceil(w / 400.0), ceil(h / 400.0), 1)::BIGINT AS stride FROM d")
def q78_stride(spark, sf_dir):
    return base._slides(spark, sf_dir).select("p_partkey", quality.stride(F.col("w"), F.col("h"), 400).alias("stride"))


# ---- masks and tiles -------------------------------------------------------------------------------------------------

_CHUNK = 30


def _chunk_sql() -> str:
    steps = "," + ",".join(base._cross_sql(s, t, c) for s, t, c in (("m0", "m1", "least"), ("m1", "m2", "greatest"), ("m2", "m3", "greatest"), ("m3", "m4", "least")))
    for a, b in (("SELECT slide, y, x, ", f"SELECT slide, y, x, y // {_CHUNK} AS cy, x // {_CHUNK} AS cx, "), ("PARTITION BY slide, y ORDER", f"PARTITION BY slide, y, x // {_CHUNK} ORDER"), ("PARTITION BY slide, x ORDER", f"PARTITION BY slide, x, y // {_CHUNK} ORDER")):
        steps = steps.replace(a, b)
    return base._HSV + steps


@query(_chunk_sql() + " SELECT slide, y, x, m FROM m4")
def q79_mask_by_chunks(spark, sf_dir):
    return masks.chunked(base._raster(spark, sf_dir), _CHUNK, 1)


@query(base._CLEAN + ", o AS (SELECT slide, unnest([0, 4]) AS size FROM (SELECT DISTINCT slide FROM m4)) SELECT o.slide, size, CASE WHEN size > 0 THEN round(sum(m)::DOUBLE / (size * size), 6) END AS pct FROM o LEFT JOIN m4 ON m4.slide = o.slide AND m4.y < size AND m4.x < size GROUP BY 1, 2")
def q80_no_region(spark, sf_dir):
    mask = masks.clean(base._mask(spark, sf_dir))
    regions = base._mask(spark, sf_dir).select("slide").distinct().select("slide", F.lit(0).alias("y"), F.lit(0).alias("x"), F.explode(F.array(F.lit(0), F.lit(4))).alias("size"))
    return masks.region_means(regions, mask, F.col("size")).select("slide", "size", F.round("pct", 6).alias("pct"))


@query(base._XY + ", r AS (SELECT slide, event_id, row_number() OVER (PARTITION BY slide ORDER BY y, x) AS k FROM t WHERE NOT (x < 30 AND y > 2)) SELECT slide, event_id FROM r WHERE k <= 300")
def q81_exclude_then_limit(spark, sf_dir):
    return sampling.head(exclusion.exclude(base._raster(spark, sf_dir), "x:<:30,y:>:2", "all"), 300, "slide").select("slide", "event_id")


_SIDE = 20


@query(base._tile_sql(f""", exact AS (SELECT slide, x // {_SIDE} * {_SIDE} AS x, y // {_SIDE} * {_SIDE} AS y, avg(m) AS pct FROM m0 GROUP BY 1, 2, 3)
SELECT t.slide, t.x, t.y, round(e.pct, 6) AS pct FROM tiles t JOIN exact e ON e.slide = t.slide AND e.x = t.x AND e.y = t.y WHERE t.pct >= 0.25 AND e.pct >= 0.3""", _SIDE, _SIDE))
def q82_verified_tiles(spark, sf_dir):
    """Tiles by the cleaned mask, whose shares are taken anew from all of their pixels."""
    cells, pixels = base._mask(spark, sf_dir), base._raster(spark, sf_dir)
    sizes = cells.groupBy("slide").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    tiles = masks.region_means(tiling.grid(sizes, F.lit(_SIDE)), masks.clean(cells), _SIDE).filter(masks.enough_tissue(0.25)).select("slide", "x", "y", "pct")
    corner = pixels.withColumns({c: F.floor(F.col(c) / _SIDE) * _SIDE for c in "xy"})
    exact = masks.tile_share(corner, color.in_box(color.hsv(F.col("r"), F.col("g"), F.col("b"))), "slide", "x", "y")
    return masks.verified(tiles, exact, 0.3, "slide", "x", "y").select("slide", "x", "y", F.round("pct", 6).alias("pct"))


# ---- model, reports, records -----------------------------------------------------------------------------------------


@query(base._PROBE + "SELECT vec_id, organ, round(p, 6) AS confidence FROM s WHERE rank = 1")
def q83_model_files(spark, sf_dir):
    """The model as files, read from the default folder, since there is none at the path asked for."""
    rows, folder = table(spark, sf_dir, "embeddings"), scratch.folder(spark)
    classes = classify.class_means(rows).select(F.posexplode("classes").alias("idx", "c"))
    classify.save(classes.select("idx", "c.label"), classes.select("idx", "c.w", "c.b"), folder)
    found = classify.predicted(classify.scored(rows, classify.load(spark, f"{folder}-missing", folder)))
    return found.select("vec_id", F.col("predicted_organ").alias("organ"), F.round("confidence", 6).alias("confidence"))


@query(base._PROBE + ", c AS (SELECT organ AS predicted_organ, count(*) AS n FROM s WHERE rank = 1 GROUP BY 1) SELECT predicted_organ, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS pct FROM c ORDER BY n DESC, predicted_organ LIMIT 3")
def q84_most_frequent(spark, sf_dir):
    return base.q02_probe_distribution(spark, sf_dir).limit(3)


@query("WITH m AS (SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) SELECT o_orderkey, (SELECT count(*) FROM m) AS of FROM m ORDER BY 1 LIMIT 5")
def q85_first_missing(spark, sf_dir):
    return matching.first_few(base.q08_resume_anti(spark, sf_dir), "o_orderkey")


@query("""SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'error' WHEN event_id % 13 = 0 THEN 'processing' WHEN event_id % 11 = 0 THEN 'failed_extraction' WHEN event_id % 7 = 0 THEN 'failed_embedding'
WHEN event_id % 5 = 0 THEN 'no_embedding' WHEN event_id % 3 = 0 THEN 'classification_error' ELSE 'success' END AS status FROM events""")
def q86_statuses(spark, sf_dir):
    i = F.col("event_id")
    extracted = F.when(i % 13 != 0, i % 11 != 0)
    return table(spark, sf_dir, "events").select("event_id", tracking.status(extracted, i % 7 != 0, i % 5 != 0, i % 3 != 0, F.when(i % 17 == 0, "raised")).alias("status"))


@query("SELECT event_id, round(epoch_us(ts + INTERVAL (event_id % 90) SECOND) / 1e6 - epoch_us(ts) / 1e6, 6) AS processing_time, true AS stamped FROM events")
def q87_elapsed(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("start_time"), F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 90)").alias("end_time"))
    return tracking.timed(rows).select("event_id", F.round("processing_time", 6).alias("processing_time"), F.col("timestamp").isNotNull().alias("stamped"))


@query("WITH c AS (SELECT user_id, count(*) FILTER (event_type <> 'error') AS good, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY 1) SELECT user_id, (good = 0)::INT AS code, (bad > 0)::INT AS strict FROM c")
def q88_exit_codes(spark, sf_dir):
    bad = F.col("event_type") == "error"
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    return counts.select("user_id", tracking.exit_codes(F.col("good"), F.col("bad")).alias("code"), tracking.exit_codes(F.col("good"), F.col("bad"), strict=True).alias("strict"))


@query("SELECT * FROM (VALUES ('extract', 'success', NULL), ('embed', 'failed', 'ValueError: no tiles'), ('classify', 'skipped', NULL)) t(phase, status, error)")
def q89_phases(spark, sf_dir):
    def embed():
        raise ValueError("no tiles")

    return tracking.run_phases(spark, [("extract", lambda: None), ("embed", embed), ("classify", lambda: None)])


# ---- streams ---------------------------------------------------------------------------------------------------------


@query("SELECT 'S' || s_suppkey AS stem, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END AS run FROM supplier")
def q90_incremental_intake(spark, sf_dir):
    """Two runs over a folder of worklists; the second sees those of the first again, and works on what is new."""
    folder, k = scratch.folder(spark), _key()
    supplier = table(spark, sf_dir, "supplier")
    for run, kept in ((0, k % 2 == 0), (1, k % 3 >= 0)):
        supplier.filter(kept).select(_path(k)).write.mode("append").text(f"{folder}/in")
        work = lambda rows, run=run: rows.select("stem", F.lit(run).alias("run"))
        intake.process_new(intake.worklist_stream(spark, f"{folder}/in"), work, f"{folder}/done", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/done").select("stem", "run")


_RECORDS = "WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, event_id % 50 AS num_patches FROM events) "


def _record_stream(spark, sf_dir):
    folder = scratch.folder(spark)
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"), (F.col("event_id") % 50).alias("num_patches"))
    rows.write.parquet(f"{folder}/in")
    return folder, spark.readStream.schema(rows.schema).parquet(f"{folder}/in")


@query(_RECORDS + "SELECT status, count(*) AS n, sum(num_patches)::BIGINT AS patches FROM r GROUP BY 1")
def q91_running_totals(spark, sf_dir):
    folder, stream = _record_stream(spark, sf_dir)
    name = f"totals_{folder.rsplit('-', 1)[-1]}"
    intake.running_totals(stream, name, once=True).awaitTermination()
    return spark.table(name)


@query(_RECORDS + "SELECT event_id, status, CASE WHEN status = 'success' THEN 'results' ELSE 'errors' END AS file FROM r")
def q93_appended_records(spark, sf_dir):
    folder, stream = _record_stream(spark, sf_dir)
    intake.append_records(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    read = lambda name: spark.read.parquet(f"{folder}/out/{name}").select("event_id", "status", F.lit(name).alias("file"))
    return read("results").unionByName(read("errors"))
