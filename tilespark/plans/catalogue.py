"""All queries on the shared tables, by name, and the SQL that gives the same rows.

The tables hold no slides, so events stand in for pixels: an image of 100 columns for each ten thousand events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import color, paths, resolution
from ..operators import classify, encoder, exclusion, masks, matching, quality, sampling, scatter, tiling, tracking
from .registry import QUERIES, SQL, query, table


# ---- classification --------------------------------------------------------------------------------------------------

_PROBE = """
WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
u AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS v FROM e),
w AS (SELECT label AS organ, i, round(avg(v), 9) AS m FROM u GROUP BY 1, 2),
z AS (SELECT u.vec_id, w.organ::VARCHAR AS organ, round(sum(u.v * w.m), 9) AS z FROM u JOIN w USING (i) GROUP BY 1, 2),
p AS (SELECT vec_id, organ, z, exp(z - max(z) OVER (PARTITION BY vec_id)) AS x FROM z),
s AS (SELECT vec_id, organ, z, x / sum(x) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, organ) AS rank FROM p)
"""


def _scores(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return classify.scored(rows.filter(classify.usable(F.col("embedding"))), classify.class_means(rows))


@query(_PROBE + "SELECT vec_id, rank::INT AS rank, organ, round(p, 6) AS confidence FROM s WHERE rank <= 3")
def q01_probe_top3(spark, sf_dir):
    return classify.top(_scores(spark, sf_dir).select("vec_id", "scores")).select("vec_id", "rank", "organ", F.round("confidence", 6).alias("confidence"))


@query(_PROBE + "SELECT organ AS predicted_organ, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct FROM s WHERE rank = 1 GROUP BY 1")
def q02_probe_distribution(spark, sf_dir):
    return classify.distribution(classify.predicted(_scores(spark, sf_dir)))


@query(_PROBE + "SELECT round(avg(p), 6) AS mean_confidence FROM s WHERE rank = 1")
def q03_probe_mean_confidence(spark, sf_dir):
    return classify.mean_confidence(classify.predicted(_scores(spark, sf_dir)))


@query(_PROBE + "SELECT vec_id, organ, round(p, 6) AS p FROM s")
def q04_probe_probabilities_long(spark, sf_dir):
    return classify.predicted(_scores(spark, sf_dir)).select("vec_id", F.explode("probabilities").alias("organ", "p")).select("vec_id", "organ", F.round("p", 6).alias("p"))


# ---- worklists, names, matching --------------------------------------------------------------------------------------


@query("SELECT doc_id, ntile(10) OVER (ORDER BY doc_id)::INT AS bucket FROM documents")
def q05_worklist_split(spark, sf_dir):
    return sampling.split(table(spark, sf_dir, "documents").select("doc_id"), 10, "doc_id", nulls_last=True).select("doc_id", "bucket")


@query("WITH b AS (SELECT ntile(10) OVER (ORDER BY doc_id)::INT AS bucket FROM documents) SELECT g::INT AS bucket, count(b.bucket) AS n FROM range(1, 13) r(g) LEFT JOIN b ON b.bucket = g GROUP BY 1")
def q06_split_counts(spark, sf_dir):
    return sampling.split_counts(q05_worklist_split(spark, sf_dir), 12)


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS name FROM pages)
SELECT page_id, name, CASE WHEN regexp_matches(name, '^.+\.[^.]*$') THEN regexp_replace(name, '\.[^.]*$', '') ELSE name END AS stem,
       CASE WHEN regexp_matches(name, '^.+\.[^.]*$') THEN regexp_extract(name, '(\.[^.]*)$', 1) ELSE '' END AS ext, regexp_replace(name, '\.[^.]*$', '') AS shell_stem FROM p""")
def q07_path_stem_ext(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", paths.basename(url).alias("name"), paths.stem(url).alias("stem"), paths.extension(url).alias("ext"), paths.shell_stem(url).alias("shell_stem"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def q08_resume_anti(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return matching.resume(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45)")
def q09_worklist_semi(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").filter("l_quantity >= 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return matching.chosen(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), wanted, "o_orderkey")


_NAMES = """WITH s AS (SELECT p_partkey, 'P' || p_partkey AS stem FROM part),
f AS (SELECT CASE p_partkey % 7 WHEN 0 THEN 'P' || p_partkey WHEN 1 THEN 'P' || p_partkey || '_coords' WHEN 2 THEN 'P' || p_partkey || '_patches'
             WHEN 3 THEN 'P' || p_partkey || '_features' WHEN 4 THEN 'P' || p_partkey || '_old' END AS file_stem FROM part WHERE p_partkey % 7 < 5
      UNION SELECT 'P' || p_partkey || '_features' FROM part WHERE p_partkey % 5 = 0),
"""


def _names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    named = F.concat(F.lit("P"), key.cast("string"))
    kinds = {0: "", 1: "_coords", 2: "_patches", 3: "_features", 4: "_old"}
    suffix = reduce(lambda acc, k: acc.when(key % 7 == k, kinds[k]), kinds, F)
    one = part.filter(key % 7 < 5).select(F.concat(named, suffix).alias("file_stem"))
    return part.select("p_partkey", named.alias("stem")), one.union(part.filter(key % 5 == 0).select(F.concat(named, F.lit("_features")))).distinct()


@query(_NAMES + """c AS (SELECT s.p_partkey, f.file_stem, CASE f.file_stem WHEN stem THEN 0 WHEN stem || '_coords' THEN 1 WHEN stem || '_patches' THEN 2 WHEN stem || '_features' THEN 3 ELSE 4 END AS priority
      FROM s JOIN f ON starts_with(f.file_stem, s.stem)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY priority, file_stem) AS k FROM c)
SELECT s.p_partkey, r.file_stem, coalesce(r.priority, -1) AS priority FROM s LEFT JOIN r ON s.p_partkey = r.p_partkey AND r.k = 1""")
def q10_match_priority(spark, sf_dir):
    slides, files = _names(spark, sf_dir)
    return matching.match(slides, files).select("p_partkey", "file_stem", F.coalesce("priority", F.lit(-1)).alias("priority"))


@query(_NAMES + """c AS (SELECT s.p_partkey, f.file_stem, CASE f.file_stem WHEN stem || '_aex' THEN 0 WHEN stem || '_coords' THEN 1 ELSE 2 END AS priority
      FROM s JOIN f ON f.file_stem IN (stem || '_aex', stem || '_coords', stem || '_patches')),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY priority, file_stem) AS k FROM c)
SELECT s.p_partkey, r.file_stem FROM s LEFT JOIN r ON s.p_partkey = r.p_partkey AND r.k = 1""")
def q39_match_batch(spark, sf_dir):
    slides, files = _names(spark, sf_dir)
    return matching.match(slides, files, matching.SUFFIXES_BATCH, prefix=False).select("p_partkey", "file_stem")


@query(_NAMES.rstrip().removesuffix(",") + " SELECT count(*) AS n, count(*) FILTER (s.stem IN (SELECT file_stem FROM f)) AS present, count(*) FILTER (s.stem NOT IN (SELECT file_stem FROM f)) AS missing FROM s")
def q40_flagged_files(spark, sf_dir):
    slides, files = _names(spark, sf_dir)
    return matching.flagged(slides, files.withColumnRenamed("file_stem", "stem"), "stem").agg(F.count("*").alias("n"), F.count_if("present").alias("present"), F.count_if(~F.col("present")).alias("missing"))


# ---- grids and exclusion ---------------------------------------------------------------------------------------------

_SLIDES = "WITH d AS (SELECT p_partkey, p_size * 40 + 100 AS w, (p_retailprice::BIGINT % 900) + 200 AS h FROM part)"


def _slides(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 40 + 100).alias("w"), (F.bround("p_retailprice").cast("long") % 900 + 200).alias("h"))


def _grid_sql(last: str, then: str = "SELECT p_partkey, x, y FROM g") -> str:
    axis = lambda dim: f"CASE WHEN {dim} - 256 - {last} >= 0 THEN range(0, ({dim} - 256 - {last} + 1)::BIGINT, 256) ELSE [] END"
    return _SLIDES.replace("p_retailprice::BIGINT", "round_even(p_retailprice, 0)::BIGINT") + f", a AS (SELECT *, unnest({axis('h')}) AS y FROM d), g AS (SELECT *, unnest({axis('w')}) AS x FROM a) {then}"


@query(_grid_sql("0"))
def q11_tile_grid(spark, sf_dir):
    return tiling.grid(_slides(spark, sf_dir), F.lit(256)).select("p_partkey", "x", "y")


@query(_grid_sql("1"))
def q12_tile_grid_exclusive(spark, sf_dir):
    return tiling.grid(_slides(spark, sf_dir), F.lit(256), exclusive=True).select("p_partkey", "x", "y")


@query(_SLIDES.replace("p_retailprice::BIGINT", "round_even(p_retailprice, 0)::BIGINT") + """,
a AS (SELECT *, unnest(range(0, h, 300)) AS chunk_y FROM d), g AS (SELECT *, unnest(range(0, w, 300)) AS chunk_x FROM a)
SELECT p_partkey, chunk_x, chunk_y, least(300, w - chunk_x)::BIGINT AS chunk_w, least(300, h - chunk_y)::BIGINT AS chunk_h FROM g""")
def q41_chunk_grid(spark, sf_dir):
    return tiling.chunks(_slides(spark, sf_dir), 300).select("p_partkey", "chunk_x", "chunk_y", "chunk_w", "chunk_h")


_XY = "WITH t AS (SELECT event_id, event_id // 10000 AS slide, (event_id % 10000) // 100 AS y, event_id % 100 AS x FROM events)"


def _raster(spark, sf_dir):
    """slide, y, x, r, g, b: blotches of tissue with noise, from the ids of events and users."""
    e, u = F.col("event_id"), F.col("user_id")
    y, x = F.expr("(event_id % 10000) div 100"), e % 100
    out = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.expr("event_id div 10000").alias("slide"), y.alias("y"), x.alias("x"))
    blotch = (F.expr("x div 9") + F.expr("y div 7")) % 3 == 0
    noise = (e * 7 + u * 13) % 29
    return out.select("*", (F.when(blotch, 150).otherwise(235) + noise % 20).alias("r"), F.least(F.lit(255), F.when(blotch, 70).otherwise(232) + noise).alias("g"), (F.when(blotch, 160).otherwise(228) + noise % 27).alias("b"))


_RASTER = """WITH e AS (SELECT event_id, user_id, event_type, value, event_id // 10000 AS slide, (event_id % 10000) // 100 AS y, event_id % 100 AS x, (event_id * 7 + user_id * 13) % 29 AS noise FROM events),
px AS (SELECT *, CASE WHEN (x // 9 + y // 7) % 3 = 0 THEN 150 ELSE 235 END + noise % 20 AS r, least(255, CASE WHEN (x // 9 + y // 7) % 3 = 0 THEN 70 ELSE 232 END + noise) AS g,
              CASE WHEN (x // 9 + y // 7) % 3 = 0 THEN 160 ELSE 228 END + noise % 27 AS b FROM e)"""


@query(_XY + " SELECT event_id FROM t WHERE NOT (x > 80 OR y < 10)")
def q13_exclusion_any(spark, sf_dir):
    return exclusion.exclude(_raster(spark, sf_dir), "x:>:80, Y:<:10 ,z:<:5,y:!:3").select("event_id")


@query(_XY + " SELECT event_id FROM t WHERE NOT (x >= 40 AND y <= 60 AND x <= 90)")
def q14_exclusion_all(spark, sf_dir):
    return exclusion.exclude(_raster(spark, sf_dir), "x:>=:40,y:<=:60,X:<=:90", "all").select("event_id")


_HSV = _RASTER + """, v AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM px),
t AS (SELECT *, CASE WHEN d = 0 THEN 0 WHEN v = r THEN floor((g - b)::DOUBLE / d * 30.0::DOUBLE + 0.5) WHEN v = g THEN floor((2.0::DOUBLE + (b - r)::DOUBLE / d) * 30.0::DOUBLE + 0.5)
                       ELSE floor((4.0::DOUBLE + (r - g)::DOUBLE / d) * 30.0::DOUBLE + 0.5) END AS hh, CASE WHEN v = 0 THEN 0 ELSE floor(255.0::DOUBLE * d / v + 0.5) END AS ss FROM v),
hsv AS (SELECT *, (CASE WHEN hh < 0 THEN hh + 180 ELSE hh END)::INT AS hue, ss::INT AS sat, v::INT AS val FROM t),
m0 AS (SELECT slide, y, x, CASE WHEN hue BETWEEN 90 AND 180 AND sat BETWEEN 8 AND 255 AND val BETWEEN 103 AND 255 THEN 1 ELSE 0 END AS m FROM hsv)"""


def _mask(spark, sf_dir):
    pixels = _raster(spark, sf_dir)
    return pixels.select("slide", "y", "x", color.in_box(color.hsv(F.col("r"), F.col("g"), F.col("b"))).cast("int").alias("m"))


@query(_HSV + " SELECT event_id, hue, sat, val, hue BETWEEN 90 AND 180 AND sat BETWEEN 8 AND 255 AND val BETWEEN 103 AND 255 AS tissue FROM hsv")
def q15_hsv_mask(spark, sf_dir):
    channels = color.hsv(F.col("r"), F.col("g"), F.col("b"))
    return _raster(spark, sf_dir).select("event_id", *(c.alias(n) for c, n in zip(channels, ("hue", "sat", "val"))), color.in_box(channels).alias("tissue"))


def _cross_sql(source: str, target: str, choose: str) -> str:
    return f"""{target}a AS (SELECT slide, y, x, m, {choose}(m, lag(m) OVER r, lead(m) OVER r) AS c FROM {source} WINDOW r AS (PARTITION BY slide, y ORDER BY x)),
{target} AS (SELECT slide, y, x, {choose}(c, lag(m) OVER k, lead(m) OVER k) AS m FROM {target}a WINDOW k AS (PARTITION BY slide, x ORDER BY y))"""


_CLEAN = _HSV + "," + ",".join(_cross_sql(s, t, c) for s, t, c in (("m0", "m1", "least"), ("m1", "m2", "greatest"), ("m2", "m3", "greatest"), ("m3", "m4", "least")))


@query(_CLEAN + " SELECT slide, y, x, m FROM m4")
def q16_mask_open_close(spark, sf_dir):
    return masks.clean(_mask(spark, sf_dir))


_EDGE = 10


def _tile_sql(tail: str, edge: int = _EDGE, step: int = 5) -> str:
    return _CLEAN + f""", o AS (SELECT slide, max(y) + 1 AS h, max(x) + 1 AS w FROM m4 GROUP BY 1),
a AS (SELECT *, unnest(CASE WHEN h >= {edge} THEN range(0, h - {edge} + 1, {step}) ELSE [] END) AS ty FROM o), g AS (SELECT *, unnest(CASE WHEN w >= {edge} THEN range(0, w - {edge} + 1, {step}) ELSE [] END) AS tx FROM a),
tiles AS (SELECT g.slide, tx AS x, ty AS y, any_value(g.w) AS w, any_value(g.h) AS h, sum(m)::DOUBLE / {edge * edge} AS pct
          FROM g JOIN m4 ON m4.slide = g.slide AND m4.x >= tx AND m4.x < tx + {edge} AND m4.y >= ty AND m4.y < ty + {edge} GROUP BY 1, 2, 3)
{tail}"""


def _tiles(spark, sf_dir):
    cells = _mask(spark, sf_dir)
    mask, sizes = masks.clean(cells), cells.groupBy("slide").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return masks.region_means(tiling.grid(sizes, F.lit(_EDGE), F.lit(5)), mask, _EDGE)


@query(_tile_sql("SELECT slide, x, y, round(pct, 6) AS pct FROM tiles"))
def q17_tile_tissue_pct(spark, sf_dir):
    return _tiles(spark, sf_dir).select("slide", "x", "y", F.round("pct", 6).alias("pct"))


@query(_tile_sql(f"SELECT slide, x, y FROM tiles WHERE pct >= 0.25 AND x + {_EDGE} <= w AND y + {_EDGE} <= h"))
def q18_tile_filter_inclusive(spark, sf_dir):
    size = F.lit(_EDGE)
    return _tiles(spark, sf_dir).filter(masks.enough_tissue(0.25) & tiling.fits(F.col("x"), size, F.col("w"), True) & tiling.fits(F.col("y"), size, F.col("h"), True)).select("slide", "x", "y")


@query(_tile_sql(f"SELECT slide, x, y FROM tiles WHERE pct > 0.25 AND x + {_EDGE} < w AND y + {_EDGE} < h"))
def q19_tile_filter_exclusive(spark, sf_dir):
    size = F.lit(_EDGE)
    return _tiles(spark, sf_dir).filter(masks.enough_tissue(0.25, strict=True) & tiling.fits(F.col("x"), size, F.col("w"), False) & tiling.fits(F.col("y"), size, F.col("h"), False)).select("slide", "x", "y")


@query(_tile_sql("SELECT slide, x, y, CASE WHEN pct >= 0.5 THEN 'green' WHEN pct >= 0.25 THEN 'yellow' ELSE 'red' END AS colour FROM tiles"))
def q42_overlay_bucket(spark, sf_dir):
    return _tiles(spark, sf_dir).select("slide", "x", "y", color.share_bucket(F.col("pct"), 0.25).alias("colour"))


@query(_RASTER + ", s AS (SELECT slide, x // 20 AS kx, y // 20 AS ky, avg(CASE WHEN (r + g + b) / 3.0 < 240 THEN 1 ELSE 0 END) AS pct FROM px GROUP BY 1, 2, 3) SELECT slide, kx, ky, round(pct, 6) AS pct FROM s WHERE pct > 0.3")
def q43_tile_share(spark, sf_dir):
    pixels = _raster(spark, sf_dir).withColumns({"kx": F.expr("x div 20"), "ky": F.expr("y div 20")})
    shares = masks.tile_share(pixels, color.is_dark(F.col("r"), F.col("g"), F.col("b")), "slide", "kx", "ky")
    return shares.filter(masks.enough_tissue(0.3, strict=True)).select("slide", "kx", "ky", F.round("pct", 6).alias("pct"))


# ---- limits and samples ----------------------------------------------------------------------------------------------


@query(_XY + ", r AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY md5(slide || ':' || event_id), slide, event_id) AS k FROM t) SELECT slide, event_id FROM r WHERE k <= 50")
def q20_sample_n_md5(spark, sf_dir):
    return sampling.sample(_raster(spark, sf_dir), 50, ["slide", "event_id"], "slide").select("slide", "event_id")


@query(_XY + ", r AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY y, x) AS k FROM t) SELECT slide, event_id FROM r WHERE k <= 130")
def q21_head_n_rowmajor(spark, sf_dir):
    return sampling.head(_raster(spark, sf_dir), 130, "slide").select("slide", "event_id")


@query("WITH f AS (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 500) SELECT o_orderkey FROM f WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def q22_limit_then_filter(spark, sf_dir):
    first = table(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey").limit(500)
    wanted = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return matching.chosen(first, wanted, "o_orderkey")


@query(_XY + """, d AS (SELECT *, md5(slide || ':' || x || ':' || y) AS h, x // 4 AS kx, y // 4 AS ky FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY slide, kx, ky ORDER BY h, y, x) AS k FROM d), s AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY h, y, x) AS n FROM r WHERE k = 1)
SELECT slide, x, y FROM s WHERE n <= 100""")
def q44_random_tiles(spark, sf_dir):
    return sampling.random_tiles(_raster(spark, sf_dir), 100, 16, "slide").select("slide", "x", "y")


# ---- colours ---------------------------------------------------------------------------------------------------------

_MODES = """, g AS (SELECT slide, g AS c, count(*) AS n FROM px WHERE x % 3 = 0 AND y % 3 = 0 GROUP BY 1, 2), b AS (SELECT slide, b AS c, count(*) AS n FROM px WHERE x % 3 = 0 AND y % 3 = 0 GROUP BY 1, 2),
gm AS (SELECT slide, c AS g_modal FROM (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY n DESC, c) AS k FROM g) WHERE k = 1),
bm AS (SELECT slide, c AS b_modal FROM (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY n DESC, c) AS k FROM b) WHERE k = 1)"""


@query(_RASTER + _MODES + " SELECT slide, g_modal, b_modal FROM gm JOIN bm USING (slide)")
def q23_channel_mode(spark, sf_dir):
    return quality.modes(quality.strided(_raster(spark, sf_dir), 3), "slide")


@query(_RASTER + _MODES + ", c AS (SELECT slide, g_modal < 220 OR b_modal < 220 AS bad FROM gm JOIN bm USING (slide)) SELECT count(*) AS files, count(*) FILTER (bad) AS bad, round(100.0::DOUBLE * count(*) FILTER (bad) / greatest(count(*), 1), 1) AS pct FROM c")
def q24_needs_correction(spark, sf_dir):
    return quality.totals(q23_channel_mode(spark, sf_dir).withColumn("needs_correction", quality.needs_correction()))


# ---- resolution ------------------------------------------------------------------------------------------------------

_MPP = "WITH m AS (SELECT p_partkey, p_size, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size / 50.0::DOUBLE END AS mpp FROM part)"


def _mpps(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", F.when(F.col("p_size") % 9 != 0, F.col("p_size") / F.lit(50.0)).alias("mpp"))


@query(_MPP + """ SELECT p_partkey, CASE WHEN mpp IS NULL OR mpp = 0 THEN NULL WHEN mpp BETWEEN 0.23 AND 0.27 THEN '40x' WHEN mpp BETWEEN 0.48 AND 0.52 THEN '20x' WHEN mpp BETWEEN 0.18 AND 0.22 THEN '60x'
WHEN mpp BETWEEN 0.35 AND 0.40 THEN '25x' ELSE '~' || trunc(10.0::DOUBLE / mpp)::INT || 'x' END AS magnification FROM m""")
def q25_magnification_label(spark, sf_dir):
    return _mpps(spark, sf_dir).select("p_partkey", resolution.magnification(F.col("mpp")).alias("magnification"))


@query(_MPP + " SELECT p_partkey, CASE WHEN mpp IS NULL THEN 512 WHEN mpp BETWEEN 0.23 AND 0.27 THEN 1024 WHEN mpp BETWEEN 0.48 AND 0.52 THEN 512 WHEN mpp < 0.35 THEN 1024 ELSE 512 END AS patch_size FROM m")
def q26_patch_size_bucket(spark, sf_dir):
    return _mpps(spark, sf_dir).select("p_partkey", resolution.patch_size(F.col("mpp")).alias("patch_size"))


@query(_MPP + """ SELECT p_partkey, (CASE WHEN mpp > 0 THEN ceil(512 * (0.5::DOUBLE / mpp)) ELSE 512 END)::BIGINT AS size, (CASE WHEN mpp > 0 THEN ceil(512 * (0.5::DOUBLE / mpp)) ELSE 512 END)::BIGINT AS same_step,
(CASE WHEN mpp > 0 THEN ceil(256 * (0.5::DOUBLE / mpp)) ELSE 256 END)::BIGINT AS own_step FROM m""")
def q27_patch_scale_to_mpp(spark, sf_dir):
    m, size = F.col("mpp"), F.lit(512)
    return _mpps(spark, sf_dir).select("p_partkey", resolution.scaled_size(size, m, 0.5).alias("size"), resolution.scaled_step(size, size, m, 0.5).alias("same_step"), resolution.scaled_step(F.lit(256), size, m, 0.5).alias("own_step"))


_PROPS = """WITH k AS (SELECT event_id, (props::JSON->>'$.k')::INT AS k FROM events),
p AS (SELECT event_id, CASE WHEN k % 4 = 0 THEN k / 100.0::DOUBLE END AS vendor, CASE WHEN k % 3 = 0 THEN k / 200.0::DOUBLE END AS px, CASE WHEN k % 2 = 0 THEN k / 50.0::DOUBLE END AS py FROM k)"""


def _props(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    entry = lambda key, every, scale: F.when(k % every == 0, F.struct(F.lit(key).alias("key"), (k / F.lit(scale)).cast("string").alias("value")))
    entries = F.array_compact(F.array(entry("aperio.MPP", 4, 100.0), entry("openslide.mpp-x", 3, 200.0), entry("openslide.mpp-y", 2, 50.0)))
    return table(spark, sf_dir, "events").select("event_id", F.map_from_entries(entries).alias("p"))


@query(_PROPS + """ SELECT event_id, round(coalesce(vendor, (px + py) / 2), 9) AS mpp,
round(coalesce((nullif(px, 0) + nullif(py, 0)) / 2, nullif(px, 0), nullif(py, 0), nullif(vendor, 0)), 9) AS lenient FROM p""")
def q35_mpp_coalesce(spark, sf_dir):
    return _props(spark, sf_dir).select("event_id", F.round(resolution.mpp(F.col("p")), 9).alias("mpp"), F.round(resolution.mpp_of_any(F.col("p")), 9).alias("lenient"))


# ---- scatter ---------------------------------------------------------------------------------------------------------

_PLACED = """WITH e AS (SELECT vec_id, label AS slide, (vec_id * 37) % 500 + 20 AS x, (vec_id * 53) % 400 + 10 AS y, embedding FROM embeddings),
c AS (SELECT *, (x - min(x) OVER (PARTITION BY slide)) // 64 AS row, (y - min(y) OVER (PARTITION BY slide)) // 64 AS col FROM e),
u AS (SELECT slide, row, col, x, y, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM c),
g AS (SELECT slide, row, col, i, round(sum(v), 4) + 0.0::DOUBLE AS v, sum(x)::BIGINT AS sx, sum(y)::BIGINT AS sy FROM u GROUP BY 1, 2, 3, 4)"""


def _placed(spark, sf_dir):
    v = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("slide"), (v * 37 % 500 + 20).alias("x"), (v * 53 % 400 + 10).alias("y"), F.col("embedding").alias("f"))
    return scatter.cells(rows, 64)


@query(_PLACED + " SELECT slide, row, col, i, v, sx, sy FROM g")
def q28_grid_scatter_add(spark, sf_dir):
    return scatter.scatter_add(_placed(spark, sf_dir), digits=4).select("slide", "row", "col", F.posexplode("f").alias("i", "v"), "sx", "sy").select("slide", "row", "col", F.col("i").cast("long").alias("i"), "v", "sx", "sy")


@query(_PLACED + """, s AS (SELECT slide, max(row) + 1 AS nr, max(col) + 1 AS nc FROM g GROUP BY 1), a AS (SELECT *, unnest(range(nr)) AS row FROM s), d AS (SELECT *, unnest(range(nc)) AS col FROM a),
f AS (SELECT slide, row, col, bool_or(v <> 0) AS filled FROM g GROUP BY 1, 2, 3) SELECT d.slide, d.row, d.col, coalesce(f.filled, false) AS filled FROM d LEFT JOIN f USING (slide, row, col)""")
def q29_background_mask(spark, sf_dir):
    return scatter.dense(scatter.scatter_add(_placed(spark, sf_dir), digits=4)).select("slide", "row", "col", "filled")


# ---- run records -----------------------------------------------------------------------------------------------------

_STATS = """WITH w AS (SELECT user_id AS worker_id, count(value) AS files, round_even(round(avg(value), 6), 1) AS mean_time, round_even(round(sum(value), 6), 1) AS total_time, round_even(max(value), 1) AS max_time,
sum(event_id % 50)::BIGINT AS patches FROM events GROUP BY 1)"""


def _stats(spark, sf_dir):
    return tracking.worker_stats(table(spark, sf_dir, "events").select(F.col("user_id").alias("worker_id"), F.col("value").alias("processing_time"), (F.col("event_id") % 50).alias("num_patches")))


@query(_STATS + " SELECT * FROM w")
def q30_worker_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query(_STATS + ", i AS (SELECT round(CASE WHEN min(total_time) <> 0 THEN (max(total_time) - min(total_time)) * 100 / min(total_time) END, 4) AS imbalance FROM w) SELECT imbalance, coalesce(imbalance > 20, false) AS alert FROM i")
def q31_worker_imbalance(spark, sf_dir):
    return tracking.imbalance(_stats(spark, sf_dir))


@query("SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, count(*) AS n FROM events GROUP BY 1")
def q32_batch_counters(spark, sf_dir):
    return tracking.counters(table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status")))


@query("""WITH l AS (SELECT l_orderkey, max(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN n IS NULL THEN 'failed_extraction' WHEN NOT q >= 20 THEN 'failed_embedding' WHEN o_orderstatus = 'P' THEN 'classification_error' ELSE 'success' END AS status FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def q33_status_outcome(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("q"), F.count("*").alias("n"))
    joined = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    flags = joined.select("o_orderkey", F.col("n").isNotNull().alias("a"), (F.col("q") >= 20).alias("b"), (F.col("o_orderstatus") != "P").alias("c"))
    return flags.select("o_orderkey", tracking.outcome("a", "b", "c").alias("status"))


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value, 6) END AS processing_time, CASE WHEN event_type = 'error' THEN props END AS error, CASE WHEN event_type = 'error' THEN 'failed' END AS status FROM events")
def q34_success_error_union(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    good = events.filter("event_type <> 'error'").select("event_id", F.round("value", 6).alias("processing_time"))
    bad = events.filter("event_type = 'error'").select("event_id", F.col("props").alias("error"), F.lit("failed").alias("status"))
    return tracking.outcomes(good, bad)


@query(_XY + " SELECT slide, x // 4 AS kx, y // 4 AS ky, count(*) AS n FROM t GROUP BY 1, 2, 3")
def q36_duplicate_region_key(spark, sf_dir):
    key = tiling.region_key(F.col("x"), F.col("y"), F.lit(16))
    return _raster(spark, sf_dir).select("slide", key.alias("k")).groupBy("slide", "k.kx", "k.ky").agg(F.count("*").alias("n"))


@query(_RASTER + " SELECT event_id, round((r / 255.0::DOUBLE - 0.485::DOUBLE) / 0.229::DOUBLE, 6) AS r, round((g / 255.0::DOUBLE - 0.456::DOUBLE) / 0.224::DOUBLE, 6) AS g, round((b / 255.0::DOUBLE - 0.406::DOUBLE) / 0.225::DOUBLE, 6) AS b FROM px")
def q37_normalise_channels(spark, sf_dir):
    scale = {"r": (0.485, 0.229), "g": (0.456, 0.224), "b": (0.406, 0.225)}
    return _raster(spark, sf_dir).select("event_id", *(F.round(color.normalised(F.col(c), *s), 6).alias(c) for c, s in scale.items()))


@query("WITH u AS (SELECT label AS slide, vec_id, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) SELECT slide, i, round(avg(v), 6) AS v, count(*) AS num_patches FROM u GROUP BY 1, 2")
def q38_udf_mean_pool(spark, sf_dir):
    tiles = _placed(spark, sf_dir).select(F.col("slide").cast("long").alias("slide"), "x", "y", "f")
    return encoder.pool(tiles, digits=6).select(F.col("slide").cast("int").alias("slide"), F.posexplode("embedding").alias("i", "v"), "num_patches").select("slide", F.col("i").cast("long").alias("i"), "v", "num_patches")


@query(SQL["q38_udf_mean_pool"])
def q92_mean_pool(spark, sf_dir):
    return encoder.pool_means(_placed(spark, sf_dir), digits=6).select(F.col("slide").cast("int").alias("slide"), F.posexplode("embedding").alias("i", "v"), "num_patches").select("slide", F.col("i").cast("long").alias("i"), "v", "num_patches")


@query("""WITH t AS (SELECT event_type AS step, round(sum(value), 3) AS seconds FROM events GROUP BY 1) SELECT step, seconds, round(100.0::DOUBLE * seconds / sum(seconds) OVER (), 1) AS pct FROM t""")
def q45_timing_shares(spark, sf_dir):
    return tracking.shares(table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("step")).agg(F.round(F.sum("value"), 3).alias("seconds")))


@query("""SELECT count(*) FILTER (event_type <> 'error') AS success, sum(event_id % 50) FILTER (event_type <> 'error')::BIGINT AS total_patches, round(avg(event_id % 50) FILTER (event_type <> 'error'), 6) AS avg_patches,
count(*) FILTER (event_type = 'error') AS errors, count(*) / 60.0::DOUBLE AS files_per_s FROM events""")
def q46_batch_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", (F.col("event_id") % 50).alias("num_patches"))
    return tracking.summary(rows.filter("event_type <> 'error'"), rows.filter("event_type = 'error'"), 60.0).withColumn("avg_patches", F.round("avg_patches", 6))


@query(_XY + " SELECT event_id, floor(x / 7.5::DOUBLE)::BIGINT AS det_x, floor(floor(x / 7.5::DOUBLE) * 7.5::DOUBLE)::BIGINT AS level_x FROM t")
def q47_coordinate_spaces(spark, sf_dir):
    det = tiling.to_mask(F.col("x"), 7.5)
    return _raster(spark, sf_dir).select("event_id", det.alias("det_x"), tiling.from_mask(det, 7.5).alias("level_x"))


@query(r"SELECT page_id, try_cast(nullif(regexp_extract('extracted ' || page_id || ' patches from ' || url, '(\d+) patches', 1), '') AS INT) AS patches, CASE WHEN page_id % 3 = 0 THEN 'skipped' WHEN page_id % 5 = 0 THEN 'failed' ELSE 'success' END AS status FROM pages")
def q48_output_parsing(spark, sf_dir):
    i = F.col("page_id")
    said = F.concat(F.lit("extracted "), i.cast("string"), F.lit(" patches from "), F.col("url"), F.when(i % 3 == 0, " already exists, skipping").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", tracking.patches_in(said).alias("patches"), tracking.inferred_status(said, F.when((i % 5 == 0) & (i % 3 != 0), 1).otherwise(0)).alias("status"))


@query("SELECT page_id, replace(regexp_extract(url, '([^/]+)/*$', 1) || '_vec_vec', '_vec', '') AS name, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS relative FROM pages")
def q49_result_names(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", paths.result_name(F.concat(paths.basename(url), F.lit("_vec_vec")), "_vec").alias("name"), paths.strip_prefix(url, "https://").alias("relative"))


from . import file_queries  # noqa: E402, F401  registers its queries too
