"""Registered queries over the driver's tables, one per operator or family of operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import compare, dataflow, dataset, detection, raster, spatial
from ..session import ship, spread, table
from ..sources import adapters as A
from ..streaming import detections
from . import oracle_views as V
from .registry import ORACLES, QUERIES, query  # noqa: F401
from .registry import with_views as _with

_R = "round({0}, 3) + 0.0 AS {1}"
_IOU = """CASE WHEN (a.y2 - a.y1) * (a.x2 - a.x1) + (b.y2 - b.y1) * (b.x2 - b.x1)
 - greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) * greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) > 0
 THEN greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) * greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0)
 / ((a.y2 - a.y1) * (a.x2 - a.x1) + (b.y2 - b.y1) * (b.x2 - b.x1)
 - greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) * greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0)) ELSE 0 END"""


def r3(c, name: str):
    return (F.round(c, 3) + F.lit(0.0)).alias(name)


# Geometry.
_RING_SQL = """edges AS (SELECT image, k, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS qx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS qy
 FROM vertices WINDOW w AS (PARTITION BY image ORDER BY k)),
 sums AS (SELECT image, count(*) AS n, sum(x * qy - qx * y) AS t, sum(sqrt((qx - x) * (qx - x) + (qy - y) * (qy - y))) AS p,
 sum((x + qx) * (x * qy - qx * y)) AS sx, sum((y + qy) * (x * qy - qx * y)) AS sy FROM edges GROUP BY image)"""


@query("polygon_area_perimeter", _with(V.VERTICES, _RING_SQL) + "SELECT image, CAST(n AS INT) AS vertices, round(abs(t) / 2, 3) + 0.0 AS area, round(p, 3) + 0.0 AS perimeter FROM sums")
def polygon_area_perimeter(spark, sf_dir):
    m = spatial.measure(A.vertices(spark, sf_dir), ["image"])
    return m.select("image", "vertices", r3(F.col("area"), "area"), r3(F.col("perimeter"), "perimeter"))


@query("polygon_centroid", _with(V.VERTICES, _RING_SQL) + "SELECT image, CASE WHEN abs(t) > 0.001 THEN round(sx / (t * 3), 2) + 0.0 END AS centroid_x, CASE WHEN abs(t) > 0.001 THEN round(sy / (t * 3), 2) + 0.0 END AS centroid_y FROM sums")
def polygon_centroid(spark, sf_dir):
    """Null for rings without area."""
    m = spatial.measure(A.vertices(spark, sf_dir), ["image"])
    return m.select("image", *[(F.round(F.col(c), 2) + F.lit(0.0)).alias(c) for c in ("centroid_x", "centroid_y")])


# Scene names.
@query("scene_fields", _with(V.SCENES) + """SELECT image, split_part(path, '/', -1) AS file, split_part(split_part(path, '/', -1), '.tif', 1) AS image_name,
 split_part(split_part(path, '/', -1), '.', 1) AS short_name, substr(split_part(path, '/', -1), 1, 4) AS sensor, substr(split_part(path, '/', -1), 6, 8) AS date,
 substr(split_part(path, '/', -1), 14, 6) AS time, substr(split_part(path, '/', -1), 21, 16) AS catalog_id, path LIKE '%.tif' AS is_tif, CAST(split_part(path, '/', 4) AS VARCHAR) AS folder FROM scenes""")
def scene_fields(spark, sf_dir):
    s = A.scenes(spark, sf_dir).withColumn("file", F.element_at(F.split("path", "/"), -1))
    return s.select(
        "image", "file", F.substring_index("file", ".tif", 1).alias("image_name"), F.substring_index("file", ".", 1).alias("short_name"),
        *[F.substring("file", a, n).alias(c) for c, a, n in (("sensor", 1, 4), ("date", 6, 8), ("time", 14, 6), ("catalog_id", 21, 16))],
        F.col("path").endswith(".tif").alias("is_tif"), F.element_at(F.split("path", "/"), 4).alias("folder"),
    )


# Fixed values in the query and its SQL: the patterns of a checkpoint's name and of the layers that heads have.
@query("checkpoint_names", """SELECT image, regexp_extract(name, '^mask_rcnn_(\\w+)_(\\d{4})\\.h5$', 1) AS run, CAST(regexp_extract(name, '^mask_rcnn_(\\w+)_(\\d{4})\\.h5$', 2) AS INT) AS epoch,
 regexp_full_match(layer, '(mrcnn\\_.*)|(rpn\\_.*)|(fpn\\_.*)') AS is_head FROM (SELECT o_orderkey AS image, 'mask_rcnn_run' || (o_orderkey % 7) || '_' || lpad(CAST(o_orderkey % 40 AS VARCHAR), 4, '0') || '.h5' AS name,
 CASE o_orderkey % 4 WHEN 0 THEN 'rpn_' WHEN 1 THEN 'res_' WHEN 2 THEN 'mrcnn_' ELSE 'xfpn_' END || 'conv' AS layer FROM orders)""")
def checkpoint_names(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("mask_rcnn_run"), (k % 7).cast("string"), F.lit("_"), F.lpad((k % 40).cast("string"), 4, "0"), F.lit(".h5"))
    layer = F.concat(F.when(k % 4 == 0, "rpn_").when(k % 4 == 1, "res_").when(k % 4 == 2, "mrcnn_").otherwise("xfpn_"), F.lit("conv"))
    pattern = r"^mask_rcnn_(\w+)_(\d{4})\.h5$"
    return table(spark, sf_dir, "orders").select(
        k.alias("image"), F.regexp_extract(name, pattern, 1).alias("run"), F.regexp_extract(name, pattern, 2).cast("int").alias("epoch"),
        layer.rlike(r"^((mrcnn\_.*)|(rpn\_.*)|(fpn\_.*))$").alias("is_head"),
    )


# Boxes.
@query("box_deltas", _with(V.BOXES) + """, d AS (SELECT *, score / 10 AS dy, -score / 20 AS dx, score / 5 AS dh, -score / 4 AS dw, y2 - y1 AS h, x2 - x1 AS w FROM boxes),
 e AS (SELECT *, y1 + h * 0.5 + dy * h AS cy, x1 + w * 0.5 + dx * w AS cx, h * exp(dh) AS nh, w * exp(dw) AS nw FROM d)
 SELECT image, box, round((y2 - y1) * (x2 - x1), 3) + 0.0 AS area, round(least(greatest(cy - nh / 2, 0), 64), 3) + 0.0 AS y1, round(least(greatest(cx - nw / 2, 0), 48), 3) + 0.0 AS x1,
 round(least(greatest(cy + nh / 2, 0), 64), 3) + 0.0 AS y2, round(least(greatest(cx + nw / 2, 0), 48), 3) + 0.0 AS x2, round(dy, 3) + 0.0 AS back_dy, round(dw, 3) + 0.0 AS back_dw FROM e""")
def box_deltas(spark, sf_dir):
    s = F.col("score")
    b = A.boxes(spark, sf_dir)
    moved = B.apply_deltas(B.box(), (s / 10, -s / 20, s / 5, -s / 4))
    back = B.refinement(B.box(), moved)
    cut = B.clip(moved, tuple(map(F.lit, (0.0, 0.0, 64.0, 48.0))))
    return b.select("image", "box", r3(B.area(B.box()), "area"), *[r3(c, n) for c, n in zip(cut, detection.BOX)], r3(back[0], "back_dy"), r3(back[3], "back_dw"))


@query("box_normalise", _with(V.BOXES) + """SELECT image, box, round(y1 / 127, 6) AS ny1, round(x1 / 63, 6) AS nx1, round((y2 - 1) / 127, 6) AS ny2, round((x2 - 1) / 63, 6) AS nx2,
 CAST(y1 AS INT) AS py1, CAST(x1 AS INT) AS px1, CAST(y2 AS INT) AS py2, CAST(x2 AS INT) AS px2,
 CAST(least(5, greatest(2, 4 + CAST(round_even(log2(sqrt((y2 - 1 - y1) / 127 * ((x2 - 1 - x1) / 63)) / (224.0 / sqrt(8192.0))), 0) AS INT))) AS INT) AS level FROM boxes""")
def box_normalise(spark, sf_dir):
    n = B.normalise(B.box(), F.lit(128), F.lit(64))
    back = B.denormalise(n, F.lit(128), F.lit(64))
    names = ("y1", "x1", "y2", "x2")
    return A.boxes(spark, sf_dir).select(
        "image", "box", *[F.round(c, 6).alias("n" + k) for c, k in zip(n, names)], *[c.alias("p" + k) for c, k in zip(back, names)], B.pyramid_level(n, F.lit(8192.0)).alias("level")
    )


@query("anchors", """WITH levels AS (SELECT * FROM (VALUES (0, 32.0, 8), (1, 64.0, 16), (2, 128.0, 32)) t(level, scale, stride)), ratios AS (SELECT unnest([0.5, 1.0, 2.0]) AS ratio),
 grid AS (SELECT level, scale, stride, ratio, unnest(range(0, 256 // stride)) AS gy FROM levels, ratios), full_ AS (SELECT *, unnest(range(0, 256 // stride)) AS gx FROM grid)
 SELECT level, ratio, gy * stride AS cy, gx * stride AS cx, round(gy * stride - scale / sqrt(ratio) / 2, 3) + 0.0 AS y1, round(gx * stride - scale * sqrt(ratio) / 2, 3) + 0.0 AS x1,
 round(gy * stride + scale / sqrt(ratio) / 2, 3) + 0.0 AS y2, round(gx * stride + scale * sqrt(ratio) / 2, 3) + 0.0 AS x2 FROM full_""")
def anchors(spark, sf_dir):
    """A generated table: levels x ratios x grid places, unioned over the levels."""
    levels = spark.createDataFrame([(0, 32.0, 8), (1, 64.0, 16), (2, 128.0, 32)], "level int, scale double, stride int")
    side = F.sequence(F.lit(0), F.ceil(F.lit(256) / F.col("stride")).cast("int") - 1)
    g = levels.withColumn("ratio", F.explode(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0)))).withColumn("gy", F.explode(side)).withColumn("gx", F.explode(side))
    cy, cx = (F.col("gy") * F.col("stride")).cast("long"), (F.col("gx") * F.col("stride")).cast("long")
    h, w = F.col("scale") / F.sqrt("ratio"), F.col("scale") * F.sqrt("ratio")
    return g.select("level", "ratio", cy.alias("cy"), cx.alias("cx"), r3(cy - h / 2, "y1"), r3(cx - w / 2, "x1"), r3(cy + h / 2, "y2"), r3(cx + w / 2, "x2"))


# Tiles.
_TILES = """tiles AS (SELECT image, ty, tx, ty // 160 AS id_i, tx // 160 AS id_j, least(200, height - ty) AS h, least(200, width - tx) AS w, height, width
 FROM (SELECT *, unnest(range(0, width, 160)) AS tx FROM (SELECT *, unnest(range(0, height, 160)) AS ty FROM scenes)))"""


@query("tile_grid", _with(V.SCENES, _TILES) + """SELECT image, CAST(id_i AS INT) AS id_i, CAST(id_j AS INT) AS id_j, CAST(h AS INT) AS h, CAST(w AS INT) AS w, round(1000.5 + ty * -0.5, 3) AS ul_row, round(-2000.25 + tx * 0.5, 3) AS ul_col FROM tiles""")
def tile_grid(spark, sf_dir):
    t = dataflow.tiles(A.scenes(spark, sf_dir))
    return t.select("image", "id_i", "id_j", "h", "w", F.round(1000.5 + F.col("ty") * -0.5, 3).alias("ul_row"), F.round(-2000.25 + F.col("tx") * 0.5, 3).alias("ul_col"))


@query("tile_filter_number", _with(V.SCENES, _TILES) + """, corners AS (SELECT *, (image + ty) % 3 * ((image + tx) % 2) AS c00, (image + ty) % 3 * ((image + tx + w) % 2) AS c0n, (image + ty + h) % 3 * ((image + tx) % 2) AS cn0, (image + ty + h) % 3 * ((image + tx + w) % 2) AS cnn FROM tiles)
 SELECT image, CAST(id_i AS INT) AS id_i, CAST(id_j AS INT) AS id_j, CAST(row_number() OVER (PARTITION BY image ORDER BY id_i, id_j) - 1 AS INT) AS tile_num FROM corners WHERE NOT (c00 = 0 AND c0n = 0 AND cn0 = 0 AND cnn = 0)""")
def tile_filter_number(spark, sf_dir):
    """Black tiles (all four corners 0) go; the others are numbered in order afterwards."""
    t = dataflow.tiles(A.scenes(spark, sf_dir))
    value = lambda y, x: ((F.col("image") + y) % 3) * ((F.col("image") + x) % 2)
    y, x, h, w = (F.col(c) for c in ("ty", "tx", "h", "w"))
    black = (value(y, x) == 0) & (value(y, x + w) == 0) & (value(y + h, x) == 0) & (value(y + h, x + w) == 0)
    nth = F.row_number().over(Window.partitionBy("image").orderBy("id_i", "id_j")) - 1
    return t.filter(~black).select("image", "id_i", "id_j", nth.alias("tile_num"))


@query("backbone_shapes", _with(V.SCENES) + "SELECT image, CAST(s AS INT) AS stride, CAST(ceil(height / s) AS INT) AS h, CAST(ceil(width / s) AS INT) AS w FROM (SELECT *, unnest([4.0, 8.0, 16.0, 32.0, 64.0]) AS s FROM scenes)")
def backbone_shapes(spark, sf_dir):
    s = A.scenes(spark, sf_dir).withColumn("stride", F.explode(F.array(*map(F.lit, (4, 8, 16, 32, 64)))))
    return s.select("image", "stride", F.ceil(F.col("height") / F.col("stride")).cast("int").alias("h"), F.ceil(F.col("width") / F.col("stride")).cast("int").alias("w"))


# Pixels.
@query("mask_multiply", _with(V.PIXELS) + "SELECT image, r, c, CASE WHEN v / 255.0 > 0.5 THEN v ELSE 0 END AS v, v / 255.0 > 0.5 AS land FROM pixels")
def mask_multiply(spark, sf_dir):
    land = F.col("v") / 255.0 > 0.5
    return A.pixels(spark, sf_dir).select("image", "r", "c", F.when(land, F.col("v")).otherwise(0).alias("v"), land.alias("land"))


@query("contrast_stretch", _with(V.PIXELS) + """SELECT p.image, r, c, CAST(CASE WHEN hi > lo THEN round_even((v - lo) * 255 / (hi - lo), 0) ELSE 0 END AS INT) AS v FROM pixels p
 JOIN (SELECT image, min(v) AS lo, max(v) AS hi FROM pixels GROUP BY image) e ON p.image = e.image""")
def contrast_stretch(spark, sf_dir):
    return raster.stretch(A.pixels(spark, sf_dir))


_HIST = """h AS (SELECT image, v, count(*) AS n FROM pixels GROUP BY image, v), cd AS (SELECT *, sum(n) OVER (PARTITION BY image ORDER BY v) AS cdf, sum(n) OVER (PARTITION BY image) AS total FROM h)"""


@query("histogram_equalise", _with(V.PIXELS, _HIST) + """, lut AS (SELECT image, v, CASE WHEN total > n0 THEN round_even((cdf - n0) * 255 / (total - n0), 0) ELSE v END AS e FROM (SELECT *, first_value(n) OVER (PARTITION BY image ORDER BY v) AS n0 FROM cd))
 SELECT p.image, r, c, CAST(e AS INT) AS v FROM pixels p JOIN lut USING (image, v)""")
def histogram_equalise(spark, sf_dir):
    return raster.equalise(A.pixels(spark, sf_dir))


@query("otsu_threshold", _with(V.PIXELS, _HIST) + """, s AS (SELECT *, sum(n * v) OVER (PARTITION BY image ORDER BY v) AS sv, sum(n * v) OVER (PARTITION BY image) AS tv FROM cd),
 b AS (SELECT image, v, round(cdf * (total - cdf) * (sv / cdf - (tv - sv) / (total - cdf)) * (sv / cdf - (tv - sv) / (total - cdf)) / (total * total), 6) AS between_ FROM s WHERE cdf < total)
 SELECT i.image, coalesce(t.v, 0) AS threshold FROM (SELECT DISTINCT image FROM pixels) i LEFT JOIN (SELECT image, v FROM b QUALIFY row_number() OVER (PARTITION BY image ORDER BY between_ DESC, v) = 1) t ON i.image = t.image""")
def otsu_threshold(spark, sf_dir):
    return raster.otsu(A.pixels(spark, sf_dir))


@query("mask_bounding_box", _with(V.PIXELS) + """SELECT image, coalesce(min(r) FILTER (v > 180), 0) AS y1, coalesce(min(c) FILTER (v > 180), 0) AS x1, coalesce(max(r) FILTER (v > 180) + 1, 0) AS y2, coalesce(max(c) FILTER (v > 180) + 1, 0) AS x2 FROM pixels GROUP BY image""")
def mask_bounding_box(spark, sf_dir):
    return raster.mask_box(A.pixels(spark, sf_dir), 180)


@query("median_filter", _with(V.PIXELS) + """, near AS (SELECT a.image, a.r, a.c, b.v, row_number() OVER (PARTITION BY a.image, a.r, a.c ORDER BY b.v) AS k, count(*) OVER (PARTITION BY a.image, a.r, a.c) AS n
 FROM pixels a JOIN pixels b ON a.image = b.image AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 25) SELECT image, r, c, CAST(v AS DOUBLE) AS median FROM near WHERE k = n // 2 + 1""")
def median_filter(spark, sf_dir):
    ship(spark)
    return raster.long_form(raster.filtered(A.images(spark, sf_dir), lambda im: raster.disk_median(im, 5), "median"), "median")


@query("gaussian_filter", _with(V.PIXELS) + """, k AS (SELECT o, exp(-0.5 * (o / 2.0) * (o / 2.0)) AS g FROM (SELECT unnest(range(-8, 9)) AS o)), kn AS (SELECT o, g / (SELECT sum(g) FROM k) AS g FROM k),
 a AS (SELECT p.image, t.r, p.c, sum(kn.g * p.v) AS v FROM (SELECT unnest(range(0, 8)) AS r) t, kn, pixels p WHERE p.r = least(greatest(t.r + kn.o, 0), 7) GROUP BY p.image, t.r, p.c),
 b AS (SELECT a.image, a.r, t.c, sum(kn.g * a.v) AS v FROM (SELECT unnest(range(0, 8)) AS c) t, kn, a WHERE a.c = least(greatest(t.c + kn.o, 0), 7) GROUP BY a.image, a.r, t.c)
 SELECT image, CAST(r AS INT) AS r, CAST(c AS INT) AS c, round(v, 4) AS smooth FROM b""")
def gaussian_filter(spark, sf_dir):
    ship(spark)
    return raster.long_form(raster.filtered(A.images(spark, sf_dir), raster.gaussian, "smooth"), "smooth").withColumn("smooth", F.round("smooth", 4))


# Spatial joins and components.
_BLOCKS = """mem AS (SELECT DISTINCT image, idx, x, y, bi, bj FROM (SELECT *, unnest([id_j // 3, greatest((id_j - 1) // 3, 0)]) AS bj FROM (SELECT *, unnest([id_i // 3, greatest((id_i - 1) // 3, 0)]) AS bi FROM cents)))"""
_PAIRS = """pairs AS (SELECT DISTINCT l.image, l.idx AS a, r.idx AS b FROM mem l JOIN mem r ON l.image = r.image AND l.bi = r.bi AND l.bj = r.bj AND l.idx < r.idx
 WHERE sqrt((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) > 0 AND sqrt((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) < 10)"""
_ROOTS = """both_ AS (SELECT image, a, b FROM pairs UNION ALL SELECT image, b, a FROM pairs), reach AS (SELECT image, a AS idx, a AS other FROM both_ UNION SELECT reach.image, reach.idx, both_.b FROM reach JOIN both_ ON reach.image = both_.image AND reach.other = both_.a),
 roots AS (SELECT image, idx, min(other) AS root FROM reach GROUP BY image, idx)"""


@query("block_members", _with(V.CENTROIDS, _BLOCKS) + "SELECT image, CAST(bi AS INT) AS bi, CAST(bj AS INT) AS bj, count(*) AS members, min(idx) AS first_idx FROM mem GROUP BY image, bi, bj")
def block_members(spark, sf_dir):
    return spatial.block_members(A.centroids(spark, sf_dir)).groupBy("image", "bi", "bj").agg(F.count(F.lit(1)).alias("members"), F.min("idx").alias("first_idx"))


@query("close_pairs", _with(V.CENTROIDS, _BLOCKS, _PAIRS) + "SELECT image, a, b FROM pairs")
def close_pairs(spark, sf_dir):
    return spatial.close_pairs(A.centroids(spark, sf_dir))


@query("components", _with(V.CENTROIDS, _BLOCKS, _PAIRS, _ROOTS, recursive=True) + "SELECT image, idx, root FROM roots")
def components(spark, sf_dir):
    return spatial.components(spatial.close_pairs(A.centroids(spark, sf_dir)))


@query("deduplicate", _with(V.CENTROIDS, _BLOCKS, _PAIRS, _ROOTS, recursive=True) + "SELECT image, idx, id_i, id_j, x, y FROM cents c WHERE NOT EXISTS (SELECT 1 FROM roots r WHERE r.image = c.image AND r.idx = c.idx AND r.root <> r.idx)")
def deduplicate(spark, sf_dir):
    return spatial.deduplicate(A.centroids(spark, sf_dir))


@query("stream_deduplicate", ORACLES["deduplicate"])
def stream_deduplicate(spark, sf_dir):
    """The detections come as a stream of files, in two batches and in an order that has nothing to do with their place."""
    root, parts = spatial.shared_folder(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    A.centroids(spark, sf_dir).repartition(parts, "idx").write.parquet(f"{root}/in")
    came = spark.read.parquet(f"{root}/in")
    stream = spark.readStream.schema(came.schema).option("maxFilesPerTrigger", (parts + 1) // 2).parquet(f"{root}/in")
    detections.start(stream, f"{root}/roots", f"{root}/state", availableNow=True).awaitTermination()
    return detections.kept(came, f"{root}/roots")


@query("dedup_counts", _with(V.CENTROIDS, _BLOCKS, _PAIRS, _ROOTS, recursive=True) + """SELECT c.image, count(*) AS before, count(*) FILTER (r.root IS NULL OR r.root = c.idx) AS after, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1
 FROM cents c LEFT JOIN roots r ON r.image = c.image AND r.idx = c.idx GROUP BY c.image""")
def dedup_counts(spark, sf_dir):
    """Counts before and after, and the extent, of each image."""
    c = A.centroids(spark, sf_dir)
    r = spatial.components(spatial.close_pairs(c))
    stays = F.col("root").isNull() | (F.col("root") == F.col("idx"))
    return c.join(r, ["image", "idx"], "left").groupBy("image").agg(
        F.count(F.lit(1)).alias("before"), F.count_if(stays).alias("after"), F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1")
    )


@query("clean_points", _with(V.CENTROIDS, V.LAYERS) + "SELECT image, idx, x, y FROM cents c WHERE NOT EXISTS (SELECT 1 FROM layers l WHERE c.x BETWEEN l.x0 AND l.x1 AND c.y BETWEEN l.y0 AND l.y1)")
def clean_points(spark, sf_dir):
    return spatial.outside(A.centroids(spark, sf_dir), A.clean_layers(spark, sf_dir)).select("image", "idx", "x", "y")


@query("clean_in_boundary", _with(V.CENTROIDS, V.LAYERS) + """SELECT image, idx FROM cents c WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM layers QUALIFY row_number() OVER (PARTITION BY layer ORDER BY fid) = 1) l
 WHERE c.x BETWEEN greatest(l.x0, 10) AND least(l.x1, 400) AND c.y BETWEEN greatest(l.y0, 20) AND least(l.y1, 1200))""")
def clean_in_boundary(spark, sf_dir):
    """The first feature of each layer, all that is read of a layer, cut to a boundary, removes the points in it."""
    layers = A.clean_layers(spark, sf_dir).withColumn("n", F.row_number().over(Window.partitionBy("layer").orderBy("fid"))).filter("n = 1")
    cut = layers.select(F.greatest("x0", F.lit(10.0)).alias("x0"), F.least("x1", F.lit(400.0)).alias("x1"), F.greatest("y0", F.lit(20.0)).alias("y0"), F.least("y1", F.lit(1200.0)).alias("y1"))
    return spatial.outside(A.centroids(spark, sf_dir), cut.filter("x0 <= x1 and y0 <= y1")).select("image", "idx")


@query("clean_rectangles", _with(V.BOXES, V.LAYERS) + "SELECT image, box FROM boxes b WHERE NOT EXISTS (SELECT 1 FROM layers l WHERE b.x1 <= l.x1 AND b.x2 >= l.x0 AND b.y1 <= l.y1 AND b.y2 >= l.y0)")
def clean_rectangles(spark, sf_dir):
    """Rectangles that intersect no layer; borders that touch intersect."""
    return spatial.clear_of(A.boxes(spark, sf_dir), A.clean_layers(spark, sf_dir)).select("image", "box")


@query("grid_points_within", _with(V.SCENES) + """SELECT image, CAST(gx AS DOUBLE) AS gx, CAST(gy AS DOUBLE) AS gy FROM (SELECT *, unnest(range(0, 1 + width // 40 * 40, 40)) AS gx FROM (SELECT *, unnest(range(0, 1 + height // 40 * 40, 40)) AS gy FROM scenes))
 WHERE gx > 0 AND gy > 0 AND gx * height + gy * width < width * height""")
def grid_points_within(spark, sf_dir):
    """Grid points strictly inside a triangle of each image."""
    s = A.scenes(spark, sf_dir)
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(p(F.lit(0), F.lit(0)), p(F.col("width"), F.lit(0)), p(F.lit(0), F.col("height")))
    return spatial.points_within(spread(s.select("image", ring.alias("ring"))), 40.0)


# Detection.
@query("iou_pairs", _with(V.BOXES, V.GT) + f"SELECT image, box, gt_b, round(iou, 6) AS iou FROM (SELECT a.image, a.box, b.gt AS gt_b, {_IOU} AS iou FROM boxes a JOIN gts b ON a.image = b.image) WHERE iou > 0")
def iou_pairs(spark, sf_dir):
    return detection.overlaps(A.boxes(spark, sf_dir), A.ground_truth(spark, sf_dir)).select("image", "box", "gt_b", F.round("iou", 6).alias("iou"))


@query("mask_iou", _with(V.PIXELS) + """, m AS (SELECT image // 10 AS grp, image, r, c FROM pixels WHERE v / 255.0 > 0.5), n AS (SELECT grp, image, count(*) AS n FROM m GROUP BY grp, image)
 SELECT x.grp, x.a, x.b, round(x.k / (na.n + nb.n - x.k), 6) AS iou FROM (SELECT p.grp, p.image AS a, q.image AS b, count(*) AS k FROM m p JOIN m q ON p.grp = q.grp AND p.r = q.r AND p.c = q.c AND p.image < q.image GROUP BY ALL) x JOIN n na ON na.image = x.a JOIN n nb ON nb.image = x.b""")
def mask_iou(spark, sf_dir):
    m = A.pixels(spark, sf_dir).filter("v / 255.0 > 0.5").withColumn("grp", F.floor(F.col("image") / 10))
    n = m.groupBy("image").agg(F.count(F.lit(1)).alias("n"))
    left, right = m.select("grp", "r", "c", F.col("image").alias("a")), m.select("grp", "r", "c", F.col("image").alias("b"))
    k = left.join(right, ["grp", "r", "c"]).filter("a < b").groupBy("grp", "a", "b").agg(F.count(F.lit(1)).alias("k"))
    k = k.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b")
    return k.select("grp", "a", "b", F.round(F.col("k") / (F.col("na") + F.col("nb") - F.col("k")), 6).alias("iou"))


_NMS_IOU = _IOU.replace("a.", "k.").replace("b.", "r.")
_NMS = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY image, class_id ORDER BY score DESC, box) AS n FROM boxes WHERE class_id > 0 AND score >= 0.3 AND (y2 - y1) * (x2 - x1) > 0),
 step AS (SELECT image, class_id, 0 AS n, CAST([] AS STRUCT(box BIGINT, y1 DOUBLE, x1 DOUBLE, y2 DOUBLE, x2 DOUBLE)[]) AS kept FROM (SELECT DISTINCT image, class_id FROM ranked)
 UNION ALL SELECT s.image, s.class_id, CAST(r.n AS INT), CASE WHEN len(list_filter(s.kept, lambda k: {_NMS_IOU} > 0.3)) > 0 THEN s.kept ELSE list_append(s.kept, {{'box': r.box, 'y1': r.y1, 'x1': r.x1, 'y2': r.y2, 'x2': r.x2}}) END
 FROM step s JOIN ranked r ON s.image = r.image AND s.class_id = r.class_id AND r.n = s.n + 1),
 picked AS (SELECT image, class_id, unnest(kept).box AS box FROM step QUALIFY row_number() OVER (PARTITION BY image, class_id ORDER BY n DESC) = 1)"""


@query("suppression", _with(V.BOXES, _NMS, recursive=True) + "SELECT image, class_id, box FROM picked")
def suppression(spark, sf_dir):
    good = A.boxes(spark, sf_dir).filter((F.col("class_id") > 0) & (F.col("score") >= 0.3) & (B.area(B.box()) > 0))
    return detection.suppress(good, ["image", "class_id"], 0.3).select("image", "class_id", "box")


@query("refine_detections", _with(V.BOXES, _NMS, recursive=True) + "SELECT image, class_id, box, round(score, 6) AS score, CAST(k AS INT) AS rank FROM (SELECT b.*, row_number() OVER (PARTITION BY b.image ORDER BY b.score DESC, b.box) AS k FROM boxes b JOIN picked p ON b.image = p.image AND b.box = p.box) WHERE k <= 3")
def refine_detections(spark, sf_dir):
    return detection.refine(A.boxes(spark, sf_dir), limit=3).select("image", "class_id", "box", F.round("score", 6).alias("score"), "rank")


def _match_sql(thresholds: str) -> str:
    """Matching as a recursion over the predictions of an image at each threshold."""
    return f"""ts AS (SELECT unnest({thresholds}) AS t), pairs AS (SELECT image, box, gt, iou FROM (SELECT a.image, a.box, b.gt, {_IOU} AS iou FROM preds0 a JOIN gts b ON a.image = b.image AND a.class_id = b.class_id) WHERE iou >= 0.5),
 offers AS (SELECT t, image, box, list(gt ORDER BY iou DESC, gt) AS gts FROM pairs, ts WHERE iou >= t GROUP BY t, image, box),
 preds AS (SELECT ts.t, b.image, b.box, b.score, coalesce(o.gts, []) AS gts, row_number() OVER (PARTITION BY ts.t, b.image ORDER BY b.score DESC, b.box) AS n FROM preds0 b CROSS JOIN ts LEFT JOIN offers o ON b.image = o.image AND b.box = o.box AND o.t = ts.t),
 step AS (SELECT DISTINCT t, image, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS box, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS gt FROM preds
 UNION ALL SELECT p.t, p.image, p.n, p.box, CASE WHEN len(list_filter(p.gts, lambda g: NOT list_contains(s.used, g))) > 0 THEN list_append(s.used, list_filter(p.gts, lambda g: NOT list_contains(s.used, g))[1]) ELSE s.used END,
 list_filter(p.gts, lambda g: NOT list_contains(s.used, g))[1] FROM step s JOIN preds p ON s.t = p.t AND s.image = p.image AND p.n = s.n + 1),
 matched AS (SELECT step.t, step.image, step.box, step.gt, preds.score FROM step JOIN preds ON step.t = preds.t AND step.image = preds.image AND step.box = preds.box)"""


_MATCH = _match_sql("[0.5]")


def _pairs(pred: DataFrame, gt: DataFrame) -> DataFrame:
    return detection.overlaps(pred, gt, same_class=True)


def _n_gt(gt: DataFrame) -> DataFrame:
    return gt.groupBy("image").agg(F.count(F.lit(1)).alias("n_gt"))


@query("greedy_match", _with(V.BOXES, V.PREDICTIONS, V.GT, _MATCH, recursive=True) + "SELECT image, box, CAST(gt AS INT) AS gt FROM matched")
def greedy_match(spark, sf_dir):
    pred = A.predictions(spark, sf_dir)
    return detection.match(pred, _pairs(pred, A.ground_truth(spark, sf_dir))).select("image", "box", "gt")


_AP = """ranked2 AS (SELECT m.t, m.image, m.box, m.gt, sum(CASE WHEN gt IS NULL THEN 0 ELSE 1 END) OVER w AS hits, row_number() OVER w AS k FROM matched m WINDOW w AS (PARTITION BY m.t, m.image ORDER BY m.score DESC, m.box)),
 env AS (SELECT *, max(hits / k) OVER (PARTITION BY t, image ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p FROM ranked2),
 n AS (SELECT image, count(*) AS n_gt FROM gts GROUP BY image),
 aps AS (SELECT ts.t, n.image, coalesce(sum(CASE WHEN e.gt IS NULL THEN 0 ELSE e.p END), 0) / max(n_gt) AS ap FROM n CROSS JOIN ts LEFT JOIN env e ON e.image = n.image AND e.t = ts.t GROUP BY ts.t, n.image)"""


@query("average_precision", _with(V.BOXES, V.PREDICTIONS, V.GT, _MATCH, _AP, recursive=True) + "SELECT image, round(ap, 6) AS ap FROM aps")
def average_precision(spark, sf_dir):
    """Images whose predictions are all unsure have 0."""
    gt, pred = A.ground_truth(spark, sf_dir), A.predictions(spark, sf_dir)
    return detection.average_precision(detection.match(pred, _pairs(pred, gt)), _n_gt(gt), ["image"]).select("image", F.round("ap", 6).alias("ap"))


# The thresholds of the mean.
_THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)


@query("mean_average_precision", _with(V.BOXES, V.PREDICTIONS, V.GT, _match_sql("[0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]::DOUBLE[]"), _AP, recursive=True) + "SELECT image, round(avg(ap), 6) AS ap FROM aps GROUP BY image")
def mean_average_precision(spark, sf_dir):
    """The mean over the thresholds of each image; the overlaps are found once."""
    gt, pred = A.ground_truth(spark, sf_dir, True), A.predictions(spark, sf_dir, True)
    parts = A.parts(spark, sf_dir)
    pairs = detection.overlaps(detection.ranked(pred), gt, same_class=True, parts=parts).select("image", "box", "rank", "gt_b", "iou")
    return detection.mean_average_precision(pred, pairs.repartition(parts, "image"), _n_gt(gt), _THRESHOLDS).select("image", F.round("ap", 6).alias("ap"))


_BEST = f"""ov AS (SELECT a.image, a.box, b.gt, b.class_id AS gt_class, {_IOU} AS iou FROM boxes a JOIN gts b ON a.image = b.image)"""


@query("anchor_targets", _with(V.BOXES, V.GT, _BEST) + """, best AS (SELECT image, box, max(iou) AS iou FROM ov WHERE iou > 0 AND gt_class > 0 GROUP BY image, box), crowd AS (SELECT image, box, max(iou) AS c FROM ov WHERE gt_class < 0 GROUP BY image, box),
 top_ AS (SELECT DISTINCT image, box FROM (SELECT *, rank() OVER (PARTITION BY image, gt ORDER BY iou DESC) AS k FROM ov WHERE iou > 0 AND gt_class > 0) WHERE k = 1)
 SELECT b.image, b.box, CASE WHEN t.box IS NOT NULL OR coalesce(best.iou, 0) >= 0.7 THEN 1 WHEN coalesce(best.iou, 0) < 0.3 AND coalesce(c.c, 0) < 0.001 THEN -1 ELSE 0 END AS target
 FROM boxes b LEFT JOIN best ON b.image = best.image AND b.box = best.box LEFT JOIN crowd c ON b.image = c.image AND b.box = c.box LEFT JOIN top_ t ON b.image = t.image AND b.box = t.box""")
def anchor_targets(spark, sf_dir):
    """1 from an overlap of 0.7 or as the best of a ground truth (with ties), -1 below 0.3 outside crowds, else 0."""
    o = detection.overlaps(A.boxes(spark, sf_dir, True), A.ground_truth(spark, sf_dir, True), left=True, parts=A.parts(spark, sf_dir))
    o = o.select("image", "box", "gt_b", "class_id_b", "iou").repartition(A.parts(spark, sf_dir), "image")  # what follows goes by image
    real, crowd = F.col("class_id_b") > 0, F.col("class_id_b") < 0
    o = o.withColumn("first", F.max(F.when(real, F.col("iou"))).over(Window.partitionBy("image", "gt_b")))
    j = o.groupBy("image", "box").agg(
        F.max(F.when(real, F.col("iou"))).alias("best"), F.max(F.when(crowd, F.col("iou"))).alias("crowd"), F.max(real & (F.col("iou") == F.col("first"))).alias("top")
    )
    iou = F.coalesce("best", F.lit(0.0))
    low = (iou < 0.3) & (F.coalesce("crowd", F.lit(0.0)) < 0.001)
    return j.select("image", "box", F.when(F.coalesce("top", F.lit(False)) | (iou >= 0.7), 1).when(low, -1).otherwise(0).alias("target"))


@query("roi_assignment", _with(V.BOXES, V.GT, _BEST) + """SELECT image, box, CAST(gt AS INT) AS gt, round(iou, 6) AS iou, iou >= 0.5 AS positive FROM (SELECT *, row_number() OVER (PARTITION BY image, box ORDER BY iou DESC, gt) AS k FROM ov WHERE iou > 0) WHERE k = 1""")
def roi_assignment(spark, sf_dir):
    m = detection.best_match(A.boxes(spark, sf_dir), A.ground_truth(spark, sf_dir), "box", "gt")
    return m.select("image", "box", F.col("gt_b").alias("gt"), F.round("iou", 6).alias("iou"), (F.col("iou") >= 0.5).alias("positive"))


@query("roi_ratio", _with(V.BOXES, V.GT, _BEST) + """SELECT image, count(*) FILTER (iou >= 0.5) AS positive, count(*) FILTER (iou < 0.5) AS negative, round(avg(CASE WHEN iou >= 0.5 THEN 1.0 ELSE 0.0 END), 6) AS ratio
 FROM (SELECT *, row_number() OVER (PARTITION BY image, box ORDER BY iou DESC, gt) AS k FROM ov WHERE iou > 0) WHERE k = 1 GROUP BY image""")
def roi_ratio(spark, sf_dir):
    m = detection.best_match(A.boxes(spark, sf_dir), A.ground_truth(spark, sf_dir), "box", "gt")
    yes = F.col("iou") >= 0.5
    return m.groupBy("image").agg(F.count_if(yes).alias("positive"), F.count_if(~yes).alias("negative"), F.round(F.avg(yes.cast("double")), 6).alias("ratio"))


@query("recall", _with(V.BOXES, V.GT, _BEST) + """SELECT n.image, round(count(DISTINCT m.gt) / max(n.n_gt), 6) AS recall FROM (SELECT image, count(*) AS n_gt FROM gts GROUP BY image) n
 LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image, box ORDER BY iou DESC, gt) AS k FROM ov WHERE iou > 0) WHERE k = 1 AND iou >= 0.5) m ON n.image = m.image GROUP BY n.image""")
def recall(spark, sf_dir):
    gt = A.ground_truth(spark, sf_dir)
    m = detection.best_match(A.boxes(spark, sf_dir), gt, "box", "gt").filter("iou >= 0.5")
    n = gt.groupBy("image").agg(F.count(F.lit(1)).alias("n_gt"))
    found = m.groupBy("image").agg(F.countDistinct("gt_b").alias("found"))
    return n.join(found, "image", "left").select("image", F.round(F.coalesce("found", F.lit(0)) / F.col("n_gt"), 6).alias("recall"))


# Windows, sorts, groups.
@query("prefix_offsets", _with(V.CENTROIDS) + """SELECT image, id_i, id_j, n, CAST(coalesce(sum(n) OVER (PARTITION BY image ORDER BY id_i, id_j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_idx FROM (SELECT image, id_i, id_j, count(*) AS n FROM cents GROUP BY ALL)""")
def prefix_offsets(spark, sf_dir):
    n = A.centroids(spark, sf_dir).groupBy("image", "id_i", "id_j").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("image").orderBy("id_i", "id_j").rowsBetween(Window.unboundedPreceding, -1)
    return n.select("image", "id_i", "id_j", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("first_idx"))


@query("top_detections", _with(V.BOXES) + "SELECT image, box, round(score, 6) AS score, CAST(k AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, box) AS k FROM boxes) WHERE k <= 2")
def top_detections(spark, sf_dir):
    return detection.top(A.boxes(spark, sf_dir), ["image"], 2).select("image", "box", F.round("score", 6).alias("score"), "rank")


@query("seeded_sample", _with(V.BOXES) + "SELECT image, box FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY (part * 7919 + box * 104729) % 10007, box) AS k FROM boxes) WHERE k <= 3")
def seeded_sample(spark, sf_dir):
    """At most three boxes of each image in a fixed scrambled order."""
    w = Window.partitionBy("image").orderBy((F.col("part") * 7919 + F.col("box") * 104729) % 10007, "box")
    return A.boxes(spark, sf_dir).withColumn("k", F.row_number().over(w)).filter("k <= 3").select("image", "box")


@query("first_of_group", _with(V.BOXES) + "SELECT image, box, class_id FROM boxes QUALIFY row_number() OVER (PARTITION BY image ORDER BY image * 100000 + box) = 1")
def first_of_group(spark, sf_dir):
    w = Window.partitionBy("image").orderBy(F.col("image") * 100000 + F.col("box"))
    return A.boxes(spark, sf_dir).withColumn("n", F.row_number().over(w)).filter("n = 1").select("image", "box", "class_id")


@query("truncate_at_zero", _with(V.BOXES) + "SELECT image, box, class_id FROM boxes b WHERE box < coalesce((SELECT min(z.box) FROM boxes z WHERE z.image = b.image AND z.class_id = 0), 1000000)")
def truncate_at_zero(spark, sf_dir):
    """Rows of an image before its first row of class 0."""
    w = Window.partitionBy("image")
    b = A.boxes(spark, sf_dir).withColumn("stop", F.min(F.when(F.col("class_id") == 0, F.col("box"))).over(w))
    return b.filter(F.col("stop").isNull() | (F.col("box") < F.col("stop"))).select("image", "box", "class_id")


@query("crowd_split", _with(V.BOXES, V.GT, _BEST) + """SELECT b.image, b.box, coalesce(c.c, 0) < 0.001 AS no_crowd FROM boxes b LEFT JOIN (SELECT image, box, max(iou) AS c FROM ov WHERE gt_class < 0 GROUP BY image, box) c ON b.image = c.image AND b.box = c.box""")
def crowd_split(spark, sf_dir):
    b = A.boxes(spark, sf_dir)
    crowd = detection.overlaps(b, A.ground_truth(spark, sf_dir).filter("class_id < 0")).groupBy("image", "box").agg(F.max("iou").alias("c"))
    return b.join(crowd, ["image", "box"], "left").select("image", "box", (F.coalesce("c", F.lit(0.0)) < 0.001).alias("no_crowd"))


@query("images_with_class", _with(V.BOXES) + "SELECT image, count(*) AS boxes, count(DISTINCT class_id) AS classes FROM boxes b WHERE EXISTS (SELECT 1 FROM boxes p WHERE p.image = b.image AND p.class_id > 0 AND p.part NOT IN (1, 2, 3)) GROUP BY image")
def images_with_class(spark, sf_dir):
    """Images with a positive class outside the skip list."""
    b = A.boxes(spark, sf_dir, True)
    good = (F.col("class_id") > 0) & ~F.col("part").isin(1, 2, 3)
    every = b.filter("image IS NOT NULL").groupBy("image").agg(F.count(F.lit(1)).alias("boxes"), F.countDistinct("class_id").alias("classes"), F.max(good).alias("good"))
    return every.filter("good").drop("good")


@query("class_areas", _with(V.BOXES) + "SELECT class_id, round(sum((y2 - y1) * (x2 - x1)), 2) + 0.0 AS area, count(*) AS n FROM boxes GROUP BY class_id ORDER BY area DESC LIMIT 4")
def class_areas(spark, sf_dir):
    return A.boxes(spark, sf_dir).groupBy("class_id").agg((F.round(F.sum(B.area(B.box())), 2) + 0.0).alias("area"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("area")).limit(4)


@query("tensor_stats", _with(V.PIXELS) + "SELECT image, min(v) AS lo, max(v) AS hi, round(stddev_pop(v), 4) AS sd FROM pixels GROUP BY image")
def tensor_stats(spark, sf_dir):
    return A.pixels(spark, sf_dir).groupBy("image").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.round(F.stddev_pop("v"), 4).alias("sd"))


@query("dissolve", _with(V.LAYERS) + "SELECT layer, CAST(floor(x0 / 64) AS BIGINT) AS cx, CAST(floor(y0 / 64) AS BIGINT) AS cy, count(*) AS parts, min(fid) AS first_fid, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM layers GROUP BY layer, CAST(floor(x0 / 64) AS BIGINT), CAST(floor(y0 / 64) AS BIGINT)")
def dissolve(spark, sf_dir):
    """The parts of each layer as one feature for each cell of the plane, so that no layer comes together in one row."""
    cell = [F.floor(F.col(c) / 64).alias(n) for c, n in (("x0", "cx"), ("y0", "cy"))]
    return A.clean_layers(spark, sf_dir).groupBy("layer", *cell).agg(
        F.count(F.lit(1)).alias("parts"), F.min("fid").alias("first_fid"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")
    )


# Sets.
_LAYER_PAIR = """one AS (SELECT layer % 2 AS layer, fid % 50 AS fid FROM layers), two AS (SELECT layer % 2 AS layer, fid % 60 AS fid FROM layers)"""


@query("layer_difference", _with(V.LAYERS, _LAYER_PAIR) + "SELECT 'only first' AS side, layer, fid FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM two) UNION ALL SELECT 'only second', layer, fid FROM (SELECT * FROM two EXCEPT ALL SELECT * FROM one)")
def layer_difference(spark, sf_dir):
    layers = A.clean_layers(spark, sf_dir)
    one, two = (layers.select((F.col("layer") % 2).alias("layer"), (F.col("fid") % m).alias("fid")) for m in (50, 60))
    return compare.difference(one, two)


@query("layer_intersection", _with(V.LAYERS, _LAYER_PAIR) + "SELECT layer, fid FROM one INTERSECT SELECT layer, fid FROM two")
def layer_intersection(spark, sf_dir):
    layers = A.clean_layers(spark, sf_dir)
    one, two = (layers.select((F.col("layer") % 2).alias("layer"), (F.col("fid") % m).alias("fid")) for m in (50, 60))
    return one.intersect(two)


@query("source_classes", """SELECT DISTINCT event_type AS source, e.user_id % 5 AS source_id, event_type || '.' || (e.user_id % 5) AS key, substr(event_type || ',' || user_id, 1, strpos(event_type || ',' || user_id, ',') - 1) AS head FROM events e""")
def source_classes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    both = F.concat_ws(",", "event_type", F.col("user_id").cast("string"))
    return e.select(F.col("event_type").alias("source"), (F.col("user_id") % 5).alias("source_id"), F.concat_ws(".", "event_type", (F.col("user_id") % 5).cast("string")).alias("key"), F.substring_index(both, ",", 1).alias("head")).distinct()


_CLASSES = """c AS (SELECT event_type AS source, user_id % 5 AS id, min(event_id) AS first_at FROM events GROUP BY ALL), ids AS (SELECT *, row_number() OVER (ORDER BY first_at, source, id) AS class_id FROM c),
 act AS (SELECT source, list_prepend(0, list_sort(list(class_id))) AS active FROM ids GROUP BY source)"""


@query("class_registry", _with(_CLASSES) + """SELECT CAST(i.class_id AS INT) AS class_id, i.source, i.source || '.' || i.id AS key, i.source || ' of ' || e.user_id AS name, array_to_string(active, ',') AS active
 FROM ids i JOIN act USING (source) JOIN events e ON e.event_id = i.first_at UNION ALL SELECT 0, '', '.0', 'BG', NULL""")
def class_registry(spark, sf_dir):
    """Classes of several sources under common ids, in the order of their first appearance, with the classes of the source."""
    classes = dataset.registry(_classes(spark, sf_dir))
    return classes.join(dataset.active(classes), "source", "left").select("class_id", "source", "key", "name", F.concat_ws(",", F.col("active").cast("array<string>")).alias("active")).withColumn("active", F.when(F.col("class_id") > 0, F.col("active")))


@query("class_lookup", _with(_CLASSES) + "SELECT event_id, CAST(class_id AS INT) AS class_id, CAST(len(active) AS INT) AS active FROM events e JOIN ids i ON i.source = e.event_type AND i.id = e.user_id % 5 JOIN act ON act.source = e.event_type")
def class_lookup(spark, sf_dir):
    """The class of each row by its source's own id, and how many classes are active for it."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("source"), (F.col("user_id") % 5).alias("id"))
    found = dataset.with_class(rows, dataset.registry(_classes(spark, sf_dir)))
    return found.select("event_id", "class_id", F.size("active").alias("active"))


def _classes(spark, sf_dir):
    named = F.concat("event_type", F.lit(" of "), F.col("user_id").cast("string"), F.lit(", "), F.col("event_type"))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), (F.col("user_id") % 5).alias("id"), named.alias("name"), F.col("event_id").alias("at"))


@query("annotation_json", """SELECT event_id, k, CASE WHEN k IS NULL THEN NULL ELSE k * 2 END AS twice FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def annotation_json(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))
    return e.select("event_id", "k", (F.col("k") * 2).alias("twice"))


@query("image_meta", _with(V.SCENES) + """SELECT image, len(meta) AS n, CAST(meta[1] AS INT) AS image_id, CAST(meta[3] AS INT) AS original_w, CAST(meta[5] AS INT) AS h, CAST(meta[8] AS INT) AS window_y1, CAST(meta[9] AS INT) AS window_x1,
 CAST(meta[10] AS INT) AS window_y2, CAST(meta[11] AS INT) AS window_x2, meta[12] AS scale, CAST(list_sum(meta[13:]) AS INT) AS classes FROM (SELECT image, list_concat([CAST(image AS DOUBLE), height, width, 3, 1024, 1024, 3, top, lft, top + nh, lft + nw, scale], active) AS meta
 FROM (SELECT *, (1024 - nh) // 2 AS top, (1024 - nw) // 2 AS lft, [CAST(image % k = 0 AS DOUBLE) for k in range(1, 6)] AS active FROM (SELECT *, CAST(round_even(height * scale, 0) AS INT) AS nh, CAST(round_even(width * scale, 0) AS INT) AS nw FROM (SELECT *, 1024.0::DOUBLE / greatest(height, width) AS scale FROM scenes))))""")
def image_meta(spark, sf_dir):
    """The record of each scene scaled to a square of 1024 with a border around it, packed and parsed again."""
    s = A.scenes(spark, sf_dir).withColumn("scale", F.lit(1024.0) / F.greatest("height", "width"))
    nh, nw = (F.rint(F.col(c) * F.col("scale")).cast("int") for c in ("height", "width"))
    top, left = F.floor((1024 - nh) / 2), F.floor((1024 - nw) / 2)
    values = (F.col("image"), F.col("height"), F.col("width"), F.lit(3), F.lit(1024), F.lit(1024), F.lit(3), top, left, top + nh, left + nw, F.col("scale"))
    s = s.select("image", *[v.alias(n) for n, v in zip(dataflow.META, values)], F.array(*[(F.col("image") % k == 0).cast("int") for k in range(1, 6)]).alias("active"))
    m = dataflow.parse_meta(dataflow.pack_meta(s))
    parts = [F.col(f"m.{c}").alias(c) for c in ("image_id", "original_w", "h", "window_y1", "window_x1", "window_y2", "window_x2", "scale")]
    return m.select("image", F.size("meta").cast("long").alias("n"), *parts, F.aggregate("m.active", F.lit(0), lambda x, y: x + y).alias("classes"))


# Flagship: deduplicate detections and summarise what stays by image and tile.
@query("stitch_report", _with(V.CENTROIDS, _BLOCKS, _PAIRS, _ROOTS, V.LAYERS, recursive=True) + """SELECT image, id_i, id_j, count(*) AS polygons, CAST(sum(round(x * 100)) AS BIGINT) AS sum_x FROM cents c WHERE NOT EXISTS (SELECT 1 FROM roots r WHERE r.image = c.image AND r.idx = c.idx AND r.root <> r.idx)
 AND NOT EXISTS (SELECT 1 FROM layers l WHERE c.x BETWEEN l.x0 AND l.x1 AND c.y BETWEEN l.y0 AND l.y1) GROUP BY image, id_i, id_j""")
def stitch_report(spark, sf_dir):
    c = spatial.outside(spatial.deduplicate(A.centroids(spark, sf_dir)), A.clean_layers(spark, sf_dir))
    return c.groupBy("image", "id_i", "id_j").agg(F.count(F.lit(1)).alias("polygons"), F.sum(F.round(F.col("x") * 100).cast("long")).alias("sum_x"))


from . import imagery, training  # noqa: E402, F401  more queries
