"""Registered queries: tiles with pixels, masks and images, cleaning with polygons, result layers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import geometry, images
from ..operators import inference, overlay, scenes, spatial
from ..session import ship, spread, table
from ..sources import adapters as A
from . import flow
from . import oracle_views as V
from .registry import query, with_views


@query("scene_tiles", with_views(V.SCENE_PIXELS) + """, t AS (SELECT *, r // 2 AS id_i, c // 2 AS id_j FROM spx), kept AS (SELECT image_name, id_i, id_j, row_number() OVER (PARTITION BY image_name ORDER BY id_i, id_j) - 1 AS tile_num
 FROM t WHERE band = 2 GROUP BY image_name, id_i, id_j HAVING max(v) > 0), s AS (SELECT t.*, k.tile_num, CASE band WHEN 3 THEN 0 ELSE band END AS o, min(v) OVER w AS lo, max(v) OVER w AS hi FROM t JOIN kept k USING (image_name, id_i, id_j) WHERE band > 0 AND band <> 2 OR band = 2 WINDOW w AS (PARTITION BY image_name, id_i, id_j)),
 e AS (SELECT *, CASE WHEN hi > lo THEN CAST(round_even((v - lo) * 255.0 / (hi - lo), 0) AS INT) ELSE 0 END AS b FROM s),
 n AS (SELECT *, count(*) OVER (PARTITION BY image_name, id_i, id_j, o ORDER BY b) AS cdf, count(*) OVER (PARTITION BY image_name, id_i, id_j, o) AS total, min(b) OVER (PARTITION BY image_name, id_i, id_j, o) AS b0 FROM e),
 q AS (SELECT *, min(cdf) OVER (PARTITION BY image_name, id_i, id_j, o) AS n0 FROM n)
 SELECT image_name, CAST(tile_num AS INT) AS tile_num, CAST(id_i AS INT) AS id_i, CAST(id_j AS INT) AS id_j, 2000.0 + id_i * 2 * -0.5 AS ul_row, 1000.0 + id_j * 2 * 0.5 AS ul_col,
 string_agg(printf('%02x', CASE WHEN total = n0 THEN b ELSE CAST(round_even((cdf - n0) * 255.0 / (total - n0), 0) AS INT) END), '' ORDER BY r, c, o) AS data FROM q GROUP BY ALL""")
def scene_tiles(spark, sf_dir):
    """Scenes cut to tiles of 2 x 2, black ones dropped, stretched over all bands, each band equalised, numbered."""
    ship(spark)
    t = scenes.tiles(A.scene_rows(spark, sf_dir), crop=2, overlap=0.0, water=False)
    return t.select("image_name", "tile_num", "id_i", "id_j", "ul_row", "ul_col", F.lower(F.hex("data")).alias("data"))


# Median, blur and the split of 256 bins in SQL; the side of a scene and of its windows.
_SIDE, _WINDOW = 4, 3
_LAND = with_views(V.SCENE_PIXELS) + f""", px AS (SELECT image_name, r, c, least(v, 255) AS v FROM spx WHERE band = 3),
 near AS (SELECT a.image_name, a.r, a.c, b.v, row_number() OVER w AS k, count(*) OVER (PARTITION BY a.image_name, a.r, a.c) AS n FROM px a JOIN px b ON a.image_name = b.image_name AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 25 WINDOW w AS (PARTITION BY a.image_name, a.r, a.c ORDER BY b.v)),
 med AS (SELECT image_name, r, c, v / 255.0::DOUBLE AS v FROM near WHERE k = n // 2 + 1), g AS (SELECT o, exp(-0.5::DOUBLE * (o / 2.0::DOUBLE) * (o / 2.0::DOUBLE)) AS g FROM (SELECT unnest(range(-8, 9)) AS o)), kn AS (SELECT o, g / (SELECT sum(g) FROM g) AS g FROM g),
 down AS (SELECT m.image_name, t.r, m.c, sum(kn.g * m.v ORDER BY kn.o) AS v FROM (SELECT unnest(range(0, {_SIDE})) AS r) t, kn, med m WHERE m.r = least(greatest(t.r + kn.o, 0), {_SIDE - 1}) GROUP BY m.image_name, t.r, m.c),
 blur AS (SELECT d.image_name, d.r, t.c, sum(kn.g * d.v ORDER BY kn.o) AS v FROM (SELECT unnest(range(0, {_SIDE})) AS c) t, kn, down d WHERE d.c = least(greatest(t.c + kn.o, 0), {_SIDE - 1}) GROUP BY d.image_name, d.r, t.c),
 ends AS (SELECT *, min(v) OVER (PARTITION BY image_name) AS lo, max(v) OVER (PARTITION BY image_name) AS hi FROM blur),
 bin AS (SELECT image_name, any_value(lo) AS lo, any_value(hi) AS hi, least(CAST(floor((v - lo) / (hi - lo) * 256) AS INT), 255) AS b, count(*) AS n FROM ends WHERE hi > lo GROUP BY image_name, least(CAST(floor((v - lo) / (hi - lo) * 256) AS INT), 255)),
 cen AS (SELECT *, lo + (hi - lo) / 256 * (b + 0.5) AS x FROM bin), cum AS (SELECT *, sum(n) OVER u AS n0, sum(n * x) OVER u AS s0, sum(n) OVER (PARTITION BY image_name) AS n1, sum(n * x) OVER (PARTITION BY image_name) AS s1 FROM cen WINDOW u AS (PARTITION BY image_name ORDER BY b)),
 best AS (SELECT image_name, x FROM cum WHERE n0 < n1 QUALIFY row_number() OVER (PARTITION BY image_name ORDER BY round(n0 * (n1 - n0) * (s0 / n0 - (s1 - s0) / (n1 - n0)) * (s0 / n0 - (s1 - s0) / (n1 - n0)), 9) DESC, b) = 1)
 SELECT e.image_name, CAST(r // {_WINDOW} * {_WINDOW} AS INT) AS y, CAST(c // {_WINDOW} * {_WINDOW} AS INT) AS x, string_agg(bits, '' ORDER BY r) AS mask FROM
 (SELECT e.image_name, r, c // {_WINDOW} * {_WINDOW} AS c, printf('%02x', CAST(sum(CASE WHEN v > coalesce(best.x, 0) THEN 128 >> CAST(c % {_WINDOW} AS INT) ELSE 0 END) AS INT)) AS bits FROM ends e LEFT JOIN best USING (image_name) GROUP BY e.image_name, r, c // {_WINDOW} * {_WINDOW}) e GROUP BY ALL"""


@query("land_mask", _LAND)
def land_mask(spark, sf_dir):
    """Median, blur and Otsu of a band as a mask, a bit a pixel, of the windows of each scene."""
    ship(spark)
    windows = scenes.windows_of(spread(A.scene_rows(spark, sf_dir)), _WINDOW, before=scenes.MARGIN, after=scenes.MARGIN)
    return scenes.masks(windows).select("image_name", "y", "x", F.lower(F.hex("mask")).alias("mask"))


@query("band_order", with_views(V.SCENE_PIXELS) + "SELECT image_name, r, c, max(v) FILTER (band = 3) AS b0, max(v) FILTER (band = 1) AS b1, max(v) FILTER (band = 2) AS b2 FROM spx GROUP BY image_name, r, c")
def band_order(spark, sf_dir):
    """The bands of a scene in the order that tiles have them, a pixel a row."""
    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, _, n, h, w, _, data = (batch.column(i)[k] for i in range(7))
                scene = np.frombuffer(data.as_buffer(), "<u2").reshape(n.as_py(), h.as_py(), w.as_py())[list(scenes.BANDS)].reshape(3, -1).astype(np.int32)
                at = np.arange(scene.shape[1])
                columns = [pa.array([name.as_py()] * len(at)), pa.array(at // w.as_py(), pa.int64()), pa.array(at % w.as_py(), pa.int64()), *map(pa.array, scene)]
                yield pa.RecordBatch.from_arrays(columns, names=["image_name", "r", "c", "b0", "b1", "b2"])

    return A.scene_rows(spark, sf_dir).select(*scenes.COLUMNS).mapInArrow(run, "image_name string, r long, c long, b0 int, b1 int, b2 int")


@query("byte_values", with_views(V.SCENE_PIXELS) + "SELECT image_name, sum(least(v, 255)) AS total, max(least(v, 255)) AS most FROM spx GROUP BY image_name")
def byte_values(spark, sf_dir):
    """Values held within a byte, without rescaling."""
    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = [images.to_byte(np.frombuffer(x.as_buffer(), "<u2")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int(x.sum()) for x in v], pa.int64()), pa.array([int(x.max()) for x in v], pa.int32())], names=["image_name", "total", "most"])

    return A.scene_rows(spark, sf_dir).select("image_name", "data").mapInArrow(run, "image_name string, total long, most int")


def _sampled(at: str, fy: str, fx: str) -> str:
    """Bilinear sampling of the four values that `at` names by a row and a column of 0 or 1."""
    v = {k: at.format(*k) for k in ((0, 0), (0, 1), (1, 0), (1, 1))}
    return f"(({v[0, 0]}) * (1 - {fy}) + ({v[1, 0]}) * {fy}) * (1 - {fx}) + (({v[0, 1]}) * (1 - {fy}) + ({v[1, 1]}) * {fy}) * {fx}"


# The pixel of an image of the query below, 0 outside; rows and columns count from the padded image's.
_PIXEL = "CASE WHEN ly + {0} BETWEEN 1 AND height AND lx + {1} BETWEEN 1 AND width THEN ((ly + {0} - 1) * 31 + (lx + {1} - 1) * 17 + image) % 251 ELSE 0 END"
_FIT = f"""WITH s AS (SELECT *, CASE WHEN round_even(greatest(height, width) * greatest(1, 64.0::DOUBLE / least(height, width)), 0) > 128 THEN 128.0::DOUBLE / greatest(height, width) ELSE greatest(1, 64.0::DOUBLE / least(height, width)) END AS scale
 FROM (SELECT vec_id AS image, CAST(4 + vec_id % 40 AS INT) AS height, CAST(4 + vec_id % 90 AS INT) AS width FROM embeddings)),
 n AS (SELECT *, CAST(round_even(height * scale, 0) AS INT) AS h, CAST(round_even(width * scale, 0) AS INT) AS w FROM s),
 p AS (SELECT *, unnest(range(w)) AS j FROM (SELECT *, unnest(range(h)) AS i FROM n)), q AS (SELECT *, (i + 0.5::DOUBLE) * height / h + 0.5::DOUBLE AS ay, (j + 0.5::DOUBLE) * width / w + 0.5::DOUBLE AS ax FROM p),
 l AS (SELECT *, CAST(floor(ay) AS BIGINT) AS ly, ay - floor(ay) AS fy, CAST(floor(ax) AS BIGINT) AS lx, ax - floor(ax) AS fx FROM q), v AS (SELECT *, CAST(floor({_sampled(_PIXEL, "fy", "fx")}) AS BIGINT) AS v FROM l)
 SELECT image, CAST((128 - h) // 2 AS INT) AS y1, CAST((128 - w) // 2 AS INT) AS x1, CAST((128 - h) // 2 + h AS INT) AS y2, CAST((128 - w) // 2 + w AS INT) AS x2, round(scale, 6) AS scale, CAST(sum(v) AS BIGINT) AS total,
 CAST(sum(v * ((i * 7 + j * 3) % 11)) AS BIGINT) AS texture, CAST(max(v) FILTER (i = h // 2 AND j = w // 2) AS INT) AS middle FROM v GROUP BY image, h, w, scale"""


@query("fit_square", _FIT)
def fit_square(spark, sf_dir):
    """Images of many shapes brought to a square of 128 amid zeros: the window, the scale, and of the pixels there the sum,
    a sum with weights that tell their places, and the one in the middle."""
    ship(spark)
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), (F.col("vec_id") % 40 + 4).cast("int").alias("height"), (F.col("vec_id") % 90 + 4).cast("int").alias("width"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for image, h, w in zip(*(batch.column(i).to_pylist() for i in range(3))):
                r, c = np.mgrid[:h, :w]
                after, window, scale = images.fit_square(((r * 31 + c * 17 + image) % 251).astype(np.uint8)[:, :, None], 64, 128)
                assert after.shape == (128, 128, 1) and after.sum() == after[window[0] : window[2], window[1] : window[3]].sum()
                part = after[window[0] : window[2], window[1] : window[3], 0].astype(np.int64)
                i, j = np.mgrid[: part.shape[0], : part.shape[1]]
                rows.append((image, *window, round(scale, 6), int(part.sum()), int((part * ((i * 7 + j * 3) % 11)).sum()), int(part[part.shape[0] // 2, part.shape[1] // 2])))
            kinds = (pa.int64(), *[pa.int32()] * 4, pa.float64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 9, kinds)], names=["image", "y1", "x1", "y2", "x2", "scale", "total", "texture", "middle"])

    return e.mapInArrow(run, "image long, y1 int, x1 int, y2 int, x2 int, scale double, total long, texture long, middle int")


#: Rows whose masks are made together (a few MB for each size of a box).
_STACK = 4096


def gathered(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have that many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)


# A pixel of the mask of the query below, of the full mask in its box and of the small one made from it.
_FULL = "CASE WHEN m{0}y + {{0}} BETWEEN 1 AND h AND m{1}x + {{1}} BETWEEN 1 AND w AND ((m{0}y + {{0}} - 1) * 5 + (m{1}x + {{1}} - 1) * 3 + box) % 7 < 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
_SMALL = {(a, b): f"CASE WHEN ly + {a} BETWEEN 1 AND 28 AND lx + {b} BETWEEN 1 AND 28 AND {_sampled(_FULL.format(a, b), f'g{a}y', f'g{b}x')} > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for a in (0, 1) for b in (0, 1)}
_MASKS = with_views(V.BOXES) + f""", b AS (SELECT image, box, CAST(y2 - y1 AS INT) AS h, CAST(x2 - x1 AS INT) AS w FROM boxes), p AS (SELECT *, unnest(range(w)) AS j FROM (SELECT *, unnest(range(h)) AS i FROM b)),
 q AS (SELECT *, (i + 0.5::DOUBLE) * 28 / h + 0.5::DOUBLE AS ay, (j + 0.5::DOUBLE) * 28 / w + 0.5::DOUBLE AS ax FROM p), l AS (SELECT *, CAST(floor(ay) AS BIGINT) AS ly, ay - floor(ay) AS fy, CAST(floor(ax) AS BIGINT) AS lx, ax - floor(ax) AS fx FROM q),
 s AS (SELECT *, {", ".join(f"(l{c} + {a} - 1 + 0.5::DOUBLE) * {n} / 28 + 0.5::DOUBLE AS b{a}{c}" for c, n in (("y", "h"), ("x", "w")) for a in (0, 1))} FROM l),
 m AS (SELECT *, {", ".join(f"CAST(floor(b{a}{c}) AS BIGINT) AS m{a}{c}, b{a}{c} - floor(b{a}{c}) AS g{a}{c}" for c in "yx" for a in (0, 1))} FROM s),
 t AS (SELECT *, {", ".join(f"{v} AS s{a}{b}" for (a, b), v in _SMALL.items())} FROM m)
 SELECT image, box, count(*) FILTER ({_sampled("s{0}{1}", "fy", "fx")} >= 0.5) AS pixels, CAST(coalesce(sum(i * 7 + j) FILTER ({_sampled("s{0}{1}", "fy", "fx")} >= 0.5), 0) AS BIGINT) AS places FROM t GROUP BY image, box"""


@query("mask_shapes", _MASKS)
def mask_shapes(spark, sf_dir):
    """Masks with a texture made small, 28 x 28, and full again in their boxes: how many pixels there are, and where."""
    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, _STACK):
            box, y1, x1, y2, x2 = (rows.column(i).to_numpy() for i in range(1, 6))
            pixels, places = np.zeros((2, len(box)), np.int64)
            # Masks of boxes of one size are the bands of an image.
            shape, own = np.unique(np.column_stack([y2 - y1, x2 - x1]), axis=0, return_inverse=True)
            for k, (h, w) in enumerate(shape.tolist()):
                at = np.flatnonzero(own.ravel() == k)
                y, x = np.mgrid[:h, :w]
                full = ((y * 5 + x * 3)[:, :, None] + box[at]) % 7 < 4
                back = images.full_mask(images.small_mask(full, (0, 0, h, w), 28, 28), (0, 0, h, w), h, w)
                pixels[at] = back.sum(axis=(0, 1))
                places[at] = np.einsum("yx,yxn->n", y * 7 + x, back)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(pixels), pa.array(places)], names=["image", "box", "pixels", "places"])

    whole = A.boxes(spark, sf_dir).select("image", F.col("box").cast("long").alias("box"), *[F.col(c).cast("int").alias(c) for c in ("y1", "x1", "y2", "x2")])
    return whole.mapInArrow(run, "image long, box long, pixels long, places long").withColumn("box", F.col("box").cast("int"))


@query("rasterise", with_views(V.DIAMONDS) + "SELECT fid, CAST(2 * r * r + 2 * r + 1 AS BIGINT) AS pixels FROM diamonds")
def rasterise(spark, sf_dir):
    """Polygons as pixels, in the frame of their bounding box."""
    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(batch.column(1)).to_numpy())])
            flat = batch.column(1).flatten()
            yx = np.column_stack([flat.field(c).to_numpy() for c in ("y", "x")])
            # Rings that differ by their place alone are the same in their frame, and made once.
            out = [images.pixels_of((p - p.min(axis=0)).tobytes()) for p in (yx[a:b] for a, b in zip(ends, ends[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], names=["fid", "pixels"])

    return spread(A.diamonds(spark, sf_dir)).mapInArrow(run, "fid long, pixels long")


# Cleaning with polygons.
@query("clean_polygons", with_views(V.CENTROIDS, V.DIAMONDS) + "SELECT image, idx FROM cents c WHERE NOT EXISTS (SELECT 1 FROM diamonds d WHERE abs(c.x - d.cx) + abs(c.y - d.cy) <= d.r)")
def clean_polygons(spark, sf_dir):
    return spatial.outside_polygons(A.centroids(spark, sf_dir), A.diamonds(spark, sf_dir)).select("image", "idx")


@query("clean_polygons_boundary", with_views(V.CENTROIDS, V.DIAMONDS) + "SELECT image, idx FROM cents c WHERE NOT EXISTS (SELECT 1 FROM diamonds d WHERE abs(c.x - d.cx) + abs(c.y - d.cy) <= d.r AND abs(c.x - 240) + abs(c.y - 700) <= 600)")
def clean_polygons_boundary(spark, sf_dir):
    """Only the parts of the polygons inside a boundary remove points."""
    at = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    boundary = F.array(at(-360, 700), at(240, 1300), at(840, 700), at(240, 100))
    return spatial.outside_polygons(A.centroids(spark, sf_dir), A.diamonds(spark, sf_dir), boundary).select("image", "idx")


@query("clean_intersecting", with_views(V.BOXES, V.DIAMONDS) + """SELECT image, box FROM boxes b WHERE NOT EXISTS (SELECT 1 FROM diamonds d WHERE
 greatest(b.x1 - d.cx, 0, d.cx - b.x2) + greatest(b.y1 - d.cy, 0, d.cy - b.y2) <= d.r)""")
def clean_intersecting(spark, sf_dir):
    """Shapes that a polygon touches or holds go."""
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    b = A.boxes(spark, sf_dir).select("image", "box", F.array(at("x1", "y1"), at("x2", "y1"), at("x2", "y2"), at("x1", "y2")).alias("ring"))
    return spatial.clear_of_polygons(b, A.diamonds(spark, sf_dir), ["image", "box"]).select("image", "box")


@query("ring_text", with_views(V.DIAMONDS) + """SELECT fid, 'POLYGON ((' || (cx - r) || ' ' || cy || ', ' || cx || ' ' || (cy + r) || ', ' || (cx + r) || ' ' || cy || ', ' || cx || ' ' || (cy - r) || ', ' || (cx - r) || ' ' || cy || '))' AS wkt, true AS simple FROM diamonds""")
def ring_text(spark, sf_dir):
    """Well-known text of rings, and whether no two of their edges cross."""
    return A.diamonds(spark, sf_dir).select("fid", geometry.wkt(F.col("ring")).alias("wkt"), geometry.is_simple(F.col("ring")).alias("simple"))


# Repair and union.
@query("repair_rings", """SELECT p_partkey AS fid, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS rings, round(CASE p_partkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 7 END * r * r, 3) + 0.0 AS area,
 round(CASE p_partkey % 3 WHEN 0 THEN 4 + 4 * sqrt(2) WHEN 1 THEN 8 ELSE 12 END * r, 3) + 0.0 AS perimeter FROM (SELECT *, CAST(p_size % 6 + 1 AS DOUBLE) AS r FROM part)""")
def repair_rings(spark, sf_dir):
    """Rings that cross themselves as valid ones: how many, their area and perimeter, against what their shapes have."""
    fixed = overlay.repaired(spread(A.tangles(spark, sf_dir)), ["fid"]).withColumn("p", overlay.perimeter(F.col("ring")))
    return fixed.groupBy("fid").agg(F.count(F.lit(1)).cast("int").alias("rings"), (F.round(F.sum("area"), 3) + 0.0).alias("area"), (F.round(F.sum("p"), 3) + 0.0).alias("perimeter"))


def _strips(x: str, y: str) -> str:
    """Strips between the ends of the rectangles of a layer along x: in each, the intervals along y that are covered."""
    return f"""l{x} AS (SELECT layer, lo, lead(lo) OVER (PARTITION BY layer ORDER BY lo) AS hi FROM (SELECT layer, {x}0 AS lo FROM layers UNION SELECT layer, {x}1 FROM layers)),
 a{x} AS (SELECT l.layer, l.lo, l.hi, r.{y}0 AS y0, r.{y}1 AS y1, max(r.{y}1) OVER (PARTITION BY l.layer, l.lo ORDER BY r.{y}0, r.{y}1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM l{x} l JOIN layers r ON l.layer = r.layer AND r.{x}0 <= l.lo AND r.{x}1 >= l.hi WHERE l.hi > l.lo),
 s{x} AS (SELECT layer, sum((hi - lo) * greatest(y1 - greatest(coalesce(before, y0), y0), 0)) AS area, sum(CASE WHEN before IS NULL OR before < y0 THEN 2 * (hi - lo) ELSE 0 END) AS along FROM a{x} GROUP BY layer)"""


@query("dissolve_union", with_views(V.LAYERS, _strips("x", "y"), _strips("y", "x")) + "SELECT layer, round(sx.area, 3) + 0.0 AS area, round(sx.along + sy.along, 3) + 0.0 AS perimeter FROM sx JOIN sy USING (layer)")
def dissolve_union(spark, sf_dir):
    """The union of the rectangles of each layer as rings: area and perimeter."""
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    shapes = A.clean_layers(spark, sf_dir).select("layer", "fid", F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1")).alias("ring"))
    rings = overlay.dissolved(spread(shapes), ["fid"], ["layer"]).withColumn("p", overlay.perimeter(F.col("ring")))
    return rings.groupBy("layer").agg((F.round(F.sum("area"), 3) + 0.0).alias("area"), (F.round(F.sum("p"), 3) + 0.0).alias("perimeter"))


# Result layers.
_LAYER = """names AS (SELECT image, split_part(split_part(path, '/', -1), '.tif', 1) AS image_name FROM scenes)"""


@query("result_layer", with_views(V.SCENES, V.VERTICES, _LAYER, """edges AS (SELECT image, k, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS qx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS qy
 FROM vertices WINDOW w AS (PARTITION BY image ORDER BY k)), sums AS (SELECT image, count(*) AS n, sum(x * qy - qx * y) AS t, sum(sqrt((qx - x) * (qx - x) + (qy - y) * (qy - y))) AS p FROM edges GROUP BY image)""") + """SELECT image_name, '1' AS "Class", substr(image_name, 1, 4) AS "Sensor", substr(image_name, 6, 8) AS "Date",
 substr(image_name, 14, 6) AS "Time", substr(image_name, 21, 16) AS "CatalogID", round(abs(t) / 2, 3) + 0.0 AS "Area", round(p, 3) + 0.0 AS "Perimeter" FROM sums JOIN names USING (image) WHERE n > 2""")
def result_layer(spark, sf_dir):
    """The attributes of a result layer for each ring, from the scene's name and the ring's measures."""
    name = F.substring_index(F.element_at(F.split("path", "/"), -1), ".tif", 1)
    named = A.scenes(spark, sf_dir).select("image", name.alias("image_name"))
    m = spatial.measure(A.vertices(spark, sf_dir), ["image"]).filter("vertices > 2").join(named, "image").withColumn("class_id", F.lit(1))
    return flow.attributes(m).select("image_name", "Class", "Sensor", "Date", "Time", "CatalogID", "Area", "Perimeter")


@query("run_id", "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS run_id FROM events")
def run_id(spark, sf_dir):
    """The time of a run as the name of its folder."""
    return table(spark, sf_dir, "events").select("event_id", flow.run_id(F.col("ts")).alias("run_id"))


@query("latest_checkpoint", """SELECT o_orderkey % 7 AS run, max(CAST(o_orderkey % 40 AS INT)) AS epoch, 'mask_rcnn_run' || (o_orderkey % 7) || '_' || lpad(CAST(max(o_orderkey % 40) AS VARCHAR), 4, '0') || '.h5' AS name FROM orders GROUP BY o_orderkey % 7""")
def latest_checkpoint(spark, sf_dir):
    """The last checkpoint of each run, by the number in its name."""
    k = F.col("o_orderkey")
    name = F.concat(F.lit("mask_rcnn_run"), (k % 7).cast("string"), F.lit("_"), F.lpad((k % 40).cast("string"), 4, "0"), F.lit(".h5"))
    epoch = F.regexp_extract(name, r"_(\d{4})\.h5$", 1).cast("int")
    return table(spark, sf_dir, "orders").select((k % 7).alias("run"), epoch.alias("epoch"), name.alias("name")).groupBy("run").agg(F.max("epoch").alias("epoch"), F.max_by("name", "epoch").alias("name"))


@query("window_boxes", with_views(V.BOXES) + """SELECT image, box, CAST(round_even(((y1 / 127 - 10 / 127.0::DOUBLE) / (90 / 127.0::DOUBLE)) * 199, 0) AS INT) AS y1, CAST(round_even((((x2 - 1) / 127 - 4 / 127.0::DOUBLE) / (110 / 127.0::DOUBLE)) * 299 + 1, 0) AS INT) AS x2 FROM boxes""")
def window_boxes(spark, sf_dir):
    """Boxes of a padded image of 128 in the pixels of the image before, of 200 x 300, which fills the window 10, 4, 101, 115."""
    window = tuple(map(F.lit, (10.0, 4.0, 101.0, 115.0)))
    n = B.normalise(B.box(), F.lit(128), F.lit(128))
    back = B.from_window(n, B.normalise(window, F.lit(128), F.lit(128)), F.lit(200), F.lit(300))
    return A.boxes(spark, sf_dir).select("image", "box", back[0].alias("y1"), back[3].alias("x2"))
