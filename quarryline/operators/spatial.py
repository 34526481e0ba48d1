"""Spatial joins on equality keys: tile-block neighbourhoods, close pairs, point in polygon, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship
from . import covering

RADIUS = 10.0
#: Pairs of an image that one task solves at most (a few MB).
GRAPH = 200_000
#: Corners of a shape whose edges are compared with all that its bounding box meets.
CORNERS = 32
#: Points of a grid, times the edges that they are tested against, that are held at once.
GRID = 1 << 18
#: Twice the area up to which a ring counts as flat.
FLAT = 1e-3


def _blocks(i: Column) -> Column:
    """The blocks of 4 tiles at stride 3 that hold tile i along one axis."""
    own = F.floor(i / 3).cast("int")
    return F.array_distinct(F.array(own, F.greatest(F.floor((i - 1) / 3), F.lit(0)).cast("int")))


def block_members(df: DataFrame) -> DataFrame:
    """Each polygon once for each block that its tile is in."""
    return df.withColumn("bi", F.explode(_blocks(F.col("id_i")))).withColumn("bj", F.explode(_blocks(F.col("id_j"))))


def close_pairs(df: DataFrame, radius: float = RADIUS) -> DataFrame:
    """image, a, b (a < b): polygons of a common block whose centroids are nearer than the radius but not equal.

    The join is on (image, block) and a radius cell, so neither a large image nor a crowded block meets in one task:
    a point is tested against the points of its own and the neighbouring cells of the block only. It is merged by hint:
    the copies are not in Spark's estimate of a side's size, by which it would broadcast what is some hundred MB."""
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    m = block_members(df).withColumn("cx", cell("x")).withColumn("cy", cell("y"))
    near = F.expr("sequence(-1L, 1L)")
    left = m.select("image", "bi", "bj", F.col("idx").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), "cx", "cy")
    right = m.withColumn("dx", F.explode(near)).withColumn("dy", F.explode(near)).select(
        "image", "bi", "bj", F.col("idx").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")
    )
    d = F.sqrt((F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by")))
    met = left.hint("merge").join(right, ["image", "bi", "bj", "cx", "cy"]).filter(F.col("a") < F.col("b")).withColumn("d", d)
    return met.filter((F.col("d") > 0) & (F.col("d") < radius)).select("image", "a", "b").distinct()


def _checkpoint_dir(spark: SparkSession) -> None:
    """Set the cluster's shared folder (spark.checkpoint.dir). Only a local master may leave it unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quarryline-cp-"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder for tables, in the folder that all executors share."""
    _checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the cluster's shared folder."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _roots(table: pa.Table) -> pa.Table:
    """The components of one image's pairs."""
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, label = ends[: len(a)], ends[len(a) :], np.arange(len(ids))
    while True:
        new = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    image = pa.array([table.column("image")[0].as_py()] * len(ids), table.schema.field("image").type)
    return pa.table({"image": image, "idx": pa.array(ids), "root": pa.array(ids[label])})


def components(pairs: DataFrame) -> DataFrame:
    """image, idx, root for every polygon in a pair; root is the least id of its component. The pairs of an image are
    solved in one task where there are at most GRAPH of them, which is checked; the pairs of larger images stay
    distributed, and labels travel along them."""
    ship(pairs.sparkSession)
    edges = checkpointed(pairs.select("image", "a", "b"))
    large = edges.groupBy("image").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GRAPH).select("image")
    kind = dict(pairs.dtypes)
    schema = f"image {kind['image']}, idx {kind['a']}, root {kind['a']}"
    if not large.limit(1).count():
        return edges.groupBy("image").applyInArrow(_roots, schema)
    small = edges.join(large, "image", "left_anti").groupBy("image").applyInArrow(_roots, schema)
    return small.unionByName(_spread(edges.join(large, "image", "left_semi")))


def _spread(pairs: DataFrame) -> DataFrame:
    """Components by turns: least labels travel along the pairs and jump to their labels' labels, so chains shrink by
    half and more in a turn. Labels are as many as there are ends of pairs, whatever Spark's estimate, so they are merged."""
    edges = checkpointed(pairs.select("image", "a", "b").unionByName(pairs.select("image", F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = edges.groupBy("image", F.col("a").alias("idx")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    labels = checkpointed(labels)
    while True:
        around = edges.hint("merge").join(labels.select("image", F.col("idx").alias("b"), "root"), ["image", "b"]).groupBy("image", F.col("a").alias("idx")).agg(F.min("root").alias("near"))
        far = labels.select("image", F.col("idx").alias("root"), F.col("root").alias("far"))
        new = labels.hint("merge").join(around, ["image", "idx"]).hint("merge").join(far, ["image", "root"], "left")
        new = checkpointed(new.select("image", "idx", F.least("root", "near", F.coalesce("far", "root")).alias("new"), "root"))
        if not new.filter("new <> root").limit(1).count():
            return new.select("image", "idx", F.col("new").alias("root"))
        labels = new.select("image", "idx", F.col("new").alias("root"))


def deduplicate(df: DataFrame, radius: float = RADIUS) -> DataFrame:
    """The polygons that stay: those in no pair, and the least of each component."""
    gone = components(close_pairs(df, radius)).filter("idx <> root").select("image", "idx")
    return df.join(gone, ["image", "idx"], "left_anti")


def _level(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """The level whose cells, `size` * 4 ** level wide, are at least as large as the rectangle."""
    side = F.greatest(x1 - x0, y1 - y0, F.lit(size))
    return F.ceil(F.log2(side / size) / 2 - 1e-9).cast("int")


def in_cells(rectangles: DataFrame, levels: list[int] | None = None, size: float = 64.0, corners: tuple[str, ...] = ("x0", "y0", "x1", "y1")) -> DataFrame:
    """Rectangles with level, cx, cy: of each level from their own on (of `levels`, or only their own), the cells that
    they cover, at most four of a level, whatever their size."""
    c = [F.col(x).cast("double") for x in corners]
    at = _level(*c, size)
    r = rectangles.withColumn("own_level", at)
    r = r.withColumn("level", F.col("own_level")) if levels is None else r.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, levels)), lambda n: n >= F.col("own_level"))))
    wide = F.lit(size) * F.pow(F.lit(4.0), F.col("level"))
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / wide), F.floor(hi / wide)))
    return r.withColumn("cx", cells(c[0], c[2])).withColumn("cy", cells(c[1], c[3]))


def levels_of(rectangles: DataFrame, size: float = 64.0, corners: tuple[str, ...] = ("x0", "y0", "x1", "y1")) -> dict[int, int]:
    """The levels that occur, a logarithm of the largest side, so few, and how many rectangles each has."""
    c = [F.col(x).cast("double") for x in corners]
    return {r[0]: r[1] for r in sorted(rectangles.groupBy(_level(*c, size).alias("level")).count().filter("level is not null").collect())}


def largest(rectangles: DataFrame) -> DataFrame:
    """x0, y0, x1, y1 without the rectangles that another one with the same lower corner holds: what they cover together is
    the same, and layers on a grid have as many corners as the grid, however many rectangles there are."""
    wide = rectangles.groupBy("x0", "y0", "x1").agg(F.max("y1").alias("y1"))
    wider = Window.partitionBy("x0", "y0").orderBy(F.desc("x1")).rowsBetween(Window.unboundedPreceding, -1)
    high = wide.withColumn("high", F.max("y1").over(wider))
    return high.filter(F.col("high").isNull() | (F.col("y1") > F.col("high"))).select("x0", "y0", "x1", "y1")


def outside(points: DataFrame, rectangles: DataFrame, size: float = 16.0) -> DataFrame:
    """Points in none of the rectangles; the border counts as inside. The join keys are cells whose size goes with that
    of the rectangle, so a large one is in as few cells as a small one; each of the few sizes is a join of its own, and
    the rectangles of a size are broadcast where they are few, so a large one is no hot key."""
    rectangles = checkpointed(largest(rectangles))
    r = in_cells(rectangles, size=size).select("level", "cx", "cy", "x0", "y0", F.col("x1").alias("xe"), F.col("y1").alias("ye"))
    for level, n in levels_of(rectangles, size).items():
        wide = size * 4.0**level
        own = r.filter(F.col("level") == level)
        own = F.broadcast(own) if n <= covering.BROADCAST_CELLS // 4 else own.hint("merge")
        here = (F.floor(points.x / wide) == own.cx) & (F.floor(points.y / wide) == own.cy)
        points = points.join(own, here & (points.x >= own.x0) & (points.x <= own.xe) & (points.y >= own.y0) & (points.y <= own.ye), "left_anti")
    return points


def _apart(left: DataFrame, right: DataFrame, own: tuple[str, ...], far: tuple[str, ...], size: float, hit: Callable[[DataFrame, DataFrame], Column], whole: DataFrame | None = None) -> DataFrame:
    """Rows of left (rectangles `own`) whose rectangle meets none of right's (`far`) that `hit` accepts. A row meets the other
    side on the larger of their two levels, a join for each: by the cell of its lower corner alone, for a rectangle of right
    is in all cells where one that reaches it may have its corner. So no row of left is copied, and where those of right are
    few they are broadcast and a crowd on the left is no hot key. What lies beyond all of left goes first; levels and ends are
    those of `whole`, if left is what joins have left of it."""
    x0, y0, x1, y1 = own
    at = _level(*[F.col(c).cast("double") for c in own], size)
    ends = [f(c).alias(c) for f, c in ((F.min, x0), (F.min, y0), (F.max, x1), (F.max, y1))]
    found = (left if whole is None else whole).groupBy(at.alias("_level")).agg(*ends).filter("_level is not null").collect()
    if not found:
        return left
    low, high = ([f(r[c] for r in found if r[c] is not None) for c in names] for f, names in ((min, (x0, y0)), (max, (x1, y1))))
    right = right.filter((F.col(far[0]) <= high[0]) & (F.col(far[2]) >= low[0]) & (F.col(far[1]) <= high[1]) & (F.col(far[3]) >= low[1]))
    right = checkpointed(right.withColumn("lb", _level(*map(F.col, far), size)))
    lb = {r[0]: r[1] for r in right.groupBy("lb").count().filter("lb is not null").collect()}
    left = left.withColumn("_level", at)
    for level in sorted({*(r[0] for r in found), *lb}, reverse=True):
        wide, n = size * 4.0**level, sum(n for k, n in lb.items() if k <= level)
        if not n:
            continue
        # A hair more than the cell, as a level is rounded.
        cells = lambda lo, hi: F.explode(F.sequence(F.floor((F.col(lo) - 1.001 * wide) / wide), F.floor(F.col(hi) / wide)))
        r = right.filter(F.col("lb") <= level).withColumn("cell_x", cells(far[0], far[2])).withColumn("cell_y", cells(far[1], far[3]))
        r = F.broadcast(r) if n <= covering.BROADCAST_CELLS // 4 else r.hint("merge")
        here = (F.floor(left[x0] / wide) == r.cell_x) & (F.floor(left[y0] / wide) == r.cell_y) & (F.greatest(left._level, r.lb) == level)
        near = (left[x0] <= r[far[2]]) & (left[x1] >= r[far[0]]) & (left[y0] <= r[far[3]]) & (left[y1] >= r[far[1]])
        left = left.join(r, here & near & hit(left, r), "left_anti")
    return left.drop("_level")


def clear_of(boxes: DataFrame, rectangles: DataFrame, size: float = 8.0) -> DataFrame:
    """Boxes (x1, y1, x2, y2) that touch none of the rectangles; borders that touch intersect."""
    far = ("x0", "y0", "xe", "ye")
    return _apart(boxes, largest(rectangles).toDF(*far), ("x1", "y1", "x2", "y2"), far, size, lambda *_: F.lit(True))


def outside_polygons(points: DataFrame, polygons: DataFrame, boundary: Column | None = None) -> DataFrame:
    """Points in none of the polygons (`ring`, an array of x, y, or `geometry`, an array of rings, of which those in others
    are holes); the line counts as inside. With a boundary, a ring of its own, only what is inside it removes a point.
    Points meet the cells of the polygons' coverings; polygons that are the same are covered once."""
    column = "geometry" if "geometry" in polygons.columns else "ring"
    return covering.meeting(points, checkpointed(covering.cells(polygons.select(column).distinct(), ring=column)), "left_anti", None if boundary is None else covers(boundary, points.x, points.y))


def segments(rings: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """keys, px, py, qx, qy and the bounding box (x0, y0, x1, y1) of each edge."""
    e = rings.filter(F.size(ring) > 2).select(*keys, F.explode(edges_of(F.col(ring))).alias("e")).select(*keys, "e.*")
    return e.select("*", F.least("px", "qx").alias("x0"), F.least("py", "qy").alias("y0"), F.greatest("px", "qx").alias("x1"), F.greatest("py", "qy").alias("y1"))


def touching(a: DataFrame, b: DataFrame, keys: list[str], size: float = 8.0) -> DataFrame:
    """keys of a for each pair of segments of a and b that cross or touch. They meet in the cells of the longer one's
    size; on each level the side with the long ones is broadcast where it is small."""
    far = {c: f"{c}_b" for c in ("px", "py", "qx", "qy", "x0", "y0", "x1", "y1")}
    b = b.select(*[F.col(c).alias(n) for c, n in far.items()])
    corners = ("x0_b", "y0_b", "x1_b", "y1_b")
    la, lb = levels_of(a, size), levels_of(b, size, corners)
    found = None
    for level in sorted({*la, *lb}):
        left = in_cells(a, [level], size).withColumnRenamed("own_level", "la").drop("level")
        right = in_cells(b, [level], size, corners).withColumnRenamed("own_level", "lb").drop("level")
        for one, two, n in ((left, right.filter(F.col("lb") == level), lb.get(level, 0)), (left.filter(F.col("la") == level), right.filter(F.col("lb") < level), sum(n for k, n in lb.items() if k < level))):
            if not n:
                continue
            two = F.broadcast(two) if n <= covering.BROADCAST_CELLS // 4 else two
            near = F.expr("x0 <= x1_b and x1 >= x0_b and y0 <= y1_b and y1 >= y0_b")
            e, f = (F.struct(*[F.col(n).alias(c) for c, n in list(names.items())[:4]]) for names in ({c: c for c in far}, far))
            met = one.join(two, ["cx", "cy"]).filter(near & _meet(e, f)).select(*keys)
            found = met if found is None else found.unionByName(met)
    return a.select(*keys).limit(0) if found is None else found


def clear_of_polygons(shapes: DataFrame, polygons: DataFrame, keys: list[str]) -> DataFrame:
    """Shapes (`ring`, told apart by keys) that meet none of the polygons: no edges cross or touch, and neither holds
    the other. A corner of each shape meets the cells of the polygons. Then shapes of few corners meet the edges of the
    polygons by their bounding boxes, and an edge that crosses one or starts in it removes it; of larger ones the cells
    meet a corner of each polygon, and edges meet edges where no corner was inside."""
    rings = checkpointed(polygons.filter(F.size("ring") > 2).select("ring").distinct())
    held, whole = checkpointed(covering.cells(rings)), shapes
    corner = lambda k: F.col("ring")[k]
    for k in (0, 2):  # one would do, the other makes what is left fewer
        at = corner(k)
        shapes = covering.meeting(shapes.withColumn("x", F.when(F.size("ring") > 2, at["x"])).withColumn("y", at["y"]), held, "left_anti").drop("x", "y")
    small = F.coalesce(F.size("ring") <= CORNERS, F.lit(True))
    ends = {n: f(F.col(f"ring.{c}")) for n, f, c in (("_x0", F.array_min, "x"), ("_y0", F.array_min, "y"), ("_x1", F.array_max, "x"), ("_y1", F.array_max, "y"))}

    def hit(a: DataFrame, b: DataFrame) -> Column:
        f = F.struct(b.px.alias("px"), b.py.alias("py"), b.qx.alias("qx"), b.qy.alias("qy"))
        return (F.size(a.ring) > 2) & (F.exists(a["_edges"], lambda e: _meet(e, f)) | covers(a["_edges"], b.px, b.py, edges=True))

    few = shapes.filter(small).withColumns(ends).withColumn("_edges", edges_of(F.col("ring")))
    few = _apart(few, segments(rings, []).distinct(), tuple(ends), ("x0", "y0", "x1", "y1"), 8.0, hit, whole.filter(small).withColumns(ends)).drop(*ends, "_edges")
    return few.unionByName(_clear_of_edges(shapes.filter(~small), rings, keys)) if whole.filter(~small).limit(1).count() else few


def _clear_of_edges(shapes: DataFrame, rings: DataFrame, keys: list[str]) -> DataFrame:
    """Shapes that hold no corner of a ring and touch none of its edges."""
    tips = rings.select(F.col("ring")[0]["x"].alias("x"), F.col("ring")[0]["y"].alias("y")).distinct()
    for met in covering.meeting(tips, checkpointed(covering.cells(shapes, tuple(keys))), "inner", kept=tuple(keys)):
        shapes = shapes.join(met.select(*keys).distinct(), keys, "left_anti")
    shapes = checkpointed(shapes)
    return shapes.join(touching(segments(shapes, keys), segments(rings, []), keys).distinct(), keys, "left_anti")


def _grid_within(ring: np.ndarray, step: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """x and y of the grid points strictly inside a ring, some rows of the grid at a time: its edges times its points are
    bounded, as far as a row of the grid is."""
    px, py = (v[:, None, None] for v in ring.T)
    qx, qy = (np.roll(v, -1, axis=0) for v in (px, py))
    low, high = np.ceil(ring.min(axis=0) / step), np.floor(ring.max(axis=0) / step)
    x = np.arange(low[0], high[0] + 1) * step
    rows = max(1, GRID // max(1, len(ring) * len(x)))
    for first in np.arange(low[1], high[1] + 1, rows):
        y = np.arange(first, min(first + rows, high[1] + 1))[:, None] * step
        cross = (qx - px) * (y - py) - (qy - py) * (x - px)
        right = ((py > y) != (qy > y)) & ((cross > 0) == (qy > py))
        on = (cross == 0) & (x >= np.minimum(px, qx)) & (x <= np.maximum(px, qx)) & (y >= np.minimum(py, qy)) & (y <= np.maximum(py, qy))
        j, i = np.nonzero((right.sum(axis=0) % 2 == 1) & ~on.any(axis=0))
        yield x[i], y[j, 0]


def points_within(rings: DataFrame, step: float) -> DataFrame:
    """image, gx, gy: grid points strictly inside each ring (array `ring` of x, y structs), by crossing number. The
    bounding box bounds the grid; a point on an edge is outside."""
    ship(rings.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, flat = pa.compute.list_value_length(batch.column(1)).to_numpy(), batch.column(1).flatten()
            xy = np.column_stack([flat.field(c).to_numpy() for c in ("x", "y")])
            held: list[tuple[int, np.ndarray, np.ndarray]] = []
            points = 0
            for k, end in enumerate(np.cumsum(n)):
                for x, y in _grid_within(xy[end - n[k] : end], step):
                    held.append((k, x, y))
                    points += len(x)
                    if points >= GRID:
                        yield out(batch, held)
                        held, points = [], 0
            if held:
                yield out(batch, held)

    def out(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
        own = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), *(pa.array(np.concatenate([h[c] for h in held])) for c in (1, 2))], names=["image", "gx", "gy"])

    double = F.transform("ring", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    whole = rings.select("image", double.alias("ring")).filter((F.size("ring") > 0) & ~F.exists("ring", lambda p: p["x"].isNull() | p["y"].isNull()))
    return whole.mapInArrow(run, f"image {dict(rings.dtypes)['image']}, gx double, gy double")


def edges_of(ring: Column) -> Column:
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda p, q: F.struct(p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy")))


def _side(e: Column, x: Column, y: Column) -> Column:
    """Positive left of an edge, negative right of it, 0 on its line."""
    return (e["qx"] - e["px"]) * (y - e["py"]) - (e["qy"] - e["py"]) * (x - e["px"])


def _meet(e: Column, f: Column) -> Column:
    """Whether two edges cross or touch."""

    def between(e, x, y):
        return (x >= F.least(e["px"], e["qx"])) & (x <= F.greatest(e["px"], e["qx"])) & (y >= F.least(e["py"], e["qy"])) & (y <= F.greatest(e["py"], e["qy"]))

    s1, s2, s3, s4 = _side(e, f["px"], f["py"]), _side(e, f["qx"], f["qy"]), _side(f, e["px"], e["py"]), _side(f, e["qx"], e["qy"])
    touching = ((s1 == 0) & between(e, f["px"], f["py"])) | ((s2 == 0) & between(e, f["qx"], f["qy"])) | ((s3 == 0) & between(f, e["px"], e["py"])) | ((s4 == 0) & between(f, e["qx"], e["qy"]))
    return ((s1 * s2 < 0) & (s3 * s4 < 0)) | touching


def intersects(a: Column, b: Column) -> Column:
    """Whether two rings have a point in common, on their lines or inside."""
    lines = F.exists(edges_of(a), lambda e: F.exists(edges_of(b), lambda f: _meet(e, f)))
    return lines | inside(a, b[0]["x"], b[0]["y"]) | inside(b, a[0]["x"], a[0]["y"])


def covers(ring: Column, x: Column, y: Column, edges: bool = False) -> Column:
    """Inside or on the line; the ring may be given as its edges."""
    return _within(ring if edges else edges_of(ring), x, y, True)


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Strictly inside: an odd number of edges right of the point, and on none of them."""
    return _within(edges_of(ring), x, y, False)


def _within(edges: Column, x: Column, y: Column, line: bool) -> Column:
    def cross(e):
        return (e["qx"] - e["px"]) * (y - e["py"]) - (e["qy"] - e["py"]) * (x - e["px"])

    def on(e):
        within = (x >= F.least(e["px"], e["qx"])) & (x <= F.greatest(e["px"], e["qx"])) & (y >= F.least(e["py"], e["qy"])) & (y <= F.greatest(e["py"], e["qy"]))
        return within & (cross(e) == 0)

    def right(e):
        return ((e["py"] > y) != (e["qy"] > y)) & ((cross(e) > 0) == (e["qy"] > e["py"]))

    odd = F.size(F.filter(edges, right)) % 2 == 1
    return odd | F.exists(edges, on) if line else odd & ~F.exists(edges, on)


def measure(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """vertices, area, perimeter, centroid_x, centroid_y of each closed ring of (k, x, y) rows: sums over its edges, from
    each vertex to the next and from the last to the first. Rings without area have no centroid."""
    w = Window.partitionBy(*keys).orderBy("k")
    edges = vertices.select(
        *keys, "x", "y", *[F.coalesce(F.lead(c).over(w), F.first(c).over(w)).alias(f"q{c}") for c in ("x", "y")]
    ).withColumn("cross", F.col("x") * F.col("qy") - F.col("qx") * F.col("y"))
    dx, dy = F.col("qx") - F.col("x"), F.col("qy") - F.col("y")
    sums = edges.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("vertices"), F.sum("cross").alias("twice"), F.sum(F.sqrt(dx * dx + dy * dy)).alias("perimeter"),
        F.sum((F.col("x") + F.col("qx")) * F.col("cross")).alias("sx"), F.sum((F.col("y") + F.col("qy")) * F.col("cross")).alias("sy"),
    )
    solid = F.abs("twice") > FLAT
    return sums.select(
        *keys, "vertices", (F.abs("twice") / 2).alias("area"), "perimeter",
        *[F.when(solid, F.col(s) / (F.col("twice") * 3)).alias(c) for s, c in (("sx", "centroid_x"), ("sy", "centroid_y"))],
    )


def measures(ring: Column) -> list[Column]:
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    pair = F.zip_with(ring, after, lambda p, q: F.struct(p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy")))
    total = lambda f: F.aggregate(pair, F.lit(0.0), lambda s, e: s + f(e))
    cross = lambda e: e["px"] * e["qy"] - e["qx"] * e["py"]
    twice = total(cross)
    flat = F.abs(twice) <= FLAT
    return [
        F.size(ring).alias("vertices"), (F.abs(twice) / 2).alias("area"),
        total(lambda e: F.sqrt((e["qx"] - e["px"]) * (e["qx"] - e["px"]) + (e["qy"] - e["py"]) * (e["qy"] - e["py"]))).alias("perimeter"),
        F.when(~flat, total(lambda e: (e["px"] + e["qx"]) * cross(e)) / (twice * 3)).alias("centroid_x"),
        F.when(~flat, total(lambda e: (e["py"] + e["qy"]) * cross(e)) / (twice * 3)).alias("centroid_y"),
    ]
