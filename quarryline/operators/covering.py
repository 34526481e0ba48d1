"""Coverings of polygons by quadtree cells, so that points and shapes meet them by equality of cells.

A cell that no edge touches lies inside or is left out; inside, nothing has to be computed. A cell on the border carries
the edges that touch it, at most EDGES unless many meet in a point, and whether its lower right corner is inside. A point
of the cell is inside if the way right to the cell's side and down to the corner crosses an odd number of edges, or none,
as the corner is outside or inside. So no point sees a whole ring, and a polygon over the whole map is some cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

EDGES = 8
#: Levels below the first cells at which a crowd of edges is left as it is.
DEPTH = 24
#: Side of a cell of level 0; a level more doubles it. No line of the grid goes through a coordinate that a layer has.
SIZE, OFFSET = 64.0, 0.03678794411714423
#: Cells of a level that are broadcast at most; a few hundred bytes each.
BROADCAST_CELLS = 100_000
EDGE = "struct<px:double,py:double,qx:double,qy:double>"


def _side(edges: np.ndarray, x, y) -> np.ndarray:
    """Whether a point is left of each edge (px, py, qx, qy); one on its line counts as a little above."""
    dx, dy = edges[:, 2] - edges[:, 0], edges[:, 3] - edges[:, 1]
    c = dx * (y - edges[:, 1]) - dy * (x - edges[:, 0])
    return (c > 0) | ((c == 0) & (dx > 0))


def _crossed(edges: np.ndarray, x, y, right, low) -> np.ndarray:
    """Whether the way from x, y to the side and down to the corner crosses each edge an odd number of times."""
    turn = _side(edges, right, y)
    along = ((edges[:, 1] > y) != (edges[:, 3] > y)) & (_side(edges, x, y) != turn)
    down = ((edges[:, 0] > right) != (edges[:, 2] > right)) & (turn != _side(edges, right, low))
    return along != down


def _touched(edges: np.ndarray, x, y, side) -> np.ndarray:
    """Whether each edge may touch its cell; a hair beyond counts."""
    slack = side * 1e-9
    x0, y0, x1, y1 = x - slack, y - slack, x + side + slack, y + side + slack
    px, py, qx, qy = edges.T
    near = (np.minimum(px, qx) <= x1) & (np.maximum(px, qx) >= x0) & (np.minimum(py, qy) <= y1) & (np.maximum(py, qy) >= y0)
    dx, dy = qx - px, qy - py
    corners = [dx * (b - py) - dy * (a - px) for a in (x0, x1) for b in (y0, y1)]
    least, most = np.minimum.reduce(corners), np.maximum.reduce(corners)
    room = 1e-12 * (np.abs(dx) + np.abs(dy)) * (np.abs(px) + np.abs(py) + side)
    return near & (least <= room) & (most >= -room)


class Cells:
    """Cells of several rings: of each its ring, level, place, and whether it is inside and has its corner inside; where
    its edges start (and the end) in `edges`."""

    def __init__(self, ring, level, cx, cy, inner, corner, starts, edges):
        self.ring, self.level, self.cx, self.cy = ring, level, cx, cy
        self.inner, self.corner, self.starts, self.edges = inner, corner, starts, edges


def cover(rings: list[np.ndarray], limit: int = EDGES, depth: int = DEPTH, polygon: np.ndarray | None = None) -> Iterator[Cells]:
    """The coverings of rings, all together, a step of levels each. With `polygon`, ascending numbers from 0, the rings of
    a number are one polygon: what an odd number of them holds."""
    edges = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings])
    owner = np.repeat(np.arange(len(rings)) if polygon is None else polygon, [len(r) for r in rings])
    size = np.bincount(owner)
    first_of = np.cumsum(size) - size
    low, high = np.minimum.reduceat(edges[:, :2], first_of), np.maximum.reduceat(edges[:, :2], first_of)
    top = np.ceil(np.log2(np.maximum((high - low).max(axis=1), 1e-9) / SIZE)).astype(np.int64)
    wide = SIZE * 2.0**top
    first, last = (np.floor((v - OFFSET) / wide[:, None]).astype(np.int64) for v in (low, high))
    # A ring starts with the cells of its own size, four at most, each with all edges that may touch it.
    parts, n = [], 0
    for a in (0, 1):
        for b in (0, 1):
            there = (first[:, 0] + a <= last[:, 0]) & (first[:, 1] + b <= last[:, 1])
            number = np.cumsum(there) - 1 + n
            own = np.flatnonzero(there[owner])
            parts.append((np.flatnonzero(there), first[there, 0] + a, first[there, 1] + b, number[owner[own]], own))
            n += int(there.sum())
    ring, cx, cy, cell, own = (np.concatenate(v) for v in zip(*parts[:4]))
    level, side = top[ring], wide[ring]
    x, y = (OFFSET + (cx + 1) * side)[cell], (OFFSET + cy * side)[cell]
    e = edges[own]
    beyond = ((e[:, 1] > y) != (e[:, 3] > y)) & (_side(e, x, y) == (e[:, 3] > e[:, 1]))
    corner = np.bincount(cell[beyond], minlength=len(cx)) % 2 == 1
    hit = _touched(e, x - side[cell], y, side[cell])
    cell, own = cell[hit], own[hit]
    for turn in range(depth + 1):
        n = np.bincount(cell, minlength=len(cx))
        done = (n <= limit) | (turn == depth)
        kept = done & ((n > 0) | corner)
        order = np.argsort(cell[done[cell]], kind="stable")
        yield Cells(ring[kept], level[kept], cx[kept], cy[kept], n[kept] == 0, corner[kept], np.concatenate([[0], np.cumsum(n[kept])]), edges[own[done[cell]][order]])
        if done.all():
            return
        number, open_ = np.cumsum(~done) - 1, ~done[cell]
        cell, own = number[cell[open_]], own[open_]
        up, px, py, was, half, below = ring[~done], cx[~done], cy[~done], corner[~done], side[~done] / 2, level[~done] - 1
        right, bottom = OFFSET + (px + 1) * 2 * half, OFFSET + py * 2 * half
        parts = []
        for a in (0, 1):
            for b in (0, 1):
                x, y = px * 2 + a, py * 2 + b
                left, base = OFFSET + x * half, OFFSET + y * half
                odd = _crossed(edges[own], (OFFSET + (x + 1) * half)[cell], base[cell], right[cell], bottom[cell])
                flag = was ^ (np.bincount(cell[odd], minlength=len(px)) % 2 == 1)
                hit = _touched(edges[own], left[cell], base[cell], half[cell])
                parts.append((up, below, half, x, y, flag, cell[hit] + len(parts) * len(px), own[hit]))
        ring, level, side, cx, cy, corner, cell, own = (np.concatenate(v) for v in zip(*parts))


def cells(polygons: DataFrame, keys: tuple[str, ...] = (), ring: str = "ring") -> DataFrame:
    """keys, level, cx, cy, inner, corner, edges: the covering of each ring of three points or more, or of each polygon
    where the column holds arrays of rings."""
    ship(polygons.sparkSession)
    kinds = dict(polygons.dtypes)
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], f"level int, cx long, cy long, inner boolean, corner boolean, edges array<{EDGE}>"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(len(keys))
            rings = lists.flatten()
            flat = np.column_stack([c.to_numpy(zero_copy_only=False) for c in rings.flatten().flatten()])
            split = np.split(flat, np.cumsum(pa.compute.list_value_length(rings).to_numpy())[:-1])
            for c in cover(split, polygon=np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())):
                held = pa.StructArray.from_arrays([pa.array(v) for v in c.edges.T], names=["px", "py", "qx", "qy"])
                columns = [batch.column(i).take(pa.array(c.ring)) for i in range(len(keys))]
                columns += [pa.array(c.level.astype(np.int32)), pa.array(c.cx), pa.array(c.cy), pa.array(c.inner), pa.array(c.corner), pa.ListArray.from_arrays(pa.array(c.starts.astype(np.int32)), held)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "level", "cx", "cy", "inner", "corner", "edges"])

    own = F.col(ring) if kinds[ring].startswith("array<array") else F.array(ring)
    flat = F.transform(F.filter(own, lambda r: F.size(r) > 2), lambda r: F.transform(r, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))))
    return polygons.filter(F.col(ring).isNotNull()).select(*keys, flat.alias("rings")).filter(F.size("rings") > 0).mapInArrow(run, schema)


def _cell(v: Column, side: float) -> Column:
    return F.floor((v - OFFSET) / side)


def _left(e: Column, x: Column, y: Column) -> Column:
    dx = e["qx"] - e["px"]
    c = dx * (y - e["py"]) - (e["qy"] - e["py"]) * (x - e["px"])
    return (c > 0) | ((c == 0) & (dx > 0))


def covered(inner: Column, corner: Column, edges: Column, cx: Column, cy: Column, side: float, x: Column, y: Column) -> Column:
    """Whether a point of a cell is inside or on the line."""
    right, low = F.lit(OFFSET) + (cx + 1) * side, F.lit(OFFSET) + cy * side

    def on(e):
        within = (x >= F.least(e["px"], e["qx"])) & (x <= F.greatest(e["px"], e["qx"])) & (y >= F.least(e["py"], e["qy"])) & (y <= F.greatest(e["py"], e["qy"]))
        return within & ((e["qx"] - e["px"]) * (y - e["py"]) == (e["qy"] - e["py"]) * (x - e["px"]))

    def crossed(e):
        turn = _left(e, right, y)
        along = ((e["py"] > y) != (e["qy"] > y)) & (_left(e, x, y) != turn)
        return along != (((e["px"] > right) != (e["qx"] > right)) & (turn != _left(e, right, low)))

    odd = F.size(F.filter(edges, crossed)) % 2 == 1
    return inner | (corner != odd) | F.exists(edges, on)


def levels_of(covering: DataFrame) -> dict[int, int]:
    """Cells of each level; there are some dozens of levels at most."""
    return {r[0]: r[1] for r in sorted(covering.groupBy("level").count().collect())}


def meeting(points: DataFrame, covering: DataFrame, how: str, extra: Column | None = None, kept: tuple[str, ...] = ()) -> Iterator[DataFrame] | DataFrame:
    """points joined with the cells that cover them, a level after the other: the cells of a level are broadcast where
    they are few, so a large cell is no hot key; where they are many, each is small, and adaptive execution splits a
    crowd of points in one. For `left_anti` what no level covers, else one table a level, with the columns `kept`. The
    largest cells, which decide most, come first."""
    found = []
    for level, n in sorted(levels_of(covering).items(), reverse=True):
        side = SIZE * 2.0**level
        own = covering.filter(F.col("level") == level).select(*kept, "inner", "corner", "edges", F.col("cx").alias("cell_x"), F.col("cy").alias("cell_y"))
        own = F.broadcast(own) if n <= BROADCAST_CELLS else own
        here = (_cell(points.x, side) == own.cell_x) & (_cell(points.y, side) == own.cell_y)
        hit = here & covered(own.inner, own.corner, own.edges, own.cell_x, own.cell_y, side, points.x, points.y)
        met = points.join(own, hit if extra is None else hit & extra, how)
        if how == "left_anti":
            points = met
        else:
            found.append(met.drop("inner", "corner", "edges", "cell_x", "cell_y"))
    return points if how == "left_anti" else found
