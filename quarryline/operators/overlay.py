"""Regions of polygons: repair of rings that cross themselves, and union by name, as boundaries of rings.

Coordinates become whole numbers of RESOLUTION, so that sides and crossings are exact. The plane is cut into cells; an edge
is cut at their lines and each piece goes to its cell. How often the rings of a key wind around a point of a cell is the sum
of the crossings left of it in the cell's row, a running sum over the cells of the row. In a cell the pieces are split where
they cross, equal ones are added up, and a piece stays if one side is outside and the other is not; it is turned so that the
inside is on its left. Pieces are chained in their cell, chains are linked across cells by the points where they meet, and
the chains of a ring are put in their order by doubling steps. A cell with more than LIMIT pieces is cut again into smaller
ones, so no task holds more than that. Joins are merged by hint: pieces, cells and chains are many for a row of polygons, which
Spark's estimates leave out, so it would broadcast them through the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from . import spatial

#: Units to a coordinate's 1, the place of the grid of cells in units, and how many parts a crowded cell's side gets.
RESOLUTION = 1_000_000
OFFSET = 36_787
PARTS = 8
#: Side of a cell, pieces of a cell at most, and the side below which a cell is not cut any more.
CELL, LIMIT, LEAST = 64, 512, 1000
#: Pieces that are solved together, and pairs of them that are compared at once.
PIECES, PAIRS = 4096, 1 << 16
_ENDS = ["ax", "ay", "bx", "by"]
_PIECE = "cx long, cy long, ax long, ay long, bx long, by long, whole int, part int, times int"
_CHAIN = "closed boolean, sx long, sy long, tx long, ty long, ux long, uy long, ex long, ey long, xs array<long>, ys array<long>"


def _sum(a, b, c) -> np.ndarray:
    """Twice the area of a, b, c: positive if c is left of the way from a to b."""
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])


def pieces(edges: np.ndarray, side: int) -> tuple[np.ndarray, ...]:
    """Which edge (ax, ay, bx, by) each piece is of, its cell, its ends in their order, its share of the crossings left of
    a cell's point (of cells further right, and of its own), and -1 where the edge goes the other way. Both ways of an edge
    are cut at the same points."""
    turned = (edges[:, 0] > edges[:, 2]) | ((edges[:, 0] == edges[:, 2]) & (edges[:, 1] > edges[:, 3]))
    e = np.where(turned[:, None], edges[:, [2, 3, 0, 1]], edges)
    a, d = e[:, :2], e[:, 2:] - e[:, :2]
    owner, at, xy = [np.arange(len(e))] * 2, [np.zeros(len(e)), np.ones(len(e))], [e[:, :2], e[:, 2:]]
    for axis in (0, 1):
        low, high = np.minimum(a[:, axis], e[:, 2 + axis]), np.maximum(a[:, axis], e[:, 2 + axis])
        first, n = (low - OFFSET) // side + 1, (high - OFFSET) // side - (low - OFFSET) // side
        own = np.repeat(np.arange(len(e)), n)
        line = (np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * side + OFFSET
        t = (line - a[own, axis]) / d[own, axis]
        other = np.rint(a[own, 1 - axis] + t * d[own, 1 - axis]).astype(np.int64)
        owner.append(own)
        at.append(t)
        xy.append(np.column_stack([line, other] if axis == 0 else [other, line]))
    owner, at, xy = np.concatenate(owner), np.concatenate(at), np.concatenate(xy)
    order = np.lexsort((at, owner))
    owner, xy = owner[order], xy[order]
    kept = (owner[1:] == owner[:-1]) & (xy[1:] != xy[:-1]).any(axis=1)
    own, p, q = owner[:-1][kept], xy[:-1][kept], xy[1:][kept]
    cell = (p + q - 2 * OFFSET) // (2 * side)
    twice = 2 * (cell * side + OFFSET) + point_of(side)
    crosses = (2 * p[:, 1] > twice[:, 1]) != (2 * q[:, 1] > twice[:, 1])
    whole = np.where(crosses, np.where(p[:, 1] > q[:, 1], 1, -1), 0)
    left = (_sum(2 * p, 2 * q, twice) > 0) == (p[:, 1] < q[:, 1])  # the cell's point is left of the piece
    return own, cell, p, q, whole, np.where(left, 0, whole), np.where(turned[own], -1, 1)


def point_of(side: int) -> np.ndarray:
    """Twice the place of a cell's point in the cell, odd numbers, so that it is on no whole coordinate."""
    return np.array([int(side * 0.7639) | 1, int(side * 1.1459) | 1])


def _met(cell: np.ndarray, behind: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of pieces of the same cell, whose pieces are neighbours, in parts of some PAIRS: each piece with those behind it, or with all."""
    first = np.arange(1, len(cell) + 1) if behind else np.searchsorted(cell, cell)
    n = np.searchsorted(cell, cell, "right") - first
    for own in np.split(np.arange(len(cell)), np.flatnonzero(np.diff(np.cumsum(n) // PAIRS)) + 1):
        i, skip = np.repeat(own, n[own]), np.repeat(np.cumsum(n[own]) - n[own], n[own])
        yield i, np.repeat(first[own], n[own]) + np.arange(len(i)) - skip


def noded(p: np.ndarray, q: np.ndarray, times: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pieces of cells, each with how often it counts and the number of its cell, split where those of a cell cross or touch, until only
    ends are shared. A crossing is rounded to whole numbers, which may move a piece over another, so its cell is looked at again. Cells that
    are done come first."""
    done = []
    while True:
        n = len(p)
        low, high = np.minimum(p, q), np.maximum(p, q)
        (x0, y0), (x1, y1) = low.T.copy(), high.T.copy()
        met = [(i[k], j[k]) for i, j in _met(cell, True) for k in [(x0[i] <= x1[j]) & (x0[j] <= x1[i]) & (y0[i] <= y1[j]) & (y0[j] <= y1[i])]]
        i, j = (np.concatenate(v) for v in zip(*met))
        pj, qj, pi, qi = _sum(p[i], q[i], p[j]), _sum(p[i], q[i], q[j]), _sum(p[j], q[j], p[i]), _sum(p[j], q[j], q[i])
        cross = (np.sign(pj) * np.sign(qj) < 0) & (np.sign(pi) * np.sign(qi) < 0)
        k = np.flatnonzero(cross)
        t = (pi[k] / (pi[k] - qi[k]).astype(float))[:, None]
        meet = np.rint(p[i[k]] + t * (q[i[k]] - p[i[k]])).astype(np.int64)
        who, at = [i[k], j[k]], [meet, meet]
        for side, one, end in ((pj, i, p[j]), (qj, i, q[j]), (pi, j, p[i]), (qi, j, q[i])):
            on = (side == 0) & (low[one] <= end).all(axis=1) & (end <= high[one]).all(axis=1)
            who.append(one[on])
            at.append(end[on])
        who, at = np.concatenate(who), np.concatenate(at)
        new = (at != p[who]).any(axis=1) & (at != q[who]).any(axis=1)
        busy = np.isin(cell, cell[who[new]])
        done.append((p[~busy], q[~busy], times[~busy], cell[~busy]))
        if not busy.any():
            return tuple(np.concatenate(v) for v in zip(*done))
        who, at = np.concatenate([np.arange(n), np.arange(n), who[new]]), np.concatenate([p, q, at[new]])
        along = ((at - p[who]) * (q[who] - p[who])).sum(axis=1)
        order = np.lexsort((along, who))
        who, at = who[order], at[order]
        kept = (who[1:] == who[:-1]) & (at[1:] != at[:-1]).any(axis=1) & busy[who[1:]]
        p, q, times, cell = at[:-1][kept], at[1:][kept], times[who[:-1][kept]], cell[who[:-1][kept]]


def border(p: np.ndarray, q: np.ndarray, times: np.ndarray, cell: np.ndarray, point: np.ndarray, winds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of noded pieces those with the outside on one side alone, the inside on the left, and their cells; `point` is twice the place
    of a point in each cell that the rings wind around `winds` times, a number for each cell."""
    turned = (p[:, 0] > q[:, 0]) | ((p[:, 0] == q[:, 0]) & (p[:, 1] > q[:, 1]))
    ends = np.column_stack([cell, np.where(turned[:, None], np.hstack([q, p]), np.hstack([p, q]))])
    order = np.lexsort(ends.T[::-1])
    ends = ends[order]
    first = np.concatenate([[True], (ends[1:] != ends[:-1]).any(axis=1)])[: len(ends)]
    step = np.rint(np.bincount(np.cumsum(first) - 1, np.where(turned, -times, times)[order])).astype(np.int64)
    ends, step = ends[first][step != 0], step[step != 0]
    cell, p, q = ends[:, 0], ends[:, 1:3], ends[:, 3:]
    own = _sum(2 * p, 2 * q, point[None]) > 0
    w = winds[cell]
    for i, j in _met(cell, False):
        m = (p + q)[i]
        side = _sum(2 * p[j], 2 * q[j], m)
        way = point - m
        pside, qside = (way[:, 0] * (2 * v[j, 1] - m[:, 1]) - way[:, 1] * (2 * v[j, 0] - m[:, 0]) >= 0 for v in (p, q))
        crossed = (pside != qside) & (side != 0) & ((side > 0) != own[j])
        w = w + np.rint(np.bincount(i, np.where(side > 0, step[j], -step[j]) * crossed, len(p))).astype(np.int64)
    left = np.where(own, w, w + step)
    right = left - step
    kept = (left != 0) != (right != 0)
    back = (left == 0)[kept][:, None]
    return np.where(back, q[kept], p[kept]), np.where(back, p[kept], q[kept]), cell[kept]


def chains(p: np.ndarray, q: np.ndarray, cell: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains of the pieces of cells through points inside them: the pieces of one after the other, how many each has, and whether it is
    closed. A piece goes on with the first one clockwise, so that rings that touch in a point stay apart."""
    n = len(p)
    nodes = np.column_stack([np.tile(cell, 2), np.concatenate([p, q])])
    order = np.lexsort(nodes.T[::-1])
    nodes = nodes[order]
    first = np.concatenate([[True], (nodes[1:] != nodes[:-1]).any(axis=1)])[: 2 * n]
    node = np.empty(2 * n, np.int64)
    node[order] = np.cumsum(first) - 1
    start, end = node[:n], node[n:]
    nodes = nodes[first]
    inner = ((nodes[:, 1:] > 0) & (nodes[:, 1:] < side)).all(axis=1)
    outs, ins = np.bincount(start, minlength=len(nodes)), np.bincount(end, minlength=len(nodes))
    one = inner & (outs == 1) & (ins == 1)
    out = np.empty(len(nodes), np.int64)
    out[start] = np.arange(n)
    after = np.where(one[end], out[end], -1)
    there, back = (np.arctan2(v[:, 1], v[:, 0]) for v in ((q - p).astype(float), (p - q).astype(float)))
    around: dict[int, list] = defaultdict(list)
    many = inner & ~one
    for k in np.flatnonzero(many[start]).tolist():
        around[start[k]].append((there[k], True, k))
    for k in np.flatnonzero(many[end]).tolist():
        around[end[k]].append((back[k], False, k))
    for rays in around.values():
        rays.sort(reverse=True)
        for k, (_, away, piece) in enumerate(rays):
            if not away:
                after[piece] = next(r[2] for r in rays[k + 1 :] + rays[: k + 1] if r[1])
    free = np.setdiff1d(np.arange(n), after)
    seen, on = bytearray(n), after.tolist()
    line: list[int] = []
    long: list[int] = []
    closed: list[bool] = []
    for turn, at in enumerate([*free.tolist(), *range(n)]):
        if seen[at]:
            continue
        begun = len(line)
        while at >= 0 and not seen[at]:
            seen[at] = 1
            line.append(at)
            at = on[at]
        long.append(len(line) - begun)
        closed.append(turn >= len(free))
    return np.array(line, np.int64), np.array(long, np.int64), np.array(closed, bool)


def _cells(columns: list[pa.Array]) -> np.ndarray:
    """The numbers, from 0, of the cells of rows that are sorted by these columns."""
    codes = [c.dictionary_encode().indices.to_numpy() for c in columns]
    return np.cumsum(np.concatenate([[0], np.any([c[1:] != c[:-1] for c in codes], axis=0)]))


def _whole_cells(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some PIECES rows at a time, of whole cells, and their cells' numbers; rows are sorted by the first `width` columns, which tell
    a cell."""
    held: list[pa.RecordBatch] = []
    n, most = 0, PIECES
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            rows = pa.concat_batches(held)
            cell = _cells(rows.columns[:width])
            last = int(np.searchsorted(cell, cell[-1]))
            if last:
                yield rows.slice(0, last), cell[:last]
            held, n = [rows.slice(last)], n - last
            most = max(PIECES, 2 * n)
    if n:
        rows = pa.concat_batches(held)
        yield rows, _cells(rows.columns[:width])


def _rings_of(xs: pa.ListArray, ys: pa.ListArray, side: int) -> tuple[pa.ListArray, pa.Array]:
    """The coordinates and the areas of closed rings, without the points that lines of cells added."""
    long = xs.value_lengths().to_numpy()
    own = np.repeat(np.arange(len(long)), long)
    xy = np.column_stack([v.flatten().to_numpy() for v in (xs, ys)])

    def around() -> tuple[np.ndarray, np.ndarray]:
        """The points before and after each in its ring."""
        n = np.bincount(own, minlength=len(long))
        ends = np.cumsum(n)[n > 0]
        before, after = np.arange(len(own)) - 1, np.arange(len(own)) + 1
        before[ends - n[n > 0]], after[ends - 1] = ends - 1, ends - n[n > 0]
        return before, after

    after = around()[1]
    more = (after > np.arange(len(own))) | (xy != xy[after]).any(axis=1)  # the last point may be the first one again
    xy, own = xy[more], own[more]
    more = (xy != xy[around()[0]]).any(axis=1)
    xy, own = xy[more], own[more]
    while True:
        before, after = around()
        on = ((xy - OFFSET) % side == 0).any(axis=1) & (np.bincount(own, minlength=len(long))[own] > 3)
        k = np.flatnonzero(on)
        a, b, c = xy[before[k]], xy[after[k]], xy[k]
        wide = np.hypot(*(b - a).T.astype(float))
        on[k] = (np.abs(_sum(a.astype(float), b.astype(float), c.astype(float))) <= 2 * wide) & (((c - a) * (b - c)).sum(axis=1) > 0)
        on &= ~(on[before] & (before < np.arange(len(own))))  # of neighbours one at a time
        if not on.any():
            break
        xy, own = xy[~on], own[~on]
    n = np.bincount(own, minlength=len(long))
    ends = np.cumsum(n)
    x, y = (xy - xy[(ends - n)[own]]).T.astype(float)
    area = np.bincount(own, x * y[after] - x[after] * y, len(long)) / 2 / RESOLUTION**2
    points = pa.StructArray.from_arrays([pa.array(v / RESOLUTION) for v in xy.T], names=["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), points), pa.array(area)


def boundaries(polygons: DataFrame, keys: list[str], ring: str = "ring", cell: int = CELL, limit: int = LIMIT) -> DataFrame:
    """keys, part, ring, area: the rings around the points that the rings of a key wind around, in sum, not 0 times. The
    inside is on the left: an outer ring has an area over 0, a hole one below. A key without an inside has none."""
    spark = polygons.sparkSession
    ship(spark)
    kinds = dict(polygons.dtypes)
    head = ", ".join(f"{k} {kinds[k]}" for k in keys)
    unit = lambda c: F.round(F.col(c) * RESOLUTION).cast("long")
    edges = polygons.filter(F.size(ring) > 2).select(*keys, F.explode(spatial.edges_of(F.col(ring))).alias("e")).select(*keys, "e.*")
    edges = edges.select(*keys, unit("px").alias("ax"), unit("py").alias("ay"), unit("qx").alias("bx"), unit("qy").alias("by"))
    edges = spatial.checkpointed(edges.filter("ax <> bx or ay <> by"))

    def cut(side: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    own, at, p, q, *counts = pieces(np.column_stack([batch.column(len(keys) + k).to_numpy() for k in range(4)]), side)
                    columns = [batch.column(k).take(pa.array(own)) for k in range(len(keys))]
                    columns += [pa.array(v) for v in (*at.T, *p.T, *q.T)] + [pa.array(v.astype(np.int32)) for v in counts]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, *(c.split()[0] for c in _PIECE.split(", "))])

        return run

    def solve(side: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, cell in _whole_cells(batches, len(keys) + 2):
                column = lambda *names: np.column_stack([rows.column(rows.schema.get_field_index(c)).to_numpy() for c in names])
                first = np.flatnonzero(np.diff(cell, prepend=-1))
                corner = column("cx", "cy")[first] * side + OFFSET
                p, q = (column(*names) - corner[cell] for names in (("ax", "ay"), ("bx", "by")))
                p, q, cell = border(*noded(p, q, column("times")[:, 0], cell), point_of(side), column("winds")[first, 0])
                line, long, closed = chains(p, q, cell, side)
                p, q = p + corner[cell], q + corner[cell]
                ends = np.cumsum(long)
                head, tail = line[ends - long], line[ends - 1]
                xy = np.insert(q[line], ends - long, p[head], axis=0)
                starts = pa.array(np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32))
                own = [rows.column(k).take(pa.array(first[cell[head]])) for k in range(len(keys))]
                points = [pa.array(v) for way in (p[head], q[head], p[tail], q[tail]) for v in way.T]
                lists = [pa.ListArray.from_arrays(starts, pa.array(v)) for v in xy.T]
                yield pa.RecordBatch.from_arrays([*own, pa.array(closed), *points, *lists], names=[*keys, *(c.split()[0] for c in _CHAIN.split(", "))])

        return run

    place, side, parents, found = [*keys, "cx", "cy"], cell * RESOLUTION, None, []
    while True:
        # Equal pieces are one, and edges that two polygons share in both ways are none.
        cut_up = edges.mapInArrow(cut(side), f"{head}, {_PIECE}").groupBy(*place, *_ENDS).agg(F.first("whole").alias("whole"), F.first("part").alias("part"), F.sum("times").alias("times"))
        cut_up = spatial.checkpointed(cut_up.filter("times <> 0"))
        row = Window.partitionBy(*keys, "cy").orderBy("cx").rowsBetween(Window.unboundedPreceding, -1)
        sums = cut_up.groupBy(*place).agg(F.sum(F.col("whole") * F.col("times")).alias("whole"), F.sum(F.col("part") * F.col("times")).alias("part"), F.count(F.lit(1)).alias("n"))
        sums = sums.select(*place, (F.coalesce(F.sum("whole").over(row), F.lit(0)) + F.col("part")).alias("winds"), "n")
        if parents is not None:
            up = parents.select(*keys, F.col("cx").alias("ux"), F.col("cy").alias("uy"))
            sums = sums.withColumn("ux", F.floor(F.col("cx") / PARTS)).withColumn("uy", F.floor(F.col("cy") / PARTS)).hint("merge").join(up, [*keys, "ux", "uy"], "left_semi").drop("ux", "uy")
        sums = spatial.checkpointed(sums)
        crowded = (F.col("n") > limit) & F.lit(side // PARTS >= LEAST and side % PARTS == 0)
        own = cut_up.hint("merge").join(sums.filter(~crowded).select(*place, "winds"), place)
        # Cells are many and small, so those of a task are solved together.
        dealt = own.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *place).sortWithinPartitions(*place)
        found.append(spatial.checkpointed(dealt.mapInArrow(solve(side), f"{head}, {_CHAIN}")))
        parents = sums.filter(crowded).select(*place)
        if not parents.limit(1).count():
            break
        # Only keys with a crowded cell are cut again.
        edges, side = edges.hint("merge").join(parents.select(*keys).distinct(), keys, "left_semi"), side // PARTS
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return _rings(every, keys, side, head)


def _rings(every: DataFrame, keys: list[str], side: int, head: str) -> DataFrame:
    """Whole rings of chains."""
    numbered = spatial.checkpointed(every.withColumn("id", F.monotonically_increasing_id()))
    open_ = numbered.filter("not closed")
    # At a point where chains meet, one goes on with the next that starts, clockwise.
    angle = lambda y, x: F.atan2((F.col(y[0]) - F.col(y[1])).cast("double"), (F.col(x[0]) - F.col(x[1])).cast("double"))
    outs = open_.select(*keys, F.col("sx").alias("x"), F.col("sy").alias("y"), angle(("ty", "sy"), ("tx", "sx")).alias("angle"), F.col("id").alias("out"), F.lit(None).cast("long").alias("in"))
    ins = open_.select(*keys, F.col("ex").alias("x"), F.col("ey").alias("y"), angle(("uy", "ey"), ("ux", "ex")).alias("angle"), F.lit(None).cast("long").alias("out"), F.col("id").alias("in"))
    node = Window.partitionBy(*keys, "x", "y").orderBy(F.desc("angle"))
    rest = node.rowsBetween(1, Window.unboundedFollowing)
    start = node.rowsBetween(Window.unboundedPreceding, 0)
    after = outs.unionByName(ins).withColumn("next", F.coalesce(F.first("out", True).over(rest), F.first("out", True).over(start))).filter("`in` is not null")
    after = spatial.checkpointed(after.select(F.col("in").alias("id"), "next"))
    roots = spatial.components(after.filter("id <> next").select(F.lit(0).alias("image"), F.least("id", "next").alias("a"), F.greatest("id", "next").alias("b")).distinct())
    # Steps to the chain that a ring starts with, twice as far each turn.
    way = after.hint("merge").join(roots.select(F.col("idx").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    way = spatial.checkpointed(way.select("id", "root", F.when(F.col("next") != F.col("root"), F.col("next")).alias("next"), F.lit(1).cast("long").alias("steps")))
    while way.filter("next is not null").limit(1).count():
        on = way.select(F.col("id").alias("next"), F.col("next").alias("further"), F.col("steps").alias("more"))
        # Chains that are at the start stay out of the join: they have no key, and would meet in one task.
        moved = way.filter("next is not null").hint("merge").join(on, "next", "left").select("id", "root", F.col("further").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        way = spatial.checkpointed(moved.unionByName(way.filter("next is null")))
    placed = numbered.hint("merge").join(way.select("id", "root", "steps"), "id", "left").select(*keys, F.coalesce("root", "id").alias("part"), F.struct((-F.coalesce("steps", F.lit(0))).alias("at"), "xs", "ys").alias("chain"))
    whole = placed.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("chain")).alias("chains"))
    flat = whole.select(*keys, "part", F.flatten("chains.xs").alias("xs"), F.flatten("chains.ys").alias("ys"))

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(keys)
            yield pa.RecordBatch.from_arrays([*batch.columns[: k + 1], *_rings_of(batch.column(k + 1), batch.column(k + 2), side)], names=[*keys, "part", "ring", "area"])

    return flat.mapInArrow(finish, f"{head}, part long, ring array<struct<x:double,y:double>>, area double").filter("area <> 0")


def repaired(polygons: DataFrame, keys: list[str], **grid) -> DataFrame:
    """Valid rings of polygons that may cross themselves: the points that a ring winds around, as `boundaries` gives them."""
    return boundaries(polygons, keys, **grid)


def dissolved(polygons: DataFrame, own: list[str], name: list[str], **grid) -> DataFrame:
    """The union of the polygons of a name, as `boundaries` gives it; `own` tells the polygons apart. Each is repaired
    first, so that it counts once wherever it is, whichever way it turns."""
    parts = boundaries(polygons.select(*own, *[n for n in name if n not in own], "ring"), [*own, *[n for n in name if n not in own]], **grid)
    return boundaries(parts.select(*name, "ring"), name, **grid)


def perimeter(ring: Column) -> Column:
    return F.aggregate(spatial.edges_of(ring), F.lit(0.0), lambda s, e: s + F.sqrt((e["qx"] - e["px"]) * (e["qx"] - e["px"]) + (e["qy"] - e["py"]) * (e["qy"] - e["py"])))
