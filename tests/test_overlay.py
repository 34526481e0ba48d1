import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarryline.operators import overlay, spatial

SCHEMA = "fid long, name string, ring array<struct<x:double,y:double>>"


def frame(spark, rings, names):
    return spark.createDataFrame([(k, n, [{"x": float(x), "y": float(y)} for x, y in r]) for k, (r, n) in enumerate(zip(rings, names))], SCHEMA)


def winding(rings, at):
    """How often rings wind around points, by the crossings of a way to the left."""
    w = np.zeros(len(at), int)
    for ring in rings:
        for (px, py), (qx, qy) in zip(ring, [*ring[1:], ring[0]]):
            up, down = (py <= at[:, 1]) & (qy > at[:, 1]), (py > at[:, 1]) & (qy <= at[:, 1])
            with np.errstate(all="ignore"):
                x = px + (at[:, 1] - py) * (qx - px) / (qy - py)
            w += np.where(down & (x < at[:, 0]), 1, 0) - np.where(up & (x < at[:, 0]), 1, 0)
    return w


def valid(rings):
    """No two edges cross, and none lie on each other."""
    edges = [(a, b) for r in rings for a, b in zip(r, [*r[1:], r[0]])]
    p, q = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
    n = np.rint(np.stack([p, q], 1) * 1e6).astype(np.int64)
    side = lambda a, b, c: (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])
    a, b = n[:, None, 0], n[:, None, 1]
    c, d = n[None, :, 0], n[None, :, 1]
    tiny = 4e6  # a coordinate's rounding times the length of an edge
    big = lambda v: np.where(np.abs(v) > tiny, np.sign(v), 0)
    return not ((big(side(a, b, c)) * big(side(a, b, d)) < 0) & (big(side(c, d, a)) * big(side(c, d, b)) < 0)).any()


def star(cx, cy, r, n=5, step=2):
    t = np.pi / 2 + np.arange(n) * step * 2 * np.pi / n
    return [(round(cx + r * np.cos(a), 3), round(cy + r * np.sin(a), 3)) for a in t]


def shapes(seed, n, size):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        at = rng.integers(0, size, 2)
        kind = rng.integers(0, 5)
        if kind == 0:
            w, h = rng.integers(1, 30, 2)
            out.append([(at[0], at[1]), (at[0] + w, at[1]), (at[0] + w, at[1] + h), (at[0], at[1] + h)][:: rng.choice([-1, 1])])
        elif kind == 1:
            out.append(star(*at, int(rng.integers(3, 40))))
        else:
            out.append([tuple(p) for p in (at + rng.integers(0, 60, (rng.integers(3, 9), 2))).tolist()])
    return [[(float(x), float(y)) for x, y in r] for r in out]


GRIDS = [{}, {"cell": 16}, {"cell": 64, "limit": 12}]


def rings_by(rows, *keys):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[k] for k in keys), []).append([(p.x, p.y) for p in r.ring])
    return out


@pytest.mark.parametrize("grid", GRIDS)
def test_repair_and_union_against_points(spark, grid):
    """Rings that cross themselves and each other, whatever the cells are: the same points are inside, and nothing crosses."""
    rings = shapes(3, 60, 150)
    rings += [rings[0], rings[1][::-1], [(10, 10), (30, 30), (30, 10), (10, 30)], [(50, 50), (70, 50), (70, 70), (50, 70), (50, 50), (70, 50), (70, 70), (50, 70)]]
    names = ["ab"[k % 2] for k in range(len(rings))]
    df = frame(spark, rings, names)
    rng = np.random.default_rng(1)
    at = rng.uniform(-10, 220, (6000, 2)) + 1e-4
    fixed = rings_by(overlay.repaired(df, ["fid"], **grid).collect(), "fid")
    for k, ring in enumerate(rings):
        w = winding(fixed.get((k,), []), at)
        assert (((w == 1) == (winding([ring], at) != 0)) & ((w == 0) | (w == 1))).mean() > 0.9995 and valid(fixed.get((k,), [[(0, 0), (1, 0), (0, 1)]])), k
    rows = overlay.dissolved(df, ["fid"], ["name"], **grid).collect()
    union = rings_by(rows, "name")
    for name in "ab":
        inside = np.logical_or.reduce([winding([r], at) != 0 for r, n in zip(rings, names) if n == name])
        w = winding(union[name,], at)
        assert ((w == inside).mean() > 0.9995) and valid(union[name,])
        area = sum(r.area for r in rows if r.name == name)
        assert abs(area - inside.mean() * 230**2) < 230**2 * 0.02 and {r.area > 0 for r in rows} == {True, False}
    assert all(r.area != 0 and len(r.ring) > 2 for r in rows)


def test_known_areas(spark):
    bow, twice = [(0, 0), (10, 10), (10, 0), (0, 10)], [(0, 0), (6, 0), (6, 6), (0, 6), (0, 0), (6, 0), (6, 6), (0, 6)]
    flat, far = [(0, 0), (5, 5), (9, 9)], [(200, 0), (900, 0), (900, 500), (200, 500)]
    df = frame(spark, [bow, twice, flat, far], list("abcd"))
    rows = overlay.repaired(df, ["fid"]).collect()
    areas = {k: sorted(round(r.area, 6) for r in rows if r.fid == k) for k in range(4)}
    assert areas == {0: [25, 25], 1: [36], 2: [], 3: [350000]}
    assert {len(r.ring) for r in rows if r.fid == 3} == {4} and {len(r.ring) for r in rows if r.fid == 0} == {3}


def test_tiles_of_a_name_become_one_ring(spark):
    """Inner edges vanish, and a hole stays: a frame of 300 tiles over many cells."""
    tiles = [[(x, y), (x + 10, y), (x + 10, y + 10), (x, y + 10)] for x in range(0, 200, 10) for y in range(0, 200, 10) if not (50 <= x < 150 and 50 <= y < 150)]
    rows = overlay.dissolved(frame(spark, tiles, ["a"] * len(tiles)), ["fid"], ["name"]).collect()
    assert sorted(round(r.area, 6) for r in rows) == [-10000, 40000]
    outer = next(r for r in rows if r.area > 0)
    corners = {(p.x, p.y) for p in outer.ring}
    assert {(0, 0), (200, 0), (200, 200), (0, 200)} <= corners and all(0 in (x, y) or 200 in (x, y) for x, y in corners)


def test_empty_and_null(spark):
    df = frame(spark, [], []).unionByName(spark.createDataFrame([(1, "a", None), (2, "a", [])], SCHEMA))
    assert overlay.dissolved(df, ["fid"], ["name"]).count() == 0
    one = frame(spark, [[(0, 0), (4, 0), (4, 4)]], ["x"]).withColumn("area", F.lit("clash"))
    assert overlay.repaired(one, ["fid"]).first().area == 8


def test_perimeter(spark):
    df = frame(spark, [[(0, 0), (4, 0), (4, 3), (0, 3)]], ["x"])
    assert df.select(overlay.perimeter(F.col("ring")).alias("p")).first().p == 14 and df.select(F.size(spatial.edges_of(F.col("ring"))).alias("n")).first().n == 4


def test_no_join_is_broadcast(spark, monkeypatch, tmp_path):
    """Pieces, cells, chains and labels grow with the polygons, and go through no driver, however small Spark thinks they are.
    Only the images of more than GRAPH pairs may."""
    plans, whole = [], spatial.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df)

    monkeypatch.setattr(spatial, "checkpointed", seen)
    monkeypatch.setattr(spatial, "GRAPH", 1)
    rings = shapes(3, 30, 150)
    frame(spark, rings, ["a"] * len(rings)).write.parquet(str(tmp_path / "rings"))
    out = overlay.repaired(spark.read.parquet(str(tmp_path / "rings")), ["fid"], cell=16, limit=12)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    keys = [re.sub(r"#\d+", "", k) for p in plans for k in re.findall(r"BroadcastHashJoin \[(.*?)\]", p)]
    assert sum("SortMergeJoin" in p for p in plans) > 7 and set(keys) <= {"image"}


def test_cells_together_are_as_alone(monkeypatch):
    """Pieces of many cells in one go, in parts of any size: the chains are those of each cell by itself."""
    rng, side = np.random.default_rng(7), 1000
    cells = []
    for _ in range(40):
        rings = [rng.integers(0, 11, (rng.integers(3, 8), 2)) * 100 for _ in range(rng.integers(1, 4))]
        p, q = np.concatenate(rings), np.concatenate([np.roll(r, -1, axis=0) for r in rings])
        some = (p != q).any(axis=1)
        cells.append((p[some], q[some], np.ones(some.sum(), np.int64)))
    winds = rng.integers(-1, 2, len(cells))

    def solved(some):
        own = np.repeat(np.arange(len(some)), [len(cells[c][0]) for c in some])
        p, q, own = overlay.border(*overlay.noded(*(np.concatenate([cells[c][k] for c in some]) for k in range(3)), own), overlay.point_of(side), winds[some])
        line, long, closed = overlay.chains(p, q, own, side)
        out = []
        for k, one in zip(np.split(line, np.cumsum(long)[:-1]), closed.tolist()):
            assert len(set(own[k].tolist())) == 1 and (p[k[1:]] == q[k[:-1]]).all() and (not one or (p[k[0]] == q[k[-1]]).all())
            out.append((some[own[k[0]]], one, p[k].tolist(), q[k].tolist()))
        return sorted(out)

    alone = sorted(x for c in range(len(cells)) for x in solved([c]))
    assert {one for _, one, *_ in alone} == {True, False}
    for pairs in (1 << 16, 50):
        monkeypatch.setattr(overlay, "PAIRS", pairs)
        assert solved(list(range(len(cells)))) == alone


def test_cells_stay_whole(monkeypatch):
    """A cell's rows come together, wherever batches end, also if they are more than PIECES."""
    monkeypatch.setattr(overlay, "PIECES", 10)
    rows = sorted((n, c, c // 2, k) for n in "ab" for c in range(12) for k in range(30 if c == 5 else c % 4))
    table = pa.table([pa.array(v) for v in zip(*rows)], names=["name", "cx", "cy", "k"])
    parts = list(overlay._whole_cells(table.to_batches(max_chunksize=7), 3))
    assert pa.Table.from_batches([p for p, _ in parts]).equals(table) and len(parts) > 2
    places = [{tuple(r[k] for k in ("name", "cx", "cy")) for r in p.to_pylist()} for p, _ in parts]
    assert sum(map(len, places)) == len(set.union(*places)) and [len(p) for p in places] == [c[-1] + 1 for _, c in parts]
    assert list(overlay._whole_cells(iter([]), 3)) == []


def test_rings_of_a_batch():
    """Points twice and those that lines of cells added go, the others stay; rings do not mix."""
    at, side = overlay.OFFSET, 1000
    square = [(0, 7), (500, 7), (1000, 7), (1500, 7), (1500, 7), (1500, 1507), (0, 1507), (0, 7)]
    rings = [[(x + at, y + at) for x, y in r] for r in (square, [(7, 7), (1007, 7), (7, 1007)], square[::-1])]
    xs, ys = (pa.array([[p[k] for p in r] for r in rings], pa.list_(pa.int64())) for k in (0, 1))
    for skip in (0, 1):
        ring, area = overlay._rings_of(xs.slice(skip), ys.slice(skip), side)
        scaled = [[(round(p["x"] * 1e6) - at, round(p["y"] * 1e6) - at) for p in r] for r in ring.to_pylist()]
        assert [set(r) for r in scaled] == [set(square) - {(1000, 7)}, {(7, 7), (1007, 7), (7, 1007)}, set(square) - {(1000, 7)}][skip:] and [len(r) for r in scaled] == [5, 3, 5][skip:]
        assert np.allclose(area.to_numpy() * 1e12, [2250000, 500000, -2250000][skip:])
