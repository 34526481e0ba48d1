"""Expressions over rings, arrays of x, y structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def closed(ring: Column) -> Column:
    """The ring with its first point again at the end, if it is not there."""
    first, last = ring[0], F.element_at(ring, -1)
    same = (first["x"] == last["x"]) & (first["y"] == last["y"])
    return F.when(F.size(ring) == 0, ring).when(same, ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def wkt(ring: Column) -> Column:
    """Well-known text of the polygon that a ring bounds; POLYGON EMPTY without points."""
    points = F.transform(closed(ring), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.when(F.size(ring) == 0, F.lit("POLYGON EMPTY")).otherwise(F.concat(F.lit("POLYGON (("), F.array_join(points, ", "), F.lit("))")))


def _turn(p: Column, q: Column, r: Column) -> Column:
    return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))


def is_simple(ring: Column) -> Column:
    """Whether a ring has three points or more and no two of its edges cross; edges that only touch do not cross."""
    line = closed(ring)
    edges = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def cross(e, f):
        return (_turn(e["p"], e["q"], f["p"]) * _turn(e["p"], e["q"], f["q"]) < 0) & (_turn(f["p"], f["q"], e["p"]) * _turn(f["p"], f["q"], e["q"]) < 0)

    return F.when(F.size(line) < 4, False).otherwise(~F.exists(edges, lambda e: F.exists(edges, lambda f: cross(e, f))))
