"""Coordinate reference systems: their text and their GeoTIFF keys, and polar stereographic and transverse Mercator
projections as column expressions. Datums are not shifted; systems on other ellipsoids than the known ones are refused."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The WGS84 ellipsoid, and the flattening of GRS80, which differs from it by a tenth of a millimetre.
A = 6378137.0
FLATTENING = 298.257223563
GRS80 = 298.257222101
E2 = (2 - 1 / FLATTENING) / FLATTENING
E = math.sqrt(E2)
# Keys of a GeoTIFF's directory.
MODEL, GEOGRAPHIC, MAJOR, FLAT, PROJECTED, METHOD, UNITS = 1024, 2048, 2057, 2059, 3072, 3075, 3076
PARALLEL, NAT_LON, NAT_LAT, EASTING, NORTHING, SCALE_AT, POLE_LON = 3078, 3080, 3081, 3082, 3083, 3092, 3095
USER, MERCATOR_CODE, POLAR_CODE = 32767, 1, 15
# The codes of polar systems, their true latitude and meridian; of UTM the code before zone 1.
POLAR = {3413: (70.0, -45.0), 3995: (71.0, 0.0), 3996: (75.0, 0.0), 3031: (-71.0, 0.0), 3976: (-70.0, 0.0)}
UTM_NORTH, UTM_SOUTH = 32600, 32700


@dataclass(frozen=True)
class Crs:
    """kind: degrees, polar or mercator (transverse); lat: the latitude of true scale, or of the origin."""

    kind: str
    lat: float = 0.0
    lon: float = 0.0
    scale: float = 1.0
    east: float = 0.0
    north: float = 0.0
    unit: float = 1.0


# Text.
def _tree(text: str) -> list:
    """Well-known text as lists: the name of a node, then its values and nodes."""
    tokens = re.findall(r'"(?:[^"]|"")*"|[A-Za-z_]\w*|[-+]?\d[\d.eE+-]*|[\[\](),]', text)
    at = 0

    def node() -> list:
        nonlocal at
        out: list = [tokens[at]]
        at += 2
        while tokens[at] not in "])":
            if tokens[at] == ",":
                at += 1
            elif at + 1 < len(tokens) and tokens[at + 1] in "[(":
                out.append(node())
            else:
                out.append(tokens[at].strip('"') if tokens[at][0] == '"' else tokens[at] if tokens[at][0].isalpha() else float(tokens[at]))
                at += 1
        at += 1
        return out

    try:
        return node()
    except (IndexError, ValueError) as error:
        raise ValueError(f"not the text of a coordinate system: {text[:80]!r}") from error


def _nodes(tree: list, name: str) -> list[list]:
    return [n for n in tree[1:] if isinstance(n, list) and n[0] == name]


def parse(text: str) -> Crs:
    """The system of a .prj file's text (GEOGCS or PROJCS)."""
    tree = _tree(text)
    geographic = tree if tree[0] == "GEOGCS" else next(iter(_nodes(tree, "GEOGCS")), None)
    if geographic is None:
        raise ValueError(f"{tree[0]} is not a geographic or projected system")
    ball = next((b for d in _nodes(geographic, "DATUM") for b in _nodes(d, "SPHEROID")), None)
    if ball is None or abs(ball[2] - A) > 1e-3 or min(abs(ball[3] - FLATTENING), abs(ball[3] - GRS80)) > 1e-6:
        raise ValueError(f"ellipsoid {ball and ball[1:4]} is not known")
    if any(p[2] for p in _nodes(geographic, "PRIMEM")):
        raise ValueError("only Greenwich is known as the first meridian")
    if tree[0] == "GEOGCS":
        return Crs("degrees")
    method = next((p[1] for p in _nodes(tree, "PROJECTION")), "").lower()
    value = {p[1].lower(): p[2] for p in _nodes(tree, "PARAMETER")}
    unit = next((u[2] for u in _nodes(tree, "UNIT")), 1.0)
    places = {"lon": value.get("central_meridian", value.get("longitude_of_origin", 0.0)), "scale": value.get("scale_factor", 1.0)}
    places |= {"east": value.get("false_easting", 0.0) * unit, "north": value.get("false_northing", 0.0) * unit, "unit": unit}
    if method in ("polar_stereographic", "stereographic_north_pole", "stereographic_south_pole"):
        return Crs("polar", value.get("standard_parallel_1", value.get("latitude_of_origin", 90.0)), **places)
    if method in ("transverse_mercator", "gauss_kruger"):
        return Crs("mercator", value.get("latitude_of_origin", 0.0), **places)
    raise ValueError(f"projection {method!r} is not known")


def text(crs: Crs) -> str:
    """The text of a system, as a .prj file has it."""
    number = lambda v: f"{v:.15g}"
    degrees = 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563,AUTHORITY["EPSG","7030"]],AUTHORITY["EPSG","6326"]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433],AUTHORITY["EPSG","4326"]]'
    if crs.kind == "degrees":
        return degrees
    method = {"polar": "Polar_Stereographic", "mercator": "Transverse_Mercator"}[crs.kind]
    values = {"latitude_of_origin": crs.lat, "central_meridian": crs.lon, "scale_factor": crs.scale, "false_easting": crs.east / crs.unit, "false_northing": crs.north / crs.unit}
    parameters = ",".join(f'PARAMETER["{k}",{number(v)}]' for k, v in values.items())
    unit = 'UNIT["metre",1,AUTHORITY["EPSG","9001"]]' if crs.unit == 1 else f'UNIT["unknown",{number(crs.unit)}]'
    return f'PROJCS["unnamed",{degrees},PROJECTION["{method}"],{parameters},{unit}]'


# GeoTIFF keys.
def from_keys(directory: list[int] | None, numbers: list[float] | None) -> Crs | None:
    """The system of a GeoTIFF's directory of keys and list of numbers; None without one that says where it is."""
    if not directory:
        return None
    keys: dict[int, float] = {}
    for k in range(4, len(directory) - 3, 4):
        key, where, n, value = directory[k : k + 4]
        if where == 0:
            keys[key] = value
        elif where == 34736 and numbers and value < len(numbers):
            keys[key] = numbers[value]
    code = keys.get(PROJECTED)
    if code in POLAR:
        return Crs("polar", *POLAR[code])
    for base, north in ((UTM_NORTH, 0.0), (UTM_SOUTH, 1e7)):
        if code is not None and base < code <= base + 60:
            return Crs("mercator", 0.0, (code - base) * 6.0 - 183.0, 0.9996, 500000.0, north)
    method = keys.get(METHOD)
    if keys.get(MODEL) == 2 or (code is None and method is None and GEOGRAPHIC in keys):
        return Crs("degrees")
    if keys.get(UNITS, 9001) != 9001:
        raise ValueError(f"unit {keys[UNITS]} is not known")
    if abs(keys.get(MAJOR, A) - A) > 1e-3 or min(abs(keys.get(FLAT, FLATTENING) - f) for f in (FLATTENING, GRS80)) > 1e-6:
        raise ValueError("the ellipsoid is not known")
    rest = {"scale": keys.get(SCALE_AT, 1.0), "east": keys.get(EASTING, 0.0), "north": keys.get(NORTHING, 0.0)}
    if method == POLAR_CODE:
        return Crs("polar", keys.get(NAT_LAT, keys.get(PARALLEL, 90.0)), keys.get(POLE_LON, keys.get(NAT_LON, 0.0)), **rest)
    if method == MERCATOR_CODE:
        return Crs("mercator", keys.get(NAT_LAT, 0.0), keys.get(NAT_LON, 0.0), **rest)
    if code is None and method is None:
        return None
    raise ValueError(f"system {code}, method {method} is not known")


def to_keys(crs: Crs) -> tuple[list[int], list[float]]:
    """The directory of keys and the list of numbers of a system."""
    if crs.kind == "degrees":
        return [1, 1, 0, 2, MODEL, 0, 1, 2, GEOGRAPHIC, 0, 1, 4326], []
    values = {NAT_LAT: crs.lat, EASTING: crs.east, NORTHING: crs.north, SCALE_AT: crs.scale, POLE_LON if crs.kind == "polar" else NAT_LON: crs.lon}
    own = {MODEL: 1, GEOGRAPHIC: 4326, PROJECTED: USER, METHOD: POLAR_CODE if crs.kind == "polar" else MERCATOR_CODE, UNITS: 9001}
    numbers = [values[k] for k in sorted(values)]
    entries = [(k, 0, 1, v) for k, v in own.items()] + [(k, 34736, 1, n) for n, k in enumerate(sorted(values))]
    return [1, 1, 0, len(entries), *(v for e in sorted(entries) for v in e)], numbers


# Projections.
def _t(lat: Column) -> Column:
    s = F.lit(E) * F.sin(lat)
    return F.tan(F.lit(math.pi / 4) - lat / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))


def _scale(true_lat: float) -> float:
    if abs(true_lat) > 90 - 1e-9:
        return 2 * A / math.sqrt((1 + E) ** (1 + E) * (1 - E) ** (1 - E))
    s = math.sin(math.radians(true_lat))
    m = math.cos(math.radians(true_lat)) / math.sqrt(1 - E2 * s * s)
    t = math.tan(math.pi / 4 - math.radians(true_lat) / 2) / ((1 - E * s) / (1 + E * s)) ** (E / 2)
    return A * m / t


def forward(lon: Column, lat: Column, true_lat: float = 70.0, meridian: float = -45.0) -> tuple[Column, Column]:
    """Metres east and north of the pole for degrees."""
    rho = F.lit(_scale(true_lat)) * _t(F.radians(lat))
    angle = F.radians(lon - meridian)
    return rho * F.sin(angle), -rho * F.cos(angle)


def inverse(x: Column, y: Column, true_lat: float = 70.0, meridian: float = -45.0) -> tuple[Column, Column]:
    """Degrees for metres; the latitude by its series in the conformal latitude."""
    t = F.sqrt(x * x + y * y) / F.lit(_scale(true_lat))
    return F.degrees(F.atan2(x, -y)) + meridian, F.degrees(_latitude(F.lit(math.pi / 2) - 2 * F.atan(t)))


def _latitude(chi: Column) -> Column:
    e2, e4, e6, e8 = E2, E2**2, E2**3, E2**4
    return chi + (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi) + (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi) \
        + (7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi) + 4279 * e8 / 161280 * F.sin(8 * chi)


_N = 1 / (2 * FLATTENING - 1)
# The coefficients of transverse Mercator's series in the third flattening, there and back.
_THERE = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_RADIUS = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def _meridian(lat: float) -> float:
    """xi of a latitude on the central meridian."""
    s = math.sin(math.radians(lat))
    t = math.sinh(math.atanh(s) - E * math.atanh(E * s)) if abs(s) < 1 else math.copysign(1e300, s)
    xi = math.atan(t)
    return xi + sum(a * math.sin(2 * (k + 1) * xi) for k, a in enumerate(_THERE))


def mercator(lon: Column, lat: Column, crs: Crs) -> tuple[Column, Column]:
    """Metres for degrees, within some 30 degrees of the meridian."""
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - E * F.atanh(E * s))
    d = F.radians(F.pmod(lon - crs.lon + 180, F.lit(360.0)) - 180)
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    north = xi + sum((F.lit(a) * F.sin(2 * (k + 1) * xi) * F.cosh(2 * (k + 1) * eta) for k, a in enumerate(_THERE)), F.lit(0.0))
    east = eta + sum((F.lit(a) * F.cos(2 * (k + 1) * xi) * F.sinh(2 * (k + 1) * eta) for k, a in enumerate(_THERE)), F.lit(0.0))
    k = crs.scale * _RADIUS
    return east * k + crs.east, (north - _meridian(crs.lat)) * k + crs.north


def mercator_back(x: Column, y: Column, crs: Crs) -> tuple[Column, Column]:
    """Degrees for metres."""
    k = crs.scale * _RADIUS
    north, east = (y - crs.north) / k + _meridian(crs.lat), (x - crs.east) / k
    xi = north - sum((F.lit(b) * F.sin(2 * (j + 1) * north) * F.cosh(2 * (j + 1) * east) for j, b in enumerate(_BACK)), F.lit(0.0))
    eta = east - sum((F.lit(b) * F.cos(2 * (j + 1) * north) * F.sinh(2 * (j + 1) * east) for j, b in enumerate(_BACK)), F.lit(0.0))
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + crs.lon, F.degrees(_latitude(chi))


def project(lon: Column, lat: Column, crs: Crs) -> tuple[Column, Column]:
    """Coordinates of a system for degrees."""
    if crs.kind == "degrees":
        return lon, lat
    if crs.kind == "mercator":
        x, y = mercator(lon, lat, crs)
    else:  # the south is the north with both signs turned
        sign = -1 if crs.lat < 0 else 1
        x, y = (v * crs.scale * sign for v in forward(sign * lon, sign * lat, abs(crs.lat), sign * crs.lon))
        x, y = x + crs.east, y + crs.north
    return x / crs.unit, y / crs.unit


def degrees(x: Column, y: Column, crs: Crs) -> tuple[Column, Column]:
    """Degrees for coordinates of a system."""
    if crs.kind == "degrees":
        return x, y
    x, y = x * crs.unit, y * crs.unit
    if crs.kind == "mercator":
        return mercator_back(x, y, crs)
    sign = -1 if crs.lat < 0 else 1
    lon, lat = inverse((x - crs.east) / (crs.scale * sign), (y - crs.north) / (crs.scale * sign), abs(crs.lat), sign * crs.lon)
    return sign * lon, sign * lat


def moved(x: Column, y: Column, one: Crs, two: Crs) -> tuple[Column, Column]:
    """Coordinates of one system in another."""
    return (x, y) if one == two else project(*degrees(x, y, one), two)


#: Systems of one layer at most.
SYSTEMS = 500


def aligned(layer: DataFrame, target: str, ring: str = "ring", prj: str = "prj") -> DataFrame:
    """A layer with its rings (an array of x, y, or an array of such rings) in the system of the text `target`, by each
    row's own text in the column prj; rows without one are taken as they are. The texts of a layer are few, which is
    checked; one that is not known is an error."""
    known = [r[0] for r in layer.select(prj).filter(F.col(prj).isNotNull()).distinct().limit(SYSTEMS + 1).collect()]
    if len(known) > SYSTEMS:
        raise ValueError(f"a layer with more than {SYSTEMS} coordinate systems")
    to, out = parse(target), F.col(ring)
    nested = dict(layer.dtypes)[ring].startswith("array<array")

    def turning(own: Crs) -> Callable[[Column], Column]:
        def point(p: Column) -> Column:
            x, y = moved(p["x"], p["y"], own, to)
            return F.struct(x.alias("x"), y.alias("y"))

        return lambda line: F.transform(line, point)

    for wkt in known:
        own = parse(wkt)
        if own != to:
            new = F.transform(ring, turning(own)) if nested else turning(own)(F.col(ring))
            out = F.when(F.col(prj) == wkt, new).otherwise(out)
    return layer.withColumn(ring, out)

