"""The model step: a pluggable detector over tiles, contours in map coordinates, and rotated rectangles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"
DETECTIONS = f"image_name string, tile_num int, detection int, class_id int, score double, ring {RING}, error string"


class ThresholdDetector:
    """A stand-in for a network: connected bright regions of the first band, class by size, score by brightness."""

    def __init__(self, level: float = 127.0, least: int = 4):
        self.level, self.least = level, least

    def detect(self, image: np.ndarray) -> list[tuple[np.ndarray, int, float]]:
        """(mask, class_id, score) of each instance of a (bands, height, width) image."""
        on = image[0] > self.level
        labels = label(on)
        out = []
        for k in range(1, labels.max() + 1):
            mask = labels == k
            if mask.sum() >= self.least:
                out.append((mask, 1 if mask.sum() < 64 else 2, float(image[0][mask].mean() / 255)))
        return out


def label(on: np.ndarray) -> np.ndarray:
    """4-connected components by spreading the least number until nothing changes."""
    big = on.size + 1
    n = np.where(on, np.arange(1, on.size + 1).reshape(on.shape), big)
    while True:
        p = np.pad(n, 1, constant_values=big)
        new = np.where(on, np.minimum.reduce([n, p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]]), big)
        if (new == n).all():
            break
        n = new
    found = np.unique(n[on])
    return np.where(on, np.searchsorted(found, n) + 1, 0)


def contour(mask: np.ndarray) -> np.ndarray | None:
    """The first closed line (row, column) at level 0.5 around the padded mask; diagonal neighbours count as one."""
    m = np.pad(mask, 1).astype(np.int8)
    h, w = m.shape
    # Marching squares: each cell joins the midpoints of its edges; a midpoint is (row, column) in halves.
    follow: dict[tuple[int, int], list[tuple[int, int]]] = {}
    cells = m[:-1, :-1] + 2 * m[:-1, 1:] + 4 * m[1:, 1:] + 8 * m[1:, :-1]
    top, right, bottom, left = (0, 1), (1, 2), (2, 1), (1, 0)
    # Directed so that the mask lies on the right.
    lines = {
        1: [(left, top)], 2: [(top, right)], 3: [(left, right)], 4: [(right, bottom)], 5: [(right, top), (left, bottom)], 6: [(top, bottom)], 7: [(left, bottom)],
        8: [(bottom, left)], 9: [(bottom, top)], 10: [(top, left), (bottom, right)], 11: [(bottom, right)], 12: [(right, left)], 13: [(right, top)], 14: [(top, left)],
    }
    for i, j in np.argwhere((cells > 0) & (cells < 15)):
        for a, b in lines[int(cells[i, j])]:
            follow.setdefault((2 * i + a[0], 2 * j + a[1]), []).append((2 * i + b[0], 2 * j + b[1]))
    if not follow:
        return None
    start = min(follow)
    path, at = [start], start
    while True:
        at = follow[at].pop()
        path.append(at)
        if at == start:
            break
    return np.asarray(path) / 2.0


def to_map(line: np.ndarray, ul_row: float, ul_col: float, yres: float, xres: float, pixel_offset: float = 0.0) -> list[dict]:
    """Contour points as (x, y) on the map. pixel_offset 1 takes the contour's padding off again."""
    y, x = (line[:, 0] - pixel_offset) * yres + ul_row, (line[:, 1] - pixel_offset) * xres + ul_col
    return [{"x": float(a), "y": float(b)} for a, b in zip(x, y)]


def infer(tiles: DataFrame, make: Callable[[], object], pixel_offset: float = 0.0, channels_last: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Run make().detect over each tile (image_name, tile_num, bands, height, width, dtype, data, ul_row, ul_col, yres,
    xres); with channels_last the bytes are in the order of rows, columns, bands. The detector is made once a task. A tile
    that fails gives one row with its error. Detections carry the columns `keep` of their tile."""
    schema = DETECTIONS + "".join(f", {c} {dict(tiles.dtypes)[c]}" for c in keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            rows = []
            for t in frame.itertuples():
                try:
                    shape = (int(t.height), int(t.width), int(t.bands)) if channels_last else (int(t.bands), int(t.height), int(t.width))
                    image = np.frombuffer(t.data, np.dtype(t.dtype)).reshape(shape)
                    image = image.transpose(2, 0, 1) if channels_last else image
                    for k, (mask, class_id, score) in enumerate(model.detect(image)):
                        line = contour(mask)
                        ring = None if line is None else to_map(line, t.ul_row, t.ul_col, t.yres, t.xres, pixel_offset)
                        rows.append((t.image_name, t.tile_num, k, class_id, score, ring, None, *[getattr(t, c) for c in keep]))
                except (ValueError, TypeError) as error:
                    rows.append((t.image_name, t.tile_num, None, None, None, None, str(error), *[getattr(t, c) for c in keep]))
            yield pd.DataFrame(rows, columns=["image_name", "tile_num", "detection", "class_id", "score", "ring", "error", *keep]).astype({"detection": "Int32", "class_id": "Int32", "tile_num": "Int32"})

    return tiles.mapInPandas(run, schema)


def check_errors(found: DataFrame, most: int) -> DataFrame:
    """The detections of infer() without the rows of tiles that failed; an error if more than `most` tiles did."""
    failed = found.filter("error is not null")
    n = failed.count()
    if n > most:
        raise RuntimeError(f"{n} tiles failed, {most} may; the first: {failed.first()['error']}")
    return found.filter("error is null")


def lost(found: DataFrame) -> DataFrame:
    """image_name, failed_tiles, no_contour: how many tiles failed in an image, and how many detections have no ring; images
    without either are left out. infer() should be written once and read here and by the layer."""
    counts = found.groupBy("image_name").agg(F.count_if(F.col("error").isNotNull()).alias("failed_tiles"), F.count_if(F.col("error").isNull() & F.col("ring").isNull()).alias("no_contour"))
    return counts.filter("failed_tiles + no_contour > 0")


def least_rectangle(points: np.ndarray) -> tuple[float, float]:
    """(length, width) of the rectangle of least area around the points: one side lies on an edge of their hull."""
    p = np.unique(points, axis=0)
    if len(p) < 2:
        return 0.0, 0.0
    hull: list = []
    for order in (p, p[::-1]):
        half: list = []
        for q in order:
            while len(half) > 1 and (half[-1][0] - half[-2][0]) * (q[1] - half[-2][1]) - (half[-1][1] - half[-2][1]) * (q[0] - half[-2][0]) <= 0:
                half.pop()
            half.append(q)
        hull += half[:-1]
    h = np.asarray(hull)
    edge = np.roll(h, -1, axis=0) - h
    u = edge / np.linalg.norm(edge, axis=1, keepdims=True)
    a, b = h @ u.T, h @ np.stack([-u[:, 1], u[:, 0]])
    a, b = np.ptp(a, axis=0), np.ptp(b, axis=0)
    k = int(np.argmin(a * b))
    return float(max(a[k], b[k])), float(min(a[k], b[k]))


def rectangle(ring: Column) -> Column:
    """struct<length, width> of the least rectangle around a ring; null for a null or empty ring."""

    @F.pandas_udf("struct<length:double,width:double>")
    def sides(rings: pd.Series) -> pd.DataFrame:
        out = [least_rectangle(np.asarray([(p["x"], p["y"]) for p in r], float)) if r is not None and len(r) else (None, None) for r in rings]
        return pd.DataFrame(out, columns=["length", "width"], dtype=float)

    return sides(ring)
