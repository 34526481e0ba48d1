"""From scenes to tiles: the land mask, cutting, the filter of black tiles, contrast, and numbering.

Scenes come as windows (sources.geotiff.WINDOW): a row holds some thousand pixels a side with a margin, so a task holds a
window and a tile, whatever the size of the scene. Whole scenes in a row (COLUMNS) are cut to windows first. Nothing here
is a row for each pixel.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import images
from ..sources import geotiff
from . import raster
from .dataflow import CROP, OVERLAP
from .spatial import checkpointed

# The bands of a tile in their order, the band that tells black tiles, the near-infrared band; from 0.
BANDS, BLACK, NIR = (3, 1, 2), 2, 3
RADIUS, SIGMA, REACH = 5, 2.0, 4.0
#: Pixels of the blur around a pixel, and all that a pixel of the land mask depends on.
BLUR = int(REACH * SIGMA + 0.5)
MARGIN = RADIUS + BLUR
#: Pixels of a window's side.
SIDE = 1600
#: Rows of a side table (thresholds, numbers of tiles) that are broadcast at most, some 50 bytes each.
BROADCAST_ROWS = 500_000
BINS = 256
_PLACED = "image_name string, id_i int, id_j int, h int, w int, ul_row double, ul_col double, yres double, xres double, tiles_y int, tiles_x int, data binary"
TILE = _PLACED.replace("id_i", "tile_num int, id_i", 1)
COLUMNS = ("image_name", "dtype", "bands", "height", "width", "gt", "data")


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


#: Bytes of rows that leave together.
TOGETHER = 4 << 20
_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64())}


def _batches(schema: str, rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few MB at most, or of one row."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    held, size = [], 0
    for row in itertools.chain(rows, [None]):
        if row is not None:
            held.append(row)
            size += 200 + sum(len(v) for v in row if isinstance(v, bytes))
        if held and (row is None or size >= TOGETHER):
            yield pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, t in zip(zip(*held), kinds)], names=list(names))
            held, size = [], 0


def land(scene: np.ndarray, nir: int = NIR, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """True where the near-infrared band, as bytes, smoothed and blurred, is over its Otsu threshold: water is dark."""
    blurred = blur(raster.disk_median(images.to_byte(scene[nir]), radius), sigma)
    return blurred > images.otsu(blurred)


def blur(smooth: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    return raster.gaussian(smooth / 255, sigma, REACH)


# Windows.
class Part:
    """A window row: its place and the array of its pixels (bands, rows, cols) with the margin."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        for name in names_of(geotiff.WINDOW):
            if name not in ("data", "path", "citation"):
                setattr(self, name, batch.column(name)[k].as_py())
        self.data = None
        if batch.column("data")[k].is_valid:
            self.data = np.frombuffer(batch.column("data")[k].as_buffer(), np.dtype(self.dtype)).reshape(self.bands, self.rows, self.cols)

    def within(self, image: np.ndarray, margin: int) -> np.ndarray:
        """The part of an image of the window's pixels that is the window itself and a margin, as far as the scene goes."""
        y, x = self.top - min(margin, self.y), self.left - min(margin, self.x)
        return image[y : self.top + self.h + margin, x : self.left + self.w + margin]


def _each(windows: DataFrame, schema: str, f: Callable[[Part], Iterator[tuple]], need: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """f's rows for each window that could be read and has the bands that are needed; f also gets extra columns."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = Part(batch, k)
                if part.data is not None and part.bands >= need:
                    yield from f(part, *(batch.column(c)[k].as_py() for c in extra))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(schema, rows(batches))

    return windows.select(*names_of(geotiff.WINDOW), *extra).mapInArrow(run, schema)


def windows_of(scenes: DataFrame, side: int = SIDE, step: int | None = None, before: int = 0, after: int = 0) -> DataFrame:
    """Windows of scenes that are whole rows (COLUMNS); a scene without data gives none."""
    step = step or side

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, dtype, n, height, width, gt, data = (batch.column(i)[k] for i in range(7))
                if not data.is_valid:
                    continue
                prj = batch.column(7)[k].as_py()
                name, n, height, width, gt = (v.as_py() for v in (name, n, height, width, gt))
                scene = np.frombuffer(data.as_buffer(), np.dtype(dtype.as_py())).reshape(n, height, width)
                high, wide = geotiff.window_sides(height, width, False, side, step)
                for y, x in geotiff.window_places(height, width, high, wide):
                    h, w, top, left = min(high, height - y), min(wide, width - x), min(before, y), min(before, x)
                    own = scene[:, y - top : y + h + after, x - left : x + w + after]
                    yield (None, name, y, x, h, w, top, left, *own.shape[1:], height, width, n, gt, None, prj, dtype.as_py(), own.tobytes(), None)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(geotiff.WINDOW, rows(batches))

    prj = F.col("prj") if "prj" in scenes.columns else F.lit(None).cast("string").alias("prj")
    return scenes.select(*COLUMNS, prj).mapInArrow(run, geotiff.WINDOW)


def beside(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows with the columns of a side table, which is broadcast while it is small, so that pixels stay where they are."""
    return rows.join(F.broadcast(side) if side.count() <= BROADCAST_ROWS else side, keys, how)


# The land mask, a window at a time.
_SMOOTH = "image_name string, y int, x int, h int, w int, top int, left int, rows int, cols int, data binary"


def thresholds(windows: DataFrame, nir: int = NIR) -> DataFrame:
    """image_name and threshold of each scene, as `land` has it: the smoothed band is kept as bytes, a first pass finds the
    ends of its blurred values, a second counts them in bins, and the counts of all windows are summed. Windows need a
    margin of MARGIN; 256 rows a scene are all that meets."""

    def smooth(p: Part) -> Iterator[tuple]:
        own = p.within(raster.disk_median(images.to_byte(p.data[nir]), RADIUS), BLUR)
        yield p.image_name, p.y, p.x, p.h, p.w, min(BLUR, p.y), min(BLUR, p.x), *own.shape, own.tobytes()

    smoothed = checkpointed(_each(windows, _SMOOTH, smooth, nir + 1))

    def blurred(batch: pa.RecordBatch, k: int) -> np.ndarray:
        h, w, top, left, rows, cols = (batch.column(c)[k].as_py() for c in ("h", "w", "top", "left", "rows", "cols"))
        own = np.frombuffer(batch.column("data")[k].as_buffer(), np.uint8).reshape(rows, cols)
        return blur(own)[top : top + h, left : left + w]

    def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                own = blurred(batch, k)
                yield batch.column("image_name")[k].as_py(), own.min(), own.max()

    def bins(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                lo, hi = batch.column("lo")[k].as_py(), batch.column("hi")[k].as_py()
                n = np.histogram(blurred(batch, k), BINS, (lo, hi))[0] if lo < hi else np.zeros(BINS, np.int64)
                yield batch.column("image_name")[k].as_py(), n.tolist()

    def split(table: pa.Table) -> pa.Table:
        n = np.zeros(BINS, np.int64)
        n[table.column("bin").to_numpy()] = table.column("n").to_numpy()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        return pa.table({"image_name": table.column("image_name").slice(0, 1), "threshold": pa.array([images.otsu_of(n, lo, hi)])})

    range_kind, bins_kind = "image_name string, lo double, hi double", "image_name string, counts array<long>"
    range_ = smoothed.mapInArrow(lambda b: _batches(range_kind, ends(b)), range_kind).groupBy("image_name").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    range_ = checkpointed(range_)
    counted = beside(smoothed, range_, ["image_name"]).mapInArrow(lambda b: _batches(bins_kind, bins(b)), bins_kind)
    counted = counted.select("image_name", F.posexplode("counts").alias("bin", "n")).groupBy("image_name", "bin").agg(F.sum("n").alias("n"))
    return counted.join(range_, "image_name").groupBy("image_name").applyInArrow(split, "image_name string, threshold double")


def _land_of(p: Part, threshold: float, nir: int) -> np.ndarray:
    """Right up to MARGIN from the sides where the scene goes on."""
    return blur(raster.disk_median(images.to_byte(p.data[nir]), RADIUS)) > threshold


MASK = "image_name string, y int, x int, h int, w int, height int, width int, gt array<double>, prj string, mask binary"


def masks(windows: DataFrame, nir: int = NIR) -> DataFrame:
    """The land mask of each window (MASK), one bit a pixel in rows of whole bytes. Windows need a margin of MARGIN."""

    def mask(p: Part, threshold: float) -> Iterator[tuple]:
        own = p.within(_land_of(p, threshold, nir), 0)
        yield p.image_name, p.y, p.x, p.h, p.w, p.height, p.width, p.gt, p.prj, np.packbits(own, axis=1).tobytes()

    return _each(beside(windows, checkpointed(thresholds(windows, nir)), ["image_name"]), MASK, mask, nir + 1, ("threshold",))


# Tiles.
def _cut(p: Part, mask: np.ndarray | None, crop: int, step: int, bands, black: int) -> Iterator[tuple]:
    """The tiles that start in a window and are not black: whose four corners are not all 0 in one band."""
    scene = p.data if mask is None else p.data * mask
    left, dx, _, top, _, dy = p.gt or (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)
    down, across = -(-p.height // step), -(-p.width // step)
    for y in range(-(-p.y // step) * step, p.y + p.h, step):
        for x in range(-(-p.x // step) * step, p.x + p.w, step):
            r, c = y - p.y + p.top, x - p.x + p.left
            part = scene[:, r : r + crop, c : c + crop]
            if not part[black][np.ix_([0, -1], [0, -1])].any():
                continue
            tile = images.stretch(part[list(bands)])
            data = np.stack([images.equalise(b) for b in tile], axis=-1).tobytes()
            yield p.image_name, y // step, x // step, part.shape[1], part.shape[2], top + y * dy, left + x * dx, dy, dx, down, across, data


def numbered(placed: DataFrame) -> DataFrame:
    """Tiles with tile_num, their place among the tiles of their scene that stay, in rows from the top: the tiles before
    the row, and those before it in the row."""
    rows = placed.groupBy("image_name", "id_i").agg(F.sort_array(F.collect_list("id_j")).alias("row"))  # as long as a scene is wide
    before = F.coalesce(F.sum(F.size("row")).over(Window.partitionBy("image_name").orderBy("id_i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    met = beside(placed, rows.withColumn("first", before), ["image_name", "id_i"])
    return met.withColumn("tile_num", (F.col("first") + F.array_position("row", F.col("id_j")) - 1).cast("int")).select(*names_of(TILE))


def tiles(found: DataFrame, crop: int = CROP, overlap: float = OVERLAP, water: bool = True, bands=BANDS, black: int = BLACK, nir: int = NIR, side: int = SIDE) -> DataFrame:
    """The tiles (TILE) of windows, or of scenes in whole rows, with water blacked out first if asked for. Windows need a
    margin behind of crop - step, and with water MARGIN more on all sides. A scene of another number of bands than is read
    gives no tile."""
    step = int(crop * (1 - overlap))
    if "top" not in found.columns:
        margin = MARGIN if water else 0
        found = windows_of(found, side, step, margin, margin + max(0, crop - step))
    need = max(*bands, black, nir if water else 0) + 1

    def dry(p: Part) -> Iterator[tuple]:
        return _cut(p, None, crop, step, bands, black)

    def wet(p: Part, threshold: float) -> Iterator[tuple]:
        return _cut(p, _land_of(p, threshold, nir), crop, step, bands, black)

    placed = _each(beside(found, checkpointed(thresholds(found, nir)), ["image_name"]), _PLACED, wet, need, ("threshold",)) if water else _each(found, _PLACED, dry, need)
    return numbered(checkpointed(placed))


def pixels_of_tile(data, h: int, w: int):
    """The (rows, columns, bands) array of a tile."""
    return np.frombuffer(data, np.uint8).reshape(h, w, -1)
