"""GeoTIFF scenes: whole files, windows of files read by byte ranges, and a writer of masks."""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..functions import crs
from ..session import ship
from .shapefile import open_store

# TIFF field sizes and the tags read here.
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 11: 4, 12: 8, 16: 8}
_CODE = {1: "B", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 339
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
SCALE, TIEPOINT, MATRIX, KEYS, NUMBERS, ASCII = 33550, 33922, 34264, 34735, 34736, 34737

SCHEMA = "path string, image_name string, height int, width int, bands int, gt array<double>, citation string, prj string, dtype string, data binary, error string"


def _lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the first bit first; 256 empties the table, 257 ends."""
    out, table, before, width = bytearray(), [], b"", 9
    held, have = 0, 0
    for byte in data:
        held, have = held << 8 | byte, have + 8
        if have < width:
            continue
        have -= width
        code, held = held >> have, held & ((1 << have) - 1)
        if code == 257:
            break
        if code == 256:
            table, before, width = [bytes([k]) for k in range(256)] + [b"", b""], b"", 9
            continue
        if code > len(table) or (code == len(table) and not before):
            raise ValueError("damaged LZW data")
        word = table[code] if code < len(table) else before + before[:1]
        out += word
        if before:
            table.append(before + word[:1])
        before = word
        width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
    return bytes(out)


#: Bytes of a strip or tile that are unpacked at once; of a larger deflated one only the rows asked for are kept.
AT_ONCE = 1 << 24


class Raster:
    """The first image of a classic or a big TIFF, read by byte ranges: read(at, n) gives n bytes. Of the lists of strips
    or tiles only the parts that a window needs are read.

    Strips and tiles, plain, deflate or LZW, with horizontal differences or without."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        head = read(0, 16)
        self.order = {b"II": "<", b"MM": ">"}[head[:2]]
        magic = struct.unpack(self.order + "H", head[2:4])[0]
        if magic not in (42, 43):
            raise ValueError("not a TIFF")
        big = magic == 43
        number, entry, inline, first = ("Q", "HHQ", 8, 8) if big else ("H", "HHI", 4, 2)
        offset = self.order + ("Q" if big else "I")
        at = struct.unpack(offset, head[8:16] if big else head[4:8])[0]
        wide = struct.calcsize("=" + entry) + inline
        n = struct.unpack(self.order + number, read(at, first))[0]
        table = read(at + first, wide * n)
        if len(table) < wide * n:
            raise ValueError("the directory is cut off")
        #: kind, number of values and place of each tag.
        self.tags: dict[int, tuple[int, int, int]] = {}
        for k in range(n):
            tag, kind, values = struct.unpack(self.order + entry, table[wide * k : wide * (k + 1) - inline])
            value = table[wide * (k + 1) - inline : wide * (k + 1)]
            near = _SIZE.get(kind, 1) * values <= inline
            self.tags[tag] = kind, values, at + first + wide * (k + 1) - inline if near else struct.unpack(offset, value)[0]
        self.width, self.height = self.one(WIDTH), self.one(HEIGHT)
        self.bands, self.bits, self.pack = self.one(SAMPLES, 1), self.one(BITS, 1), self.one(COMPRESSION, 1)
        if self.pack not in (1, 5, 8, 32946):
            raise ValueError(f"compression {self.pack} is not read")
        self.apart, self.tiled = self.one(PLANAR, 1) == 2, TILE_OFFSETS in self.tags
        self.th, self.tw = (self.one(TILE_HEIGHT), self.one(TILE_WIDTH)) if self.tiled else (min(self.height, self.one(ROWS, self.height)), self.width)
        self.dtype = np.dtype(np.uint8) if self.bits == 1 else np.dtype(f"{self.order}{'uif'[self.one(FORMAT, 1) - 1]}{self.bits // 8}")

    def values(self, tag: int, first: int = 0, stop: int | None = None):
        """The values of a tag from `first` on, bytes for text; None without the tag."""
        if tag not in self.tags:
            return None
        kind, n, at = self.tags[tag]
        n = (n if stop is None else min(n, stop)) - first
        size = _SIZE.get(kind, 1)
        data = self.read(at + first * size, n * size)
        return data if kind == 2 else list(struct.unpack(f"{self.order}{n}{_CODE[kind]}", data)) if kind in _CODE else None

    def one(self, tag: int, default: int | None = None) -> int:
        found = self.values(tag, 0, 1)
        if not found and default is None:
            raise ValueError(f"tag {tag} is missing")
        return found[0] if found else default

    @property
    def gt(self) -> list[float] | None:
        """The six numbers of the geotransform."""
        m, scale, tie = self.values(MATRIX), self.values(SCALE), self.values(TIEPOINT)
        if m:
            return [m[3], m[0], m[1], m[7], m[4], m[5]]
        if not scale or not tie:
            return None
        (sx, sy, _), (i, j, _, x, y, _) = scale, tie[:6]
        return [x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy]

    @property
    def citation(self) -> str | None:
        text = self.values(ASCII)
        return text.split(b"\0")[0].decode("latin-1").rstrip("|") if text else None

    @property
    def prj(self) -> str | None:
        """The text of the coordinate system, of the keys, or of a citation that is one."""
        found = crs.from_keys(self.values(KEYS), self.values(NUMBERS))
        if found is None and (self.citation or "").startswith(("PROJCS[", "GEOGCS[")) and "SPHEROID" in self.citation:
            found = crs.parse(self.citation)
        return crs.text(found) if found else None

    def _rows(self, at: int, size: int, line: int, first: int, stop: int, rows: int) -> bytes:
        """The rows first to stop, of `line` bytes each, of a strip or tile."""
        if self.pack == 1:
            return self.read(at + first * line, (stop - first) * line)
        if self.pack == 5:
            return _lzw(self.read(at, size))[first * line : stop * line]
        if rows * line <= AT_ONCE:
            return zlib.decompress(self.read(at, size))[first * line : stop * line]
        stream, kept, done, skip, need = zlib.decompressobj(), bytearray(), 0, first * line, (stop - first) * line
        while done < size and len(kept) < need:
            data = self.read(at + done, min(1 << 16, size - done))
            done += len(data)
            while data and len(kept) < need:
                part = stream.decompress(data, AT_ONCE)
                data = stream.unconsumed_tail
                gone = min(skip, len(part))
                skip -= gone
                kept += part[gone:]
        return bytes(kept[:need])

    def window(self, y1: int, x1: int, y2: int, x2: int, bands: list[int] | None = None) -> np.ndarray:
        """(bands, rows, columns) of the window, held within the image; only what it touches is read."""
        y1, x1, y2, x2 = max(0, y1), max(0, x1), min(self.height, y2), min(self.width, x2)
        bands = list(range(self.bands)) if bands is None else bands
        out = np.zeros((len(bands), max(0, y2 - y1), max(0, x2 - x1)), self.dtype)
        if not out.size:
            return out
        across, down = -(-self.width // self.tw), -(-self.height // self.th)
        each = 1 if self.apart else self.bands
        line = -(-self.tw * each // 8) if self.bits == 1 else self.tw * each * self.dtype.itemsize
        for plane in bands if self.apart else [0]:
            for row in range(y1 // self.th, -(-y2 // self.th)):
                k = (plane * down + row) * across + x1 // self.tw
                stop = (plane * down + row) * across + -(-x2 // self.tw)
                lists = (TILE_OFFSETS, TILE_COUNTS) if self.tiled else (OFFSETS, COUNTS)
                ty = row * self.th
                rows = self.th if self.tiled else min(self.th, self.height - ty)
                a, c = max(ty, y1), min(ty + rows, y2)
                for j, (at, size) in enumerate(zip(*(self.values(t, k, stop) for t in lists)), x1 // self.tw):
                    tx = j * self.tw
                    data = self._rows(at, size, line, a - ty, c - ty, rows)
                    if self.bits == 1:
                        block = np.unpackbits(np.frombuffer(data, np.uint8).reshape(c - a, -1), axis=1)[:, : self.tw, None]
                    else:
                        block = np.frombuffer(data, self.dtype, (c - a) * self.tw * each).reshape(c - a, self.tw, each)
                        if self.one(PREDICTOR, 1) == 2:
                            block = np.cumsum(block, axis=1, dtype=self.dtype.newbyteorder("="))
                    b, d = max(tx, x1), min(tx + self.tw, x2)
                    part = block[:, b - tx : d - tx].transpose(2, 0, 1)
                    where = (slice(None), slice(a - y1, c - y1), slice(b - x1, d - x1))
                    if self.apart:
                        out[bands.index(plane)][where[1:]] = part[0]
                    else:
                        out[where] = part[bands]
        return out


def decode(raw: bytes, window: tuple[int, int, int, int] | None = None) -> tuple[np.ndarray, list[float] | None, str | None]:
    """(bands, height, width) array, the six numbers of the geotransform, the citation of the projection; with a window
    (y1, x1, y2, x2) only that part of the array."""
    image = Raster(lambda at, n: raw[at : at + n])
    return image.window(*(window or (0, 0, image.height, image.width))), image.gt, image.citation


def _place(gt: list[float] | None, citation: str | None, prj: str | None = None) -> list[tuple]:
    """The tags of a geotransform, a citation and a coordinate system."""
    tags = []
    if prj:
        keys, numbers = crs.to_keys(crs.parse(prj))
        tags += [(KEYS, 3, keys)] + ([(NUMBERS, 12, numbers)] if numbers else [])
    if gt and (gt[2] or gt[4]):
        tags.append((MATRIX, 12, [gt[1], gt[2], 0.0, gt[0], gt[4], gt[5], 0.0, gt[3], *[0.0] * 7, 1.0]))
    elif gt:
        tags += [(SCALE, 12, [gt[1], -gt[5], 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, gt[0], gt[3], 0.0])]
    return tags + [(ASCII, 2, citation.encode("latin-1") + b"|\0")] if citation else tags


def _directory(tags: list[tuple], at: int) -> bytes:
    """The directory of tags (number, kind, values) that stands at `at`, and what does not fit in its entries."""
    body, extra, far = struct.pack("<H", len(tags)), b"", at + 6 + 12 * len(tags)
    for tag, kind, values in sorted(tags):
        packed = values if kind == 2 else struct.pack(f"<{len(values)}{_CODE[kind]}", *values)
        body += struct.pack("<HHI", tag, kind, len(values))
        if len(packed) <= 4:
            body += packed.ljust(4, b"\0")
        else:
            body += struct.pack("<I", far + len(extra))
            extra += packed + b"\0" * (len(packed) % 2)
    return body + struct.pack("<I", 0) + extra


def encode(image: np.ndarray, gt: list[float] | None = None, citation: str | None = None, one_bit: bool = False, prj: str | None = None) -> bytes:
    """A little-endian TIFF of one strip; with one_bit a mask of one bit a pixel."""
    bands, h, w = image.shape
    data = np.packbits(image[0] > 0, axis=1).tobytes() if one_bit else np.ascontiguousarray(image.transpose(1, 2, 0)).tobytes()
    bits = 1 if one_bit else image.dtype.itemsize * 8
    tags = [(WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [bits] * bands), (COMPRESSION, 3, [1]), (262, 3, [1]), (OFFSETS, 4, [8]), (SAMPLES, 3, [bands]), (ROWS, 4, [h]), (COUNTS, 4, [len(data)]), (PLANAR, 3, [1]), (FORMAT, 3, [{"u": 1, "i": 2, "f": 3}.get(image.dtype.kind, 1)] * bands)]
    at = 8 + len(data) + len(data) % 2
    return struct.pack("<2sHI", b"II", 42, at) + data + b"\0" * (len(data) % 2) + _directory(tags + _place(gt, citation, prj), at)


def encode_mask(height: int, width: int, tiles: list[bytes], side: int, gt: list[float] | None, citation: str | None, prj: str | None = None) -> Iterator[bytes]:
    """A TIFF of one bit a pixel in deflated tiles: the directory first, then the tiles in their order."""
    sizes = [len(t) for t in tiles]
    tags = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [1]), (COMPRESSION, 3, [8]), (262, 3, [1]), (SAMPLES, 3, [1]), (PLANAR, 3, [1]), (TILE_WIDTH, 4, [side]), (TILE_HEIGHT, 4, [side]), (TILE_COUNTS, 4, sizes)]
    tags += _place(gt, citation, prj)
    at = 8 + len(_directory([*tags, (TILE_OFFSETS, 4, sizes)], 8))
    offsets = [at + before for before in itertools.accumulate(sizes, initial=0)][:-1]
    yield struct.pack("<2sHI", b"II", 42, 8) + _directory([*tags, (TILE_OFFSETS, 4, offsets)], 8)
    yield from tiles


def read(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """The scenes of a folder. A file that cannot be decoded has a null payload and its error, so nothing is lost
    silently."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.substring_index(F.element_at(F.split("path", "/"), -1), ".tif", 1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p, n, raw in zip(frame["path"], frame["image_name"], frame["content"]):
                try:
                    own = Raster(lambda at, n, raw=raw: raw[at : at + n])
                    image = own.window(0, 0, own.height, own.width)
                    rows.append((p, n, image.shape[1], image.shape[2], image.shape[0], own.gt, own.citation, own.prj, image.dtype.str, image.tobytes(), None))
                except (ValueError, KeyError, IndexError, struct.error, zlib.error) as error:
                    rows.append((p, n, *[None] * 8, str(error)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return found.select("path", name.alias("image_name"), "content").mapInPandas(run, SCHEMA)


def pixels(row) -> np.ndarray:
    """The (bands, height, width) array of a row of read()."""
    return np.frombuffer(row["data"], np.dtype(row["dtype"])).reshape(int(row["bands"]), int(row["height"]), int(row["width"]))


# Scenes by windows.
#: A window of height h and width w at y, x of its scene, and the pixels (bands, rows, cols) from `top` rows and `left`
#: columns before it to as far behind it as asked for and as the scene goes.
WINDOW = (
    "path string, image_name string, y int, x int, h int, w int, top int, left int, rows int, cols int, height int, width int, bands int, "
    "gt array<double>, citation string, prj string, dtype string, data binary, error string"
)
#: Windows of a partition at most.
GROUP = 8


def window_sides(height: int, width: int, strips: bool, side: int, step: int) -> tuple[int, int]:
    """Height and width of the windows of a scene, multiples of step: squares, or, of strips, bands of the whole width
    with as many pixels."""
    high = max(step, side // step * step)
    return (high, high) if not strips else (max(step, high * high // max(width, 1) // step * step), max(width, 1))


def window_places(height: int, width: int, high: int, wide: int) -> list[tuple[int, int]]:
    return [(y, x) for y in range(0, height, high) for x in range(0, width, wide)]


class _Windows(InputPartition):
    def __init__(self, path: str, places: list[tuple[int, int]], high: int, wide: int, error: str | None = None):
        self.path, self.places, self.high, self.wide, self.error = path, places, high, wide, error


class _WindowReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.side, self.step = int(options.get("window", 1600)), int(options.get("step", 160))
        self.before, self.after = int(options.get("before", 0)), int(options.get("after", 0))
        self.bands = [int(b) for b in options["bands"].split(",")] if options.get("bands") else None

    def _plan(self, path: str) -> list[_Windows]:
        store, _ = open_store(self.root)
        try:
            with store.open_input_file(path) as f:
                image = Raster(lambda at, n: f.read_at(n, at))
        except (OSError, ValueError, KeyError, IndexError, struct.error) as error:
            return [_Windows(path, [], 0, 0, str(error) or type(error).__name__)]
        high, wide = window_sides(image.height, image.width, not image.tiled, self.side, self.step)
        places = window_places(image.height, image.width, high, wide)
        return [_Windows(path, places[k : k + GROUP], high, wide) for k in range(0, len(places), GROUP)]

    def partitions(self) -> list[_Windows]:
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow import fs

        store, path = open_store(self.root)
        if path.endswith(".tif"):
            found = [path]
        else:
            found = sorted(f.path for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.path.endswith(".tif") and not f.base_name.startswith((".", "_")))
        with ThreadPoolExecutor(32) as pool:  # a directory is a few KB, and waiting for it is most of the work
            return [p for planned in pool.map(self._plan, found) for p in planned]

    def read(self, partition: _Windows) -> Iterator[pa.RecordBatch]:
        name = partition.path.rsplit("/", 1)[-1].split(".tif")[0]
        kinds = [pa.string(), pa.string(), *[pa.int32()] * 11, pa.list_(pa.float64()), *[pa.string()] * 3, pa.binary(), pa.string()]
        names = [c.split()[0] for c in WINDOW.split(", ")]
        batch = lambda row: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)
        if partition.error:
            yield batch((partition.path, name, *[None] * 16, partition.error))
            return
        store, _ = open_store(self.root)
        with store.open_input_file(partition.path) as f:
            image = Raster(lambda at, n: f.read_at(n, at))
            for y, x in partition.places:
                h, w = min(partition.high, image.height - y), min(partition.wide, image.width - x)
                top, left = min(self.before, y), min(self.before, x)
                try:
                    data = image.window(y - top, x - left, y + h + self.after, x + w + self.after, self.bands)
                except (ValueError, IndexError, struct.error, zlib.error) as error:
                    yield batch((partition.path, name, y, x, h, w, *[None] * 12, str(error) or type(error).__name__))
                    continue
                yield batch((partition.path, name, y, x, h, w, top, left, *data.shape[1:], image.height, image.width, len(data), image.gt, image.citation, image.prj, data.dtype.str, data.tobytes(), None))


class GeotiffWindows(DataSource):
    """spark.read.format("geotiff_windows").option("window", 1600).option("before", 13).option("after", 53).load(path).

    A row is a window of a scene (WINDOW), read by byte ranges, so a task holds one window, however large the scene is.
    Windows are `window` pixels wide and high, in multiples of `step`; of a file in strips they have the whole width and
    are flat. `before` and `after` are the pixels around it that come along, as far as the scene goes; option("bands",
    "3") reads some bands alone, from 0. A file, or a window, that cannot be read is a row with its error."""

    @classmethod
    def name(cls) -> str:
        return "geotiff_windows"

    def schema(self) -> str:
        return WINDOW

    def reader(self, schema) -> _WindowReader:
        return _WindowReader(dict(self.options))


# Masks.
MASK_TILE = 160


class _Moves(WriterCommitMessage):
    def __init__(self, moves: list[tuple[str, str]]):
        self.moves = moves


class _MaskWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.root, self.side = options["path"], int(options.get("tile", MASK_TILE))
        self.citation, self.overwrite = options.get("citation"), overwrite
        if self.side % 16:
            raise ValueError("tiles of a TIFF are a multiple of 16 pixels wide")

    def _tiles(self, rows: Iterator) -> tuple[dict, object]:
        """The deflated tiles of one scene by their place, of its windows."""
        found, last = {}, None
        for last in rows:
            if last["y"] % self.side or last["x"] % self.side:
                raise ValueError(f"{last['image_name']}: a window at {last['y']}, {last['x']} does not start on a tile of {self.side}")
            bits = np.unpackbits(np.frombuffer(last["mask"], np.uint8).reshape(last["h"], -1), axis=1)[:, : last["w"]]
            for y in range(0, last["h"], self.side):
                for x in range(0, last["w"], self.side):
                    tile = np.zeros((self.side, self.side), np.uint8)
                    part = bits[y : y + self.side, x : x + self.side]
                    tile[: part.shape[0], : part.shape[1]] = part
                    found[(last["y"] + y) // self.side, (last["x"] + x) // self.side] = zlib.compress(np.packbits(tile, axis=1).tobytes())
        return found, last

    def write(self, rows: Iterator) -> _Moves:
        store, folder = open_store(self.root)
        store.create_dir(folder, recursive=True)
        moves: list[tuple[str, str]] = []
        for name, own in itertools.groupby(rows, key=lambda r: r["image_name"]):
            target = f"{folder}/{name}.tif"
            if any(target == m[1] for m in moves):
                raise ValueError(f"the windows of {name} do not follow each other; write with save_masks")
            found, last = self._tiles(own)
            places = [(y, x) for y in range(-(-last["height"] // self.side)) for x in range(-(-last["width"] // self.side))]
            if len(found) != len(places):
                raise ValueError(f"{name}: {len(places) - len(found)} of {len(places)} tiles are missing")
            moves.append((f"{folder}/.{uuid.uuid4().hex}.tif", target))
            with store.open_output_stream(moves[-1][0]) as out:
                for data in encode_mask(last["height"], last["width"], [found[p] for p in places], self.side, last["gt"], self.citation, last["prj"]):
                    out.write(data)
        return _Moves(moves)

    def commit(self, messages: list[_Moves | None]) -> None:
        store, folder = open_store(self.root)
        moves = [m for message in messages if message for m in message.moves]
        twice = [t for t, n in Counter(t for _, t in moves).items() if n > 1]
        if twice:
            self.abort(messages)
            raise ValueError(f"the windows of {twice[0]} were in two partitions; write with save_masks")
        from pyarrow import fs

        before = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.extension == "tif" and not f.base_name.startswith(".")] if self.overwrite else []
        for old, new in moves:
            store.move(old, new)
        for path in set(before) - {new for _, new in moves}:
            store.delete_file(path)

    def abort(self, messages: list[_Moves | None]) -> None:
        store, _ = open_store(self.root)
        for message in messages:
            for old, _ in message.moves if message else []:
                store.delete_file(old)


class MaskSink(DataSource):
    """A file for each scene, of one bit a pixel in deflated tiles with the scene's geotransform, from windows of masks
    (image_name, y, x, h, w, height, width, gt, prj, mask). The windows of a scene have to be in one partition, one after the
    other; save_masks sees to it. Tiles that no window has are an error."""

    @classmethod
    def name(cls) -> str:
        return "geotiff_masks"

    def writer(self, schema, overwrite: bool) -> _MaskWriter:
        return _MaskWriter(dict(self.options), overwrite)


def save_masks(masks: DataFrame, path: str, citation: str | None = None, tile: int = MASK_TILE, mode: str = "append") -> None:
    """One mask file for each scene; a task holds the bits of one scene, deflated."""
    register(masks.sparkSession)
    out = masks.select("image_name", "y", "x", "h", "w", "height", "width", "gt", "prj", "mask").repartition("image_name").sortWithinPartitions("image_name", "y", "x")
    out = out.write.format("geotiff_masks").mode(mode).option("tile", tile)
    (out.option("citation", citation) if citation else out).save(path)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(GeotiffWindows)
    spark.dataSource.register(MaskSink)
