"""PNG images for training: decoding rows of binaryFile to RGB."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

# The first bytes of a file; channels by kind of colour; start and step of the seven passes of interlacing.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
GRAY, RGB, PALETTE, GRAY_ALPHA, RGB_ALPHA = 0, 2, 3, 4, 6
CHANNELS = {GRAY: 1, RGB: 3, PALETTE: 1, GRAY_ALPHA: 2, RGB_ALPHA: 4}
PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))
SCHEMA = "path string, image_name string, height int, width int, bands int, dtype string, data binary, error string"


def _chunks(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = 8
    while at + 12 <= len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        data = raw[at + 8 : at + 8 + n]
        if struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + data):
            raise ValueError(f"{kind.decode('latin-1')} is damaged")
        yield kind, data
        at += 12 + n


def _average(line: bytearray, up: bytes, step: int) -> None:
    for k in range(len(line)):
        line[k] = (line[k] + ((line[k - step] if k >= step else 0) + up[k]) // 2) & 255


def _paeth(line: bytearray, up: bytes, step: int) -> None:
    for k in range(len(line)):
        a, b, c = (line[k - step], up[k], up[k - step]) if k >= step else (0, up[k], 0)
        pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
        line[k] = (line[k] + (a if pa <= pb and pa <= pc else b if pb <= pc else c)) & 255


def unfiltered(data: bytes, height: int, line: int, step: int) -> np.ndarray:
    """The bytes of `height` rows of `line` bytes, each after the number of its filter; `step` is the bytes of a pixel."""
    rows = np.frombuffer(data, np.uint8, height * (line + 1)).reshape(height, line + 1)
    out, up = np.zeros((height, line), np.uint8), np.zeros(line, np.uint8)
    for y, kind in enumerate(rows[:, 0]):
        own = rows[y, 1:]
        if kind == 1:  # each byte is a difference to the pixel before: sums along the row, channel by channel
            for c in range(step):
                out[y, c::step] = np.cumsum(own[c::step], dtype=np.uint8)
        elif kind == 2:
            out[y] = own + up
        elif kind in (3, 4):
            held = bytearray(own.tobytes())
            (_average if kind == 3 else _paeth)(held, up.tobytes(), step)
            out[y] = np.frombuffer(held, np.uint8)
        elif kind == 0:
            out[y] = own
        else:
            raise ValueError(f"filter {kind} is not known")
        up = out[y]
    return out


def decode(raw: bytes) -> np.ndarray:
    """(height, width, 3): gray becomes three equal bands, palettes their colours, alpha is dropped. Bytes, or two-byte
    numbers where the file has 16 bits; fewer bits of gray are spread over a byte."""
    if raw[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    found: dict[bytes, bytes] = {}
    for kind, data in _chunks(raw):
        found[kind] = found.get(kind, b"") + data
    if b"IHDR" not in found or b"IDAT" not in found:
        raise ValueError("the file is cut off")
    width, height, bits, colour, _, _, woven = struct.unpack(">IIBBBBB", found[b"IHDR"])
    if colour not in CHANNELS or (colour == PALETTE and b"PLTE" not in found):
        raise ValueError(f"colours {colour} are not read")
    n, data, at = CHANNELS[colour], zlib.decompress(found[b"IDAT"]), 0
    image = np.zeros((height, width, n), np.uint16 if bits == 16 else np.uint8)
    for y0, x0, dy, dx in PASSES if woven else ((0, 0, 1, 1),):
        h, w = -(-(height - y0) // dy), -(-(width - x0) // dx)
        if h <= 0 or w <= 0:
            continue
        line = -(-w * n * bits // 8)
        rows = unfiltered(data[at : at + h * (line + 1)], h, line, max(1, n * bits // 8))
        at += h * (line + 1)
        if bits == 16:
            part = rows.view(">u2")
        elif bits == 8:
            part = rows
        else:
            part = np.unpackbits(rows, axis=1).reshape(h, -1, bits)[:, : w * n]
            part = (part * (1 << np.arange(bits)[::-1])).sum(axis=2).astype(np.uint8)
        image[y0::dy, x0::dx] = part.reshape(h, w, n)
    if colour == PALETTE:
        colours = np.frombuffer(found[b"PLTE"], np.uint8).reshape(-1, 3)
        return colours[image[:, :, 0]]
    if colour in (GRAY, GRAY_ALPHA):
        gray = image[:, :, :1] * (255 // ((1 << bits) - 1)) if bits < 8 else image[:, :, :1]
        return np.repeat(gray.astype(image.dtype), 3, axis=2)
    return np.ascontiguousarray(image[:, :, :3])


def read(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """The images of a folder as rows of (rows, columns, bands) bytes. One that cannot be decoded is a row with its error."""
    ship(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p, n, raw in zip(frame["path"], frame["image_name"], frame["content"]):
                try:
                    image = decode(raw)
                    rows.append((p, n, *image.shape, image.dtype.str, image.tobytes(), None))
                except (ValueError, IndexError, struct.error, zlib.error) as error:
                    rows.append((p, n, *[None] * 5, str(error)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return found.select("path", name.alias("image_name"), "content").mapInPandas(run, SCHEMA)


def pixels(row) -> np.ndarray:
    return np.frombuffer(row["data"], np.dtype(row["dtype"])).reshape(int(row["height"]), int(row["width"]), int(row["bands"]))
