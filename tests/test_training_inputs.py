import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.operators import dataset
from quarryline.sources import annotations, png


def filtered(rows, step, kinds):
    """Rows after filters, by plain loops."""
    out, up = b"", bytes(len(rows[0]))
    for row, kind in zip(rows, kinds):
        line = bytearray()
        for k, v in enumerate(row):
            a, b, c = (row[k - step] if k >= step else 0), up[k], (up[k - step] if k >= step else 0)
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line.append((v - (0, a, b, (a + b) // 2, near)[kind]) % 256)
        out += bytes([kind]) + bytes(line)
        up = row
    return out


def packed(part, bits):
    h, w, n = part.shape
    if bits == 16:
        return [r.astype(">u2").tobytes() for r in part]
    flat = part.reshape(h, w * n, 1) >> np.arange(bits)[::-1] & 1
    return [np.packbits(r.ravel().astype(np.uint8)).tobytes() for r in flat]


def file(values, bits, colour, kinds=(0, 1, 2, 3, 4), palette=None, woven=False):
    h, w, n = values.shape
    step, body = max(1, n * bits // 8), b""
    for y, x, dy, dx in png.PASSES if woven else ((0, 0, 1, 1),):
        part = values[y::dy, x::dx]
        if part.size:
            body += filtered(packed(part, bits), step, [kinds[k % len(kinds)] for k in range(part.shape[0])])
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    data = zlib.compress(body)
    out = png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, bits, colour, 0, 0, int(woven)))
    out += chunk(b"PLTE", palette.tobytes()) if palette is not None else b""
    return out + chunk(b"IDAT", data[:7]) + chunk(b"IDAT", data[7:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("woven", [False, True])
@pytest.mark.parametrize("colour, bits", [(0, 1), (0, 2), (0, 4), (0, 8), (0, 16), (2, 8), (2, 16), (3, 1), (3, 4), (3, 8), (4, 8), (6, 8), (6, 16)])
def test_images_of_every_kind(colour, bits, woven):
    """All five filters, palettes, gray to RGB, alpha dropped, with and without interlacing."""
    rng = np.random.default_rng(bits + colour)
    for h, w in ((11, 13), (1, 1), (9, 2)):
        values = rng.integers(0, 1 << bits, (h, w, png.CHANNELS[colour]))
        palette = rng.integers(0, 256, (1 << bits, 3)).astype(np.uint8) if colour == 3 else None
        got = png.decode(file(values, bits, colour, palette=palette, woven=woven))
        gray = values[:, :, :1] * (255 // ((1 << bits) - 1) if bits < 8 else 1)
        want = palette[values[:, :, 0]] if colour == 3 else values[:, :, :3] if colour in (2, 6) else np.repeat(gray, 3, axis=2)
        assert got.shape == (h, w, 3) and (got == want).all() and got.dtype == (np.uint16 if bits == 16 else np.uint8)


def test_training_images_with_their_annotations(spark, tmp_path):
    image = np.random.default_rng(1).integers(0, 256, (5, 6, 4))
    (tmp_path / "a.png").write_bytes(file(image, 8, 6))
    raw = file(image, 8, 6)
    (tmp_path / "bad.png").write_bytes(raw[:60] + b"x" + raw[61:])
    (tmp_path / "via.json").write_text('{"k": {"filename": "a.png", "regions": [{"shape_attributes": {"all_points_x": [0, 3, 3], "all_points_y": [0, 0, 2]}, "region_attributes": {"object_name": "ice"}}]}, "l": {"filename": "none.png", "regions": []}}')
    rows = {r.image_name: r for r in png.read(spark, str(tmp_path)).collect()}
    assert (png.pixels(rows["a"]) == image[:, :, :3]).all() and rows["bad"].data is None and "damaged" in rows["bad"].error
    met = annotations.with_scenes(annotations.read(spark, str(tmp_path / "via.json")), png.read(spark, str(tmp_path))).collect()
    assert [(r.image_name, r.object_name, len(r.ring)) for r in met] == [("a", "ice", 3)]


def test_classes_of_sources(spark):
    rows = [("b", 1, "bird, of prey", 1), ("a", 7, "ant", 2), ("b", 1, "again", 3), ("b", 2, "bee", 4)]
    classes = dataset.registry(spark.createDataFrame(rows, "source string, id int, name string, at long"))
    assert sorted(map(tuple, classes.collect())) == [(0, "", 0, ".0", "BG"), (1, "b", 1, "b.1", "bird"), (2, "a", 7, "a.7", "ant"), (3, "b", 2, "b.2", "bee")]
    assert {r.source: r.active for r in dataset.active(classes).collect()} == {"a": [0, 2], "b": [0, 1, 3]}
    found = dataset.with_class(spark.createDataFrame([("a", 7), ("a", 8)], "source string, id int"), classes)
    assert {r.id: (r.class_id, r.active) for r in found.collect()} == {7: (2, [0, 2]), 8: (None, None)}


def test_random_regions_are_fair_and_repeat(spark):
    images = spark.createDataFrame([(1, 40, 60), (2, 40, 60), (3, 1, 60)], "image long, height int, width int")
    gt = spark.createDataFrame([(1, k, 10.0, 5.0 + k, 14.0, 15.0 + k) for k in range(3)] + [(3, 0, 0.0, 0.0, 1.0, 9.0)], "image long, gt int, y1 double, x1 double, y2 double, x2 double")
    rows = dataset.random_rois(images, gt, 4000).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, dataset.random_rois(images.repartition(3), gt, 4000).collect()))
    by = {k: [r for r in rows if r.image == k] for k in (1, 2, 3)}
    assert len(by[1]) == 4000 and len(by[2]) == 4000 and not by[3]
    assert len({r.roi for r in by[1]}) == 4000 and all(0 <= r.y1 < r.y2 <= 40 and 0 <= r.x1 < r.x2 <= 60 for r in rows)
    first = [r for r in by[1] if r.roi < 1200]
    assert all(6 <= r.y1 and r.y2 < 18 and 0 <= r.x1 and r.x2 < 25 for r in first)
    # Pairs of different numbers of 40, all alike: the share of each lower corner.
    low = np.bincount([r.y1 for r in by[2]], minlength=40)[:39]
    want = 4000 * (39 - np.arange(39)) / (40 * 39 / 2)
    assert ((low - want) ** 2 / want)[:35].sum() < 70
    assert abs(np.corrcoef([r.y1 for r in by[2]], [r.x1 for r in by[2]])[0, 1]) < 0.06
    assert spark.range(1).select(dataset.random(F.lit(-5), F.lit(1)).alias("r")).first().r >= 0


def test_draws_by_columns_are_those_of_the_counters(spark):
    rows = spark.range(-50, 2000).select((F.col("id") * 7_919_123).alias("image"), F.pmod(F.col("id"), F.lit(10)).alias("roi"))
    got = dataset._drawn(rows, "image", "roi")
    assert "aggregate(" not in got._jdf.queryExecution().executedPlan().toString()
    for k in range(4):
        assert got.filter(F.col(f"r{k}") != dataset.random(F.col("image"), F.col("roi"), F.lit(k))).count() == 0
