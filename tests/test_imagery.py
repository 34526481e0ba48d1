import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.functions import geometry, images
from quarryline.operators import compare, detection, inference, raster, scenes, spatial
from quarryline.plans import flow
from quarryline.sources import geotiff, shapefile

SCENE = "image_name string, dtype string, bands int, height int, width int, gt array<double>, data binary"


def plain_land(scene):
    """The land mask by loops over pixels."""
    nir = np.clip(np.rint(scene[3].astype(float)), 0, 255)
    h, w = nir.shape
    smooth = np.zeros((h, w))
    for y in range(h):
        for x in range(w):
            near = sorted(nir[b, a] for b in range(h) for a in range(w) if (b - y) ** 2 + (a - x) ** 2 <= 25)
            smooth[y, x] = near[len(near) // 2] / 255
    g = [np.exp(-0.5 * (o / 2.0) ** 2) for o in range(-8, 9)]
    blur = lambda line: [sum(g[o + 8] * line[min(max(i + o, 0), len(line) - 1)] for o in range(-8, 9)) / sum(g) for i in range(len(line))]
    smooth = np.asarray([blur(list(c)) for c in smooth.T]).T
    smooth = np.asarray([blur(list(r)) for r in smooth])
    lo, hi = smooth.min(), smooth.max()
    if lo == hi:
        return smooth > 0
    n, edges = np.histogram(smooth, 256, (lo, hi))
    centre = (edges[1:] + edges[:-1]) / 2
    best, at = -1.0, 0
    for k in range(255):
        a, b = n[: k + 1].sum(), n[k + 1 :].sum()
        if a and b:
            v = a * b * ((n[: k + 1] * centre[: k + 1]).sum() / a - (n[k + 1 :] * centre[k + 1 :]).sum() / b) ** 2
            if v > best * (1 + 1e-12):
                best, at = v, k
    return smooth > centre[at]


def scene_row(name, image, gt=None):
    return name, image.dtype.str, *image.shape, gt, bytearray(image.tobytes())


def whole_masks(rows, shapes):
    out = {name: np.zeros(shape, bool) for name, shape in shapes.items()}
    for r in rows:
        bits = np.unpackbits(np.frombuffer(r.mask, np.uint8).reshape(r.h, -1), axis=1)[:, : r.w]
        out[r.image_name][r.y : r.y + r.h, r.x : r.x + r.w] = bits
    return out


def test_land_masks_against_loops(spark):
    """Bit for bit, whatever the windows are."""
    rng = np.random.default_rng(4)
    images_ = {str(k): np.kron(rng.integers(0, 400, (4, 3, 4)), np.ones((1, 5, 4))).astype("<u2") for k in range(4)} | {"flat": np.full((4, 6, 5), 9, "<u2"), "wide": rng.integers(0, 300, (4, 30, 37)).astype("<u2")}
    rows = [scene_row(name, im) for name, im in images_.items()]
    df = spark.createDataFrame([*rows, ("none", None, None, None, None, None, None)], SCENE)
    for side in (100, 7):
        windows = scenes.windows_of(df, side, before=scenes.MARGIN, after=scenes.MARGIN)
        got = whole_masks(scenes.masks(windows).collect(), {n: im.shape[1:] for n, im in images_.items()})
        for name, im in images_.items():
            assert (got[name] == plain_land(im)).all() and (got[name] == scenes.land(im)).all(), (name, side)


def test_median_against_sorting():
    rng = np.random.default_rng(2)
    for h, w, radius in ((1, 1, 5), (3, 9, 2), (30, 14, 5), (1, 20, 3), (20, 1, 7), (9, 9, 0)):
        im = rng.integers(0, 256, (h, w)).astype(np.uint8)
        got = raster.disk_median(im, radius)
        for y in range(h):
            for x in range(w):
                near = sorted(im[b, a] for b in range(h) for a in range(w) if (b - y) ** 2 + (a - x) ** 2 <= radius**2)
                assert got[y, x] == near[len(near) // 2]


def tiff(image, side=None, strip=None, pack=1, apart=False, predict=False, big=False):
    """A file in tiles or strips, for the tests."""
    bands, h, w = image.shape
    th, tw = (side, side) if side else (strip or h, w)
    planes = [image[k : k + 1] for k in range(bands)] if apart else [image]
    parts = []
    for plane in planes:
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = plane[:, y : y + th, x : x + tw]
                if side:
                    part = np.pad(part, [(0, 0), (0, th - part.shape[1]), (0, tw - part.shape[2])])
                part = part.transpose(1, 2, 0)
                part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1).astype(image.dtype) if predict else part
                data = np.ascontiguousarray(part).tobytes()
                parts.append(data if pack == 1 else lzw(data) if pack == 5 else zlib.compress(data))
    at, offsets = 16, []
    for p in parts:
        offsets.append(at)
        at += len(p)
    where = [(322, 4, [tw]), (323, 4, [th]), (324, 16 if big else 4, offsets), (325, 4, [len(p) for p in parts])] if side else [(273, 16 if big else 4, offsets), (278, 4, [th]), (279, 4, [len(p) for p in parts])]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [16] * bands), (259, 3, [pack]), (277, 3, [bands]), (284, 3, [2 if apart else 1]), (317, 3, [2 if predict else 1]), (339, 3, [1] * bands), (33550, 12, [0.5, 0.5, 0.0]), (33922, 12, [0.0, 0.0, 0.0, 1000.0, 2000.0, 0.0]), *where]
    codes, sizes = {3: "H", 4: "I", 12: "d", 16: "Q"}, {3: 2, 4: 4, 12: 8, 16: 8}
    wide, inline, word = (20, 8, "Q") if big else (12, 4, "I")
    far = at + (8 if big else 2) + wide * len(tags) + (8 if big else 4)
    body, extra = struct.pack("<Q" if big else "<H", len(tags)), b""
    for tag, kind, values in sorted(tags):
        data = struct.pack(f"<{len(values)}{codes[kind]}", *values)
        body += struct.pack("<HH" + word, tag, kind, len(values))
        body += data.ljust(inline, b"\0") if len(data) <= inline else struct.pack("<" + word, far + len(extra))
        extra += b"" if len(data) <= inline else data
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI8x", b"II", 42, at)
    return head + b"".join(parts) + body + bytes(8 if big else 4) + extra


def test_windows_of_files(spark, tmp_path, monkeypatch):
    """Every layout, by byte ranges, with margins; unreadable files are rows with their errors."""
    geotiff.register(spark)
    rng = np.random.default_rng(8)
    image = rng.integers(0, 5000, (4, 130, 150)).astype("<u2")
    kinds = {
        "plain": {}, "strips": {"strip": 13, "pack": 8}, "tiles": {"side": 48, "pack": 8}, "lzw": {"side": 32, "pack": 5}, "apart": {"side": 64, "apart": True, "pack": 8},
        "predicted": {"side": 64, "pack": 8, "predict": True}, "big": {"side": 48, "big": True}, "one": {"pack": 8},
    }
    for name, kind in kinds.items():
        (tmp_path / f"{name}.tif").write_bytes(tiff(image, **kind))
    (tmp_path / "bad.tif").write_bytes(b"II*\0nothing")
    whole = tiff(image, side=48, pack=8)
    (tmp_path / "torn.tif").write_bytes(whole[:16] + bytes(3000) + whole[3016:])
    load = spark.read.format("geotiff_windows").option("window", 50).option("step", 10).option("before", 3).option("after", 7).load
    rows = load(str(tmp_path)).collect()
    errors = {r.image_name for r in rows if r.error}
    assert errors == {"bad", "torn"}
    for name in kinds:
        seen = np.zeros(image.shape[1:], int)
        for r in (r for r in rows if r.image_name == name):
            part = np.frombuffer(r.data, r.dtype).reshape(r.bands, r.rows, r.cols)
            assert (part == image[:, r.y - r.top : r.y + r.h + 7, r.x - r.left : r.x + r.w + 7]).all() and list(r.gt) == [1000, 0.5, 0, 2000, 0, -0.5]
            assert (r.top, r.left) == (min(3, r.y), min(3, r.x)) and r.rows <= 60 or kinds[name].get("side") is None
            seen[r.y : r.y + r.h, r.x : r.x + r.w] += 1
        assert (seen == 1).all()
    only = spark.read.format("geotiff_windows").option("window", 50).option("step", 10).option("bands", "3").load(str(tmp_path / "apart.tif")).collect()
    assert all((np.frombuffer(r.data, r.dtype).reshape(r.rows, r.cols) == image[3, r.y : r.y + r.h, r.x : r.x + r.w]).all() for r in only) and len(only) == 9
    # A deflated strip that is too large to unpack at once.
    monkeypatch.setattr(geotiff, "AT_ONCE", 1000)
    assert (geotiff.decode(tiff(image, pack=8), (100, 20, 120, 90))[0] == image[:, 100:120, 20:90]).all()
    asked = []
    raw = tiff(image, side=48, pack=8)
    geotiff.Raster(lambda at, n: (asked.append(n), raw[at : at + n])[1]).window(0, 0, 10, 10)
    assert sum(asked) < len(raw) / 6


def test_tiles_and_masks_of_windows_are_those_of_scenes(spark, tmp_path):
    geotiff.register(spark)
    rng = np.random.default_rng(6)
    image = np.kron(rng.integers(0, 400, (4, 20, 25)), np.ones((1, 17, 16))).astype("<u2")
    image[2, :200, :200] = 0
    (tmp_path / "a.tif").write_bytes(tiff(image, side=64, pack=8))
    (tmp_path / "b.tif").write_bytes(tiff(image[:, ::-1].copy(), strip=9, pack=8))
    found = geotiff.read(spark, str(tmp_path))
    windows = spark.read.format("geotiff_windows").option("window", 160).option("before", scenes.MARGIN).option("after", scenes.MARGIN + 40).load(str(tmp_path))
    for water in (False, True):
        one, two = scenes.tiles(found, water=water), scenes.tiles(windows, water=water)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() > 8
    masks = scenes.masks(windows)
    geotiff.save_masks(masks, str(tmp_path / "masks"), "PROJ")
    back = {r.image_name: r for r in geotiff.read(spark, str(tmp_path / "masks")).collect()}
    for name, own in (("a", image), ("b", image[:, ::-1])):
        assert (geotiff.pixels(back[name])[0].astype(bool) == scenes.land(own)).all() and back[name].citation == "PROJ" and list(back[name].gt) == [1000, 0.5, 0, 2000, 0, -0.5]
    assert (tmp_path / "masks" / "a.tif").stat().st_size < image[0].size / 8
    with pytest.raises(Exception, match="missing"):
        geotiff.save_masks(masks.filter("y > 0"), str(tmp_path / "part"))
    with pytest.raises(Exception, match="does not start on a tile"):
        geotiff.save_masks(masks, str(tmp_path / "part"), tile=256)


def test_tiles_of_a_scene(spark):
    rng = np.random.default_rng(1)
    image = rng.integers(1, 900, (4, 250, 330)).astype("<u2")
    image[2, :200, :200] = 0  # the first tile is black
    t = scenes.tiles(spark.createDataFrame([scene_row("a", image, [1000.0, 0.5, 0.0, 2000.0, 0.0, -0.5])], SCENE), water=False).orderBy("tile_num").collect()
    assert [(r.tile_num, r.id_i, r.id_j, r.h, r.w) for r in t] == [(0, 0, 1, 200, 170), (1, 0, 2, 200, 10), (2, 1, 0, 90, 200), (3, 1, 1, 90, 170), (4, 1, 2, 90, 10)]
    assert (t[3].ul_row, t[3].ul_col) == (2000 - 160 * 0.5, 1000 + 160 * 0.5)
    part = image[[3, 1, 2], 160:250, 160:330].astype(float)
    part = np.rint((part - part.min()) * 255 / (part.max() - part.min())).astype(int)
    for b in range(3):
        n = np.bincount(part[b].ravel(), minlength=256)
        first = n[np.flatnonzero(n)[0]]
        want = np.rint((np.cumsum(n) - first) * 255 / (part[b].size - first))[part[b]]
        assert (scenes.pixels_of_tile(t[3].data, 90, 170)[:, :, b] == want).all()


def test_from_scene_to_cleaned_layer(spark, tmp_path):
    image = np.full((4, 250, 330), 10, "<u2")
    image[:, 30:50, 40:60] = 220
    image[:, 170:190, 165:190] = 220  # in four tiles: one object
    image[:, 100:112, 300:312] = 220
    row = scene_row("WV02_20200101120000_0123456789ABCDEF_rest", image, [1000.0, 1.0, 0.0, 2000.0, 0.0, -1.0])
    found = spark.createDataFrame([row], SCENE)
    out = flow.run(found, inference.ThresholdDetector, water=False)
    kept = {(round(r.CentroidX), round(r.CentroidY)): r for r in out.collect()}
    assert set(kept) == {(1050, 1960), (1177, 1820), (1306, 1894)}
    r = kept[1177, 1820]
    assert (r.Sensor, r.Date, r.Time, r.CatalogID) == ("WV02", "20200101", "120000", "0123456789ABCDEF") and abs(r.Length - 25) <= 1 and abs(r.Width - 20) <= 1
    ring = [{"x": x, "y": y} for x, y in ((1290.0, 1880.0), (1290.0, 1910.0), (1320.0, 1910.0), (1320.0, 1880.0))]
    clean = spark.createDataFrame([(ring,)], "ring array<struct<x:double,y:double>>")
    left = flow.run(found, inference.ThresholdDetector, clean, water=False)
    assert {(round(r.CentroidX), round(r.CentroidY)) for r in left.collect()} == set(kept) - {(1306, 1894)}
    shapefile.register(spark)
    path = flow.save(out, str(tmp_path), "20200101000000", "WKT")
    assert sorted(p.name for p in (tmp_path / "20200101000000").glob("*.*") if not p.name.startswith(".")) == sorted(f"{row[0]}.{k}" for k in ("shp", "shx", "dbf", "prj"))
    back = spark.read.format("shapefile").load(path)
    fields = ["Class", "Sensor", "Area", "CentroidX", "Length"]
    assert compare.same(back.select(*fields), out.select(*fields))


def test_shapefile_loses_nothing(spark, tmp_path):
    shapefile.register(spark)
    square = [[{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 3.0}, {"x": 4.0, "y": 3.0}, {"x": 0.0, "y": 0.0}]]
    schema = "geometry array<array<struct<x:double,y:double>>>, name string, n int, v double"
    rows = [(square, "é" * 100, 7, 12345678901234567.5), (square, None, None, None)]
    root = str(tmp_path / "out")
    for _ in range(2):
        spark.createDataFrame(rows, schema).coalesce(1).write.format("shapefile").mode("overwrite").save(root)
    back = spark.read.format("shapefile").load(root)
    assert [(r.name, r.n, r.v, r._fid) for r in back.orderBy("_fid").collect()] == [("é" * 100, 7, 12345678901234567.5, 0), ("", None, None, 1)]
    assert dict(back.dtypes)["n"] == "bigint"
    # A file with other columns is read by name; a deleted record is left out.
    spark.createDataFrame([(square, 3, "b"), (square, 4, "c")], "geometry array<array<struct<x:double,y:double>>>, n int, other string").coalesce(1).write.format("shapefile").mode("append").save(root)
    newest = [p for p in (tmp_path / "out").glob("*.dbf") if b"other" in p.read_bytes()][0]
    raw = bytearray(newest.read_bytes())
    raw[struct.unpack("<H", raw[8:10])[0]] = ord("*")
    newest.write_bytes(raw)
    assert sorted(((r.n, r.name, r.other) for r in spark.read.format("shapefile").load(root).collect()), key=str) == sorted([(7, "é" * 100, None), (None, "", None), (4, None, "c")], key=str)
    with pytest.raises(Exception, match="254"):
        spark.createDataFrame([(square, "x" * 300, 1, 1.0)], schema).write.format("shapefile").mode("append").save(root)


def lzw(data):
    """Compression to codes, for the test."""
    table, out, bits, have, width = {bytes([k]): k for k in range(256)}, bytearray(), 0, 0, 9

    def put(code):
        nonlocal bits, have
        bits, have = bits << width | code, have + width
        while have >= 8:
            out.append(bits >> (have - 8) & 255)
            have -= 8
            bits &= (1 << have) - 1

    put(256)
    word, n = b"", 258
    for k in data:
        more = word + bytes([k])
        if more in table:
            word = more
            continue
        put(table[word])
        table[more], n, word = n, n + 1, bytes([k])
        if n == 4095:
            put(256)
            table, n, width = {bytes([k]): k for k in range(256)}, 258, 9
        else:
            width = 9 + (n >= 512) + (n >= 1024) + (n >= 2048)
    put(table[word])
    put(257)
    put(0)
    return bytes(out)


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("pack", [1, 5, 8])
@pytest.mark.parametrize("predictor", [1, 2])
def test_tiled_and_compressed_files(big, pack, predictor):
    rng = np.random.default_rng(pack)
    image = (rng.integers(0, 40, (3, 50, 70)).cumsum(axis=2)).astype("<u2")
    th, tw, blocks = 16, 32, []
    for y in range(0, 50, th):
        for x in range(0, 70, tw):
            block = np.zeros((th, tw, 3), "<u2")
            part = image[:, y : y + th, x : x + tw].transpose(1, 2, 0)
            block[: part.shape[0], : part.shape[1]] = part
            if predictor == 2:
                block[:, 1:] = block[:, 1:] - block[:, :-1]
            raw = block.tobytes()
            blocks.append(zlib.compress(raw) if pack == 8 else lzw(raw) if pack == 5 else raw)
    at, offsets, body = 16, [], b""
    for b in blocks:
        offsets.append(at + len(body))
        body += b
    tags = [(256, 3, [70]), (257, 3, [50]), (258, 3, [16] * 3), (259, 3, [pack]), (277, 3, [3]), (284, 3, [1]), (317, 3, [predictor]), (322, 3, [tw]), (323, 3, [th]), (324, 4, offsets), (325, 4, [len(b) for b in blocks]), (339, 3, [1] * 3), (34264, 12, [2.0, 0, 0, 10.0, 0, -2.0, 0, 20.0, 0, 0, 0, 0, 0, 0, 0, 1.0])]
    code = {3: "H", 4: "I", 12: "d"}
    start = 16 + len(body)
    entry, inline = (20, 8) if big else (12, 4)
    far = start + (8 if big else 2) + entry * len(tags) + (8 if big else 4)
    table, extra = struct.pack("<Q" if big else "<H", len(tags)), b""
    for tag, kind, values in tags:
        packed = struct.pack(f"<{len(values)}{code[kind]}", *values)
        table += struct.pack("<HHQ" if big else "<HHI", tag, kind, len(values))
        if len(packed) <= inline:
            table += packed.ljust(inline, b"\0")
        else:
            table += struct.pack("<Q" if big else "<I", far + len(extra))
            extra += packed
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, start) if big else struct.pack("<2sHI8x", b"II", 42, start)
    raw = head + body + table + struct.pack("<Q" if big else "<I", 0) + extra
    out, gt, _ = geotiff.decode(raw)
    assert (out == image).all() and gt == [10.0, 2.0, 0, 20.0, 0, -2.0]
    assert (geotiff.decode(raw, (10, 30, 41, 66))[0] == image[:, 10:41, 30:66]).all()


def test_masks_match_where_boxes_do_not(spark):
    """Two crossed bars fill one box between them but share few pixels."""
    bar = lambda image, box, who, pixels: [(image, box, 1, r, c) for r, c in pixels]
    flat = [(r, c) for r in (4, 5) for c in range(10)]
    tall = [(r, c) for r in range(10) for c in (4, 5)]
    pred = spark.createDataFrame(bar(1, 1, 0, flat) + bar(2, 1, 0, flat), "image long, box int, class_id int, r int, c int")
    gt = spark.createDataFrame(bar(1, 1, 0, tall) + bar(2, 1, 0, flat), "image long, gt int, class_id int, r int, c int")
    pairs = detection.mask_overlaps(pred, gt)
    assert {(r.image, round(r.iou, 4)) for r in pairs.collect()} == {(1, round(4 / 36, 4)), (2, 1.0)}
    scored = pred.select("image", "box").distinct().withColumn("score", F.lit(0.9))
    n = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "image long, n_gt long")
    ap = detection.average_precision(detection.match(scored, pairs), n, ["image"])
    assert {(r.image, r.ap) for r in ap.collect()} == {(1, 0.0), (2, 1.0), (3, 0.0)}


def test_large_and_small_polygons_meet(spark):
    """A polygon of 20,000 units takes as few cells as one of 3."""
    def square(x, y, r):
        return [{"x": x + a * r, "y": y + b * r} for a, b in ((-1.0, -1.0), (-1.0, 1.0), (1.0, 1.0), (1.0, -1.0))]
    polygons = spark.createDataFrame([(square(0.0, 0.0, 10_000.0),), (square(20_000.0, 0.0, 1.5),)], "ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 9_999.0, 5.0), (2, 10_001.0, 5.0), (3, 20_001.0, 1.0), (4, 20_002.0, 1.0), (5, 10_000.0, 0.0)], "id int, x double, y double")
    assert {r.id for r in spatial.outside_polygons(points, polygons).collect()} == {2, 4}
    shapes = spark.createDataFrame([(1, square(10_001.0, 0.0, 2.0)), (2, square(10_010.0, 0.0, 2.0)), (3, square(20_000.0, 0.0, 0.1)), (4, square(0.0, 0.0, 50_000.0))], "id int, ring array<struct<x:double,y:double>>")
    assert {r.id for r in spatial.clear_of_polygons(shapes, polygons, ["id"]).collect()} == {2}


def test_rings_as_text(spark):
    at = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    df = spark.createDataFrame([(1, at((0, 0), (0, 2), (2, 2))), (2, at((0, 0), (2, 2), (2, 0), (0, 2))), (3, [])], "id int, ring array<struct<x:double,y:double>>")
    got = {r.id: (r.t, r.s) for r in df.select("id", geometry.wkt(F.col("ring")).alias("t"), geometry.is_simple(F.col("ring")).alias("s")).collect()}
    assert got == {1: ("POLYGON ((0.0 0.0, 0.0 2.0, 2.0 2.0, 0.0 0.0))", True), 2: ("POLYGON ((0.0 0.0, 2.0 2.0, 2.0 0.0, 0.0 2.0, 0.0 0.0))", False), 3: ("POLYGON EMPTY", False)}


def test_image_sizes():
    image = np.arange(60 * 20 * 3).reshape(60, 20, 3) % 256
    out, window, scale = images.fit_square(image.astype(np.uint8), 64, 128)
    assert out.shape == (128, 128, 3) and window == (0, 42, 128, 85) and abs(scale - 128 / 60) < 1e-12
    out, window, scale = images.fit_multiple(image.astype(np.uint8))
    assert out.shape == (64, 64, 3) and window == (2, 22, 62, 42) and scale == 1 and (out[2:62, 22:42] == image).all()
    ramp = np.tile(np.arange(10.0), (4, 1))
    assert np.allclose(images.resize(ramp, 4, 10), ramp) and np.allclose(images.resize(ramp, 8, 20)[2:-2, 2:-2], np.tile((np.arange(20) + 0.5) / 2 - 0.5, (8, 1))[2:-2, 2:-2])
    assert np.allclose(images.from_network(images.network_input(image)), image, atol=1)
    assert raster.disk_median(np.asarray([[1.0, 2.0], [3.0, 4.0]]), 5).tolist() == [[3, 3], [3, 3]]


def test_cleaning_rewrites_a_layer_in_place(spark, tmp_path):
    """Rows go from a shapefile and it is written again where it was."""
    shapefile.register(spark)
    square = lambda x: [[{"x": x, "y": 0.0}, {"x": x, "y": 1.0}, {"x": x + 1, "y": 1.0}, {"x": x, "y": 0.0}]]
    root = str(tmp_path / "grid_iwp")
    spark.createDataFrame([(square(float(k)), k) for k in range(5)], "geometry array<array<struct<x:double,y:double>>>, n int").coalesce(1).write.format("shapefile").mode("append").save(root)
    layer = spark.read.format("shapefile").load(root)
    layer.filter("n <> 2").write.format("shapefile").mode("overwrite").save(root)
    assert sorted(r.n for r in spark.read.format("shapefile").load(root).collect()) == [0, 1, 3, 4]
    assert len(shapefile.files(str(tmp_path), "_iwp")) == 1 and not shapefile.files(str(tmp_path), "_other")


def test_errors_have_a_budget(spark):
    found = spark.createDataFrame([(1, None), (2, "bad"), (3, "worse")], "tile_num int, error string")
    assert inference.check_errors(found, 2).count() == 1
    with pytest.raises(RuntimeError, match="2 tiles failed"):
        inference.check_errors(found, 1)


def test_masks_of_one_box_as_bands():
    rng = np.random.default_rng(2)
    masks = rng.random((13, 22, 40)) < 0.5
    small = images.small_mask(masks, (0, 0, 13, 22), 28, 28)
    back = images.full_mask(small, (2, 3, 15, 25), 20, 30)
    for k in range(40):
        own = images.small_mask(masks[:, :, k], (0, 0, 13, 22), 28, 28)
        assert (small[:, :, k] == own).all() and (back[:, :, k] == images.full_mask(own, (2, 3, 15, 25), 20, 30)).all()


def test_small_rows_are_dealt_over_partitions(spark):
    from quarryline.session import spread

    assert spread(spark.range(1000).coalesce(1)).rdd.getNumPartitions() == 4


def test_pixels_of_a_ring_that_repeats():
    images.pixels_of.cache_clear()
    ring = np.asarray([(0, 2), (2, 4), (4, 2), (2, 0)], float)
    assert [images.pixels_of(ring.tobytes()) for _ in range(3)] == [13] * 3 and images.pixels_of.cache_info().misses == 1
