import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.functions import crs
from quarryline.sources import annotations, geotiff, shapefile

WKT = 'PROJCS["Polar_Stereographic"]'


def test_shapefile_round_trip(spark, tmp_path):
    shapefile.register(spark)
    rows = [
        ([[{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 3.0}, {"x": 4.0, "y": 3.0}, {"x": 0.0, "y": 0.0}]], "1", "WV02", 6.0, None),
        ([[{"x": -1.5, "y": 2.0}, {"x": 2.5, "y": 9.0}, {"x": 4.0, "y": 3.0}, {"x": -1.5, "y": 2.0}], [{"x": 0.0, "y": 4.0}, {"x": 1.0, "y": 4.0}, {"x": 1.0, "y": 5.0}, {"x": 0.0, "y": 4.0}]], "2", None, 1.125, 7),
        (None, "3", "é", None, 8),
    ]
    schema = "geometry array<array<struct<x:double,y:double>>>, Class string, Sensor string, Area double, Number long"
    df = spark.createDataFrame(rows, schema)
    df.repartition(2).write.format("shapefile").option("wkt", WKT).mode("append").save(str(tmp_path / "out"))
    back = spark.read.format("shapefile").load(str(tmp_path / "out")).orderBy("Class").collect()
    assert [r.Class for r in back] == ["1", "2", "3"]
    assert [[[(p.x, p.y) for p in ring] for ring in r.geometry] for r in back] == [[[(p["x"], p["y"]) for p in ring] for ring in g or []] for g, *_ in rows]
    assert [(r.Sensor, r.Area, r.Number) for r in back] == [("WV02", 6.0, None), ("", 1.125, 7), ("é", None, 8)]
    assert {p.read_text() for p in (tmp_path / "out").glob("*.prj")} == {WKT}


def test_shapefiles_by_value_keep_every_row(spark, tmp_path):
    """However the rows lie; values as folders; long names are refused; overwriting replaces what was there."""
    shapefile.register(spark)
    square = [[{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 3.0}, {"x": 4.0, "y": 3.0}, {"x": 0.0, "y": 0.0}]]
    rows = [(square, f"v{k % 3}" if k % 5 else None, "x/y" if k % 2 else "z", k) for k in range(40)]
    df = spark.createDataFrame(rows, "geometry array<array<struct<x:double,y:double>>>, area string, name string, n long")
    for mode in ("overwrite", "append", "overwrite"):
        df.repartition(4).write.format("shapefile").option("by", "area,name").mode(mode).save(str(tmp_path / "out"))
    back = spark.read.format("shapefile").load(str(tmp_path / "out"))
    assert sorted(r.n for r in back.collect()) == list(range(40))
    shapefile.split_by(df, str(tmp_path / "split"), ["area", "name"], WKT)
    back = spark.read.format("shapefile").load(str(tmp_path / "split")).collect()
    assert sorted(r.n for r in back) == list(range(40)) and {r.file[len(str(tmp_path / "split")) + 1 :] for r in back} == {f"{a}/{n}.shp" for a in ("v0", "v1", "v2", "null") for n in ("x_y", "z")}
    df.write.format("shapefile").option("by", "area").mode("append").save(str(tmp_path / "split"))
    assert spark.read.format("shapefile").load(str(tmp_path / "split")).count() == 80
    for names in ("measurement_a", "measurement_b"), ("Area", "AREA"):
        wide = df.select("geometry", *[F.col("n").alias(n) for n in names])
        with pytest.raises(Exception, match="10 bytes|in more than case|AMBIGUOUS|COLUMN_ALREADY_EXISTS"):
            wide.write.format("shapefile").mode("append").save(str(tmp_path / "long"))


def test_geotiff_round_trip_and_errors(spark, tmp_path):
    rng = np.random.default_rng(0)
    image = rng.integers(0, 65535, (4, 7, 5)).astype("<u2")
    gt = [1000.0, 0.5, 0.0, 2000.0, 0.0, -0.5]
    (tmp_path / "WV02_a.v1.tif").write_bytes(geotiff.encode(image, gt, WKT))
    (tmp_path / "mask.tif").write_bytes(geotiff.encode(image[:1] % 2, gt, one_bit=True))
    (tmp_path / "bad.tif").write_bytes(b"II*\0nothing")
    rows = {r.image_name: r for r in geotiff.read(spark, str(tmp_path)).collect()}
    assert (geotiff.pixels(rows["WV02_a.v1"]) == image).all() and list(rows["WV02_a.v1"].gt) == gt and rows["WV02_a.v1"].citation == WKT
    assert (geotiff.pixels(rows["mask"])[0] == image[0] % 2).all()
    assert rows["bad"].data is None and rows["bad"].error


def test_annotations_with_objects_and_lists(spark, tmp_path):
    region = lambda n: {"shape_attributes": {"all_points_x": [0, n], "all_points_y": [1, 2]}, "region_attributes": {"object_name": f"kind{n}"}}
    data = {"a": {"filename": "a.png", "regions": {"0": region(3), "1": region(4)}}, "b": {"filename": "b.png", "regions": [region(5)]}, "c": {"filename": "c.png", "regions": {}}}
    (tmp_path / "via.json").write_text(json.dumps(data))
    rows = sorted((r.filename, r.object_name, [(p.x, p.y) for p in r.ring]) for r in annotations.read(spark, str(tmp_path / "via.json")).collect())
    assert rows == [("a.png", "kind3", [(0, 1), (3, 2)]), ("a.png", "kind4", [(0, 1), (4, 2)]), ("b.png", "kind5", [(0, 1), (5, 2)])]


def test_projection_round_trip(spark):
    df = spark.range(200).select((F.col("id") * 1.7 - 170).alias("lon"), (F.lit(55) + F.col("id") * 0.17).alias("lat"))
    x, y = crs.forward(F.col("lon"), F.col("lat"))
    back = df.withColumn("x", x).withColumn("y", y)
    lon, lat = crs.inverse(F.col("x"), F.col("y"))
    worst = back.select(F.max(F.abs(F.sin(F.radians(lon - F.col("lon"))))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-8
    # Known point: the pole is the origin; on the meridian -45 the way goes straight down.
    one = spark.range(1).select(*[c.alias(n) for c, n in zip(crs.forward(F.lit(-45.0), F.lit(70.0)), "xy")]).first()
    assert abs(one.x) < 1e-6 and abs(one.y + 2187950.6) < 2000


# The sample of a result layer's projection.
SAMPLE = 'PROJCS["unnamed",GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563,AUTHORITY["EPSG","7030"]],AUTHORITY["EPSG","6326"]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433],AUTHORITY["EPSG","4326"]],PROJECTION["Polar_Stereographic"],PARAMETER["latitude_of_origin",70],PARAMETER["central_meridian",-45],PARAMETER["scale_factor",1],PARAMETER["false_easting",0],PARAMETER["false_northing",0],UNIT["metre",1,AUTHORITY["EPSG","9001"]]]'
OTHER = 'PROJCS["WGS_1984_UTM_Zone_5N",GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",500000.0],PARAMETER["False_Northing",0.0],PARAMETER["Central_Meridian",-153.0],PARAMETER["Scale_Factor",0.9996],PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'


def test_texts_and_keys_of_systems():
    assert crs.text(crs.parse(SAMPLE)) == SAMPLE and crs.parse(SAMPLE) == crs.Crs("polar", 70.0, -45.0)
    assert crs.parse(OTHER) == crs.from_keys([1, 1, 0, 1, 3072, 0, 1, 32605], None) == crs.Crs("mercator", 0.0, -153.0, 0.9996, 500000.0)
    for own in (crs.parse(SAMPLE), crs.parse(OTHER), crs.Crs("degrees"), crs.Crs("polar", -71.0, 0.0, east=5.0)):
        assert crs.from_keys(*crs.to_keys(own)) == own == crs.parse(crs.text(own))
    assert crs.from_keys([1, 1, 0, 1, 3072, 0, 1, 3413], None) == crs.parse(SAMPLE) and crs.from_keys(None, None) is None
    for bad in ("nonsense", "PROJCS[", SAMPLE.replace("Polar_Stereographic", "Robinson"), SAMPLE.replace("6378137", "6377397"), SAMPLE.replace('"Greenwich",0', '"Paris",2.3')):
        with pytest.raises(ValueError):
            crs.parse(bad)


def test_transverse_mercator_is_what_defines_it(spark):
    """True to scale on the meridian, by the length of the arc; conformal, by its derivatives; and there and back."""
    own = crs.Crs("mercator", 0.0, -153.0, 0.9996, 500000.0)
    step = 1e-5
    rows = [(-153.0 + dlon, lat) for dlon in (-4.0, -1.0, 0.0, 2.5, 6.0) for lat in (-70.0, -10.0, 0.0, 35.0, 60.0, 71.0, 83.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    at = lambda a, b: crs.mercator(F.col("lon") + a, F.col("lat") + b, own)
    back = crs.mercator_back(*at(0, 0), own)
    names = ["x", "y", "xe", "ye", "xw", "yw", "xn", "yn", "xs", "ys", "lon2", "lat2"]
    found = df.select("lon", "lat", *[c.alias(n) for n, c in zip(names, [*at(0, 0), *at(step, 0), *at(-step, 0), *at(0, step), *at(0, -step), *back])]).collect()
    for r in found:
        assert abs(r.lon2 - r.lon) < 1e-9 and abs(r.lat2 - r.lat) < 1e-9
        phi = np.radians(r.lat)
        q = (1 - crs.E2) / ((1 - crs.E2 * np.sin(phi) ** 2) * np.cos(phi))  # isometric latitude by latitude
        ex, ey, nx, ny = r.xe - r.xw, r.ye - r.yw, (r.xn - r.xs) / q, (r.yn - r.ys) / q
        assert abs(ex - ny) < 2e-6 * abs(ny) and abs(ey + nx) < 2e-6 * abs(ny)
        if r.lon == -153.0:
            t = np.linspace(0, phi, 200_001)
            arc = np.trapezoid(crs.A * (1 - crs.E2) / (1 - crs.E2 * np.sin(t) ** 2) ** 1.5, t)
            assert abs(r.x - 500000) < 1e-6 and abs(r.y - 0.9996 * arc) < 1e-3


def test_systems_there_and_back(spark):
    lonlat = spark.createDataFrame([(-150.0, 70.5), (-153.2, 68.0), (10.0, 80.0)], "lon double, lat double")
    for own in (crs.parse(SAMPLE), crs.parse(OTHER), crs.Crs("polar", 90.0, 0.0, 0.994, 2e6, 2e6), crs.Crs("mercator", 10.0, -150.0, 1.0, 3.0, 4.0, 0.3048)):
        rows = lonlat if own.kind == "polar" else lonlat.limit(2)
        lon, lat = crs.degrees(*crs.project(F.col("lon"), F.col("lat"), own), own)
        assert max(max(abs(r[0]), abs(r[1])) for r in rows.select(F.sin(F.radians(lon - F.col("lon"))), lat - F.col("lat")).collect()) < 1e-9
    south = crs.Crs("polar", -71.0, 0.0)
    x, y = crs.project(F.lit(90.0), F.lit(-75.0), south)
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert r.x > 1.6e6 and abs(r.y) < 1e-6


def test_a_layer_in_another_system_cleans_the_same_points(spark, tmp_path):
    """Cleaning layers in three systems, one invalid, one with a hole, aligned to the raster's; results get its .prj."""
    from quarryline.operators import scenes, spatial
    from quarryline.plans import flow

    shapefile.register(spark)
    geotiff.register(spark)
    own, utm = crs.parse(SAMPLE), crs.parse(OTHER)
    corner = spark.range(1).select(*[c.alias(n) for c, n in zip(crs.project(F.lit(-152.9), F.lit(70.1), own), "xy")]).first()
    x0, y0 = round(corner.x), round(corner.y)
    square = lambda a, b, r: [(x0 + a - r, y0 + b - r), (x0 + a + r, y0 + b - r), (x0 + a + r, y0 + b + r), (x0 + a - r, y0 + b + r)]
    shapes = {"polar": [square(50, 50, 30), square(50, 50, 10)[::-1]], "utm": [square(200, 60, 25)], "degrees": [[(x0 + 300, y0), (x0 + 360, y0 + 60), (x0 + 360, y0), (x0 + 300, y0 + 60)]]}
    for name, text in (("polar", SAMPLE), ("utm", OTHER), ("degrees", crs.text(crs.Crs("degrees")))):
        rings = [[{"x": float(x), "y": float(y)} for x, y in r] for r in shapes[name]]
        df = crs.aligned(spark.createDataFrame([(rings, SAMPLE, name)], "geometry array<array<struct<x:double,y:double>>>, prj string, name string"), text, "geometry")
        df.drop("prj").coalesce(1).write.format("shapefile").option("wkt", text).mode("append").save(str(tmp_path / "clean"))
    layers = spark.read.format("shapefile").load(str(tmp_path / "clean"))
    assert {r.prj for r in layers.collect()} == {SAMPLE, OTHER, crs.text(crs.Crs("degrees"))}
    points = spark.createDataFrame([(k, float(x0 + a), float(y0 + b)) for k, (a, b) in enumerate([(25, 50), (50, 50), (85, 50), (200, 60), (222, 83), (230, 60), (305, 30), (330, 5), (355, 30), (0, 0)])], "id long, x double, y double")
    clean = flow.cleaning(layers, SAMPLE)
    left = {r.id for r in spatial.outside_polygons(points, clean).collect()}
    assert left == {1, 2, 5, 7, 9}
    image = np.full((4, 60, 60), 10, "<u2")
    image[:, 20:40, 20:40] = 220
    (tmp_path / "scenes").mkdir()
    (tmp_path / "scenes" / "a.tif").write_bytes(geotiff.encode(image, [float(x0), 1.0, 0.0, float(y0), 0.0, -1.0], prj=SAMPLE))
    from quarryline.operators import inference

    windows = spark.read.format("geotiff_windows").option("window", 160).option("after", 40).load(str(tmp_path / "scenes"))
    assert windows.first().prj == SAMPLE
    out = flow.run(windows, inference.ThresholdDetector, clean, water=False)
    path = flow.save(out, str(tmp_path), "run", found=windows)
    assert (tmp_path / "run" / "a.prj").read_text() == SAMPLE and spark.read.format("shapefile").load(path).count() == 1
    masks = scenes.masks(spark.read.format("geotiff_windows").option("before", 13).option("after", 13).load(str(tmp_path / "scenes")))
    geotiff.save_masks(masks, str(tmp_path / "masks"))
    assert geotiff.read(spark, str(tmp_path / "masks")).first().prj == SAMPLE
