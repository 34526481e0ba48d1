"""Footprints by area, country, grid cell and name, and what detectors lose."""

from pyspark.sql import functions as F

from quarryline.operators import inference
from quarryline.plans import footprints
from quarryline.sources import shapefile

WKT = 'PROJCS["x",UNIT["metre",1]]'


def square(x, y, n=10.0):
    return [[(x, y), (x, y + n), (x + n, y + n), (x + n, y)]]


def put(spark, path, rows, wkt=None):
    """One file of (Name, geometry)."""
    df = spark.createDataFrame([(n, [[{"x": float(x), "y": float(y)} for x, y in r] for r in g]) for n, g in rows], "Name string, geometry array<array<struct<x:double,y:double>>>").coalesce(1)
    folder, name = path.rsplit("/", 1)
    shapefile.register(spark)
    out = df.withColumn("own", F.lit(name)).write.format("shapefile").mode("append").option("by", "own")
    (out.option("wkt", wkt) if wkt else out).save(folder)


def area_of(ring):
    return abs(sum(p.x * q.y - q.x * p.y for p, q in zip(ring, [*ring[1:], ring[0]]))) / 2


def test_layers_of_footprints(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, f"{root}/high/canada/footprint_g12", [("s1", square(0, 0)), ("s1", square(10, 0)), ("s2", square(50, 0)), (None, square(90, 0))], WKT)
    put(spark, f"{root}/high/alaska/footprint_g12", [("s1", square(5, 5))])
    put(spark, f"{root}/low/footprint_g3", [("s1", square(0, 0)), ("s1", square(5, 0))])
    layers = footprints.read(spark, root)
    assert sorted((r.area, r.country or "", r.grid, r.scene, len(r.geometry), round(sum(map(area_of, r.geometry)), 6), r.prj) for r in layers.collect()) == [
        ("high", "alaska", "g12_iwp", "s1_u16rf3413_pansh", 1, 100.0, None),
        ("high", "canada", "g12_iwp", "s1_u16rf3413_pansh", 1, 200.0, WKT),
        ("high", "canada", "g12_iwp", "s2_u16rf3413_pansh", 1, 100.0, WKT),
        ("low", "", "g3_iwp", "s1_u16rf3413_pansh", 1, 150.0, None),
    ]
    for _ in range(2):  # writing again leaves the same files
        footprints.save(layers, out)
        assert [f[len(out) + 1 :] for f in shapefile.files(out)] == [
            "high/alaska/g12_iwp/s1_u16rf3413_pansh/s1_u16rf3413_pansh.shp",
            "high/canada/g12_iwp/s1_u16rf3413_pansh/s1_u16rf3413_pansh.shp",
            "high/canada/g12_iwp/s2_u16rf3413_pansh/s2_u16rf3413_pansh.shp",
            "low/g3_iwp/s1_u16rf3413_pansh/s1_u16rf3413_pansh.shp",
        ]
    back = spark.read.format("shapefile").load(out).select("scene", F.col("geometry")[0].alias("ring"), "prj").collect()
    assert sorted(round(area_of(r.ring[:-1] if r.ring[0] == r.ring[-1] else r.ring), 6) for r in back) == [100, 100, 150, 200]
    assert sorted(r.prj or "" for r in back) == ["", "", WKT, WKT]


def test_places_of_odd_paths(spark):
    df = spark.createDataFrame([("/r/x/high/canada/footprint_g1.v2.shp",), ("/r/x/low/canada/footprint_g2.shp",), ("/r/x/high/ab.shp",), ("/r/x/footprint_g4.shp",), (None,)], "file string")
    rows = [tuple(r) for r in df.select(*footprints.places(F.col("file"), "/r/x/")).collect()]
    assert rows == [("high", "canada", "g1_iwp"), ("low", None, "g2_iwp"), ("high", None, "_iwp"), (None, None, "g4_iwp"), (None, None, None)]


def test_what_detectors_lose_is_counted(spark):
    rows = [("a", "bad", None), ("a", None, None), ("a", None, [(1.0, 2.0)]), ("b", None, [(1.0, 2.0)]), ("c", None, None), ("c", None, None)]
    found = spark.createDataFrame(rows, "image_name string, error string, ring array<struct<x:double,y:double>>")
    assert sorted(map(tuple, inference.lost(found).collect())) == [("a", 1, 1), ("c", 0, 2)]
    assert not inference.lost(found.limit(0)).count()
