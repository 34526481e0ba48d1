"""The whole way from scenes to a cleaned layer: tiles, detections, one detection for each object, measures, cleaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs
from ..operators import inference, overlay, scenes, spatial
from ..operators.dataflow import CROP, OVERLAP
from ..session import ship
from ..sources import shapefile

# Where a scene's name has the sensor, date, time and catalogue number (from 1, length).
NAME = (("Sensor", 1, 4), ("Date", 6, 8), ("Time", 14, 6), ("CatalogID", 21, 16))
# The numbers of a result layer, of 3 decimals.
NUMBERS = (("Area", "area"), ("CentroidX", "centroid_x"), ("CentroidY", "centroid_y"), ("Perimeter", "perimeter"), ("Length", "length"), ("Width", "width"))


def run_id(at: Column) -> Column:
    return F.date_format(at, "yyyyMMddHHmmss")


def attributes(measured: DataFrame) -> DataFrame:
    """measured (image_name, class_id and measures) with the columns of a result layer in the place of its measures."""
    named = [F.substring("image_name", a, n).alias(c) for c, a, n in NAME]
    numbers = [(F.round(F.col(c), 3) + F.lit(0.0)).alias(n) for n, c in NUMBERS if c in measured.columns]
    others = [c for c in measured.columns if c not in {c for _, c in NUMBERS}]
    return measured.select(*others, F.col("class_id").cast("string").alias("Class"), *named, *numbers)


def detections(tiles: DataFrame, make: Callable[[], object]) -> DataFrame:
    """Detections of tiles (operators.scenes.TILE), with their tile's place."""
    named = tiles.select(
        "image_name", "tile_num", F.lit(3).alias("bands"), F.col("h").alias("height"), F.col("w").alias("width"), F.lit("|u1").alias("dtype"),
        "data", "ul_row", "ul_col", "yres", "xres", "id_i", "id_j",
    )
    return inference.infer(named, make, pixel_offset=1.0, channels_last=True, keep=("id_i", "id_j"))


def layer(found: DataFrame) -> DataFrame:
    """One row for each object: of detections whose centroids are close, from neighbouring tiles, the first stays."""
    measured = found.filter("ring is not null").select("*", *spatial.measures(F.col("ring")))
    keyed = measured.filter("centroid_x is not null").select(
        F.col("image_name").alias("image"), (F.col("tile_num").cast("long") * (1 << 20) + F.col("detection")).alias("idx"), F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"),
        "image_name", "id_i", "id_j", "class_id", "score", "ring", "area", "perimeter", "centroid_x", "centroid_y",
    )
    # The detector runs once: pairs and what stays are both made from its written output.
    kept = spatial.deduplicate(spatial.checkpointed(keyed)).withColumn("sides", inference.rectangle(F.col("ring")))
    return attributes(kept.select("*", "sides.length", "sides.width").drop("sides"))


def cleaning(layers: DataFrame, target: str | None = None) -> DataFrame:
    """The polygons of cleaning layers (rows of the shapefile source) as `run` takes them: in the scenes' system, and each
    feature repaired, holes and all."""
    rows = layers if target is None else crs.aligned(layers, target, "geometry")
    rings = rows.select("file", "_fid", F.explode("geometry").alias("ring"))
    return overlay.boundaries(rings, ["file", "_fid"]).groupBy("file", "_fid").agg(F.collect_list("ring").alias("geometry"))


def projections(found: DataFrame) -> DataFrame:
    """image_name and prj of each scene of windows or whole scenes."""
    return found.filter("prj is not null").groupBy("image_name").agg(F.min("prj").alias("prj"))


def run(found: DataFrame, make: Callable[[], object], clean: DataFrame | None = None, crop: int = CROP, overlap: float = OVERLAP, water: bool = True) -> DataFrame:
    """The cleaned result layer of scenes (rows of sources.geotiff.read, or its windows); clean has the polygons of false
    positives, as `cleaning` gives them or one ring each."""
    ship(found.sparkSession)
    out = layer(detections(scenes.tiles(found, crop, overlap, water), make))
    return out if clean is None else spatial.outside_polygons(out, clean)


def save(rows: DataFrame, root: str, run: str, wkt: str | None = None, found: DataFrame | None = None) -> str:
    """One shapefile for each scene in a folder of the run, with the text wkt or else the system of its own scene in `found`
    as its .prj."""
    path = f"{root}/{run}"
    fields = ["Class", *[c for c, _, _ in NAME], *[n for n, _ in NUMBERS]]
    named = rows.select(F.array("ring").alias("geometry"), "image_name", *fields)
    if wkt is None and found is not None:
        named = scenes.beside(named, projections(found), ["image_name"], "left")
    shapefile.split_by(named, path, ["image_name"], wkt)
    return path
