"""Footprints of scenes: the shapefiles below a folder, of a grid cell each, become one dissolved layer for each scene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import overlay, spatial
from ..sources import shapefile

# The area without folders of countries, where a file's name has its grid cell, and the ends of names.
FLAT, GRID_AT, GRID_END, NAME_END = "low", 11, "_iwp", "_u16rf3413_pansh"


def places(file: Column, root: str) -> list[Column]:
    """area, country (null in the flat area), grid of a file by its path below root: area/country/file or area/file. A file
    that is not so deep has no area or no country."""
    below = F.split(F.substr(file, F.lit(len(root.rstrip("/")) + 2)), "/")
    depth = F.size(below)
    area = F.when(depth > 1, below[0])
    stem = F.substring_index(F.element_at(below, -1), ".", 1)
    country = F.when((depth > 2) & (area != FLAT), below[1])
    return [area.alias("area"), country.alias("country"), F.concat(F.substr(stem, F.lit(GRID_AT)), F.lit(GRID_END)).alias("grid")]


def read(spark: SparkSession, root: str) -> DataFrame:
    """area, country, grid, scene, geometry, prj: of each file below root the union of the features of a Name. Features
    without a Name (an empty one, in a file), or whose union has no area, are none."""
    shapefile.register(spark)
    _, folder = shapefile.open_store(root)
    rows = spatial.checkpointed(spark.read.format("shapefile").load(root).filter("trim(Name) <> ''"))
    rings = rows.select("file", "_fid", "Name", F.explode("geometry").alias("ring"))
    united = overlay.dissolved(rings, ["file", "_fid"], ["file", "Name"])
    # A feature has its few rings, outer ones and holes.
    one = united.groupBy("file", "Name").agg(F.collect_list("ring").alias("geometry"))
    prj = rows.groupBy("file", "Name").agg(F.min("prj").alias("prj"))
    scene = F.concat("Name", F.lit(NAME_END)).alias("scene")
    return one.join(prj, ["file", "Name"]).select(*places(F.col("file"), folder), scene, "geometry", "prj")


def save(layers: DataFrame, root: str) -> None:
    """A shapefile for each scene: area/country/grid/scene/scene.shp, without the country where there is none. What was
    below root goes."""
    layers = spatial.checkpointed(layers)
    deep = ["area", "country", "grid", "scene", "scene"]
    shapefile.split_by(layers.filter("country is not null"), root, deep, mode="overwrite")
    shapefile.split_by(layers.filter("country is null").drop("country"), root, [c for c in deep if c != "country"])
