"""Polygon annotations in the JSON layout of a common image annotator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_REGION = "struct<shape_attributes:struct<all_points_x:array<double>,all_points_y:array<double>>,region_attributes:struct<object_name:string>>"


def with_scenes(regions: DataFrame, scenes: DataFrame) -> DataFrame:
    """The regions of read() with the scene of the same file name (from its path); regions without one go."""
    return scenes.withColumn("filename", F.element_at(F.split("path", "/"), -1)).join(regions, "filename")


def read(spark: SparkSession, path: str) -> DataFrame:
    """filename, region, object_name, ring: one row per region. Regions are an object or a list; images without any
    give no rows."""
    text = spark.read.text(path, wholetext=True)
    files = text.select(F.explode(F.map_values(F.from_json("value", "map<string,string>"))).alias("f"))
    files = files.select(F.get_json_object("f", "$.filename").alias("filename"), F.get_json_object("f", "$.regions").alias("r"))
    regions = F.when(F.col("r").startswith("{"), F.map_values(F.from_json("r", f"map<string,{_REGION}>"))).otherwise(F.from_json("r", f"array<{_REGION}>"))
    each = files.select("filename", F.posexplode(regions).alias("region", "a"))
    points = F.arrays_zip(F.col("a.shape_attributes.all_points_x").alias("x"), F.col("a.shape_attributes.all_points_y").alias("y"))
    return each.select("filename", "region", F.col("a.region_attributes.object_name").alias("object_name"), points.alias("ring"))
