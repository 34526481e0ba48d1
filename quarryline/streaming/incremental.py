"""The same operators over arriving files. Batches of detections are cleaned row by row; counts close by watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import spatial


def scenes(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """Arriving scene files: image_name, path, content."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    found = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(path)
    return found.select(F.substring_index(F.element_at(F.split("path", "/"), -1), ".tif", 1).alias("image_name"), "path", "content")


def cleaned(points: DataFrame, rectangles: DataFrame) -> DataFrame:
    """A stream of points without those in a rectangle: a join with a static side that keeps no state."""
    return spatial.outside(points, rectangles)


def counts(points: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Points of each image and window of ts; rows that come later than `late` are dropped."""
    return points.withWatermark("ts", late).groupBy("image", F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("points")).select("image", F.col("w.start").alias("start"), "points")
