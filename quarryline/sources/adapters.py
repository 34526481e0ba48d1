"""Domain views over the driver's tables: rings, boxes, ground truth, pixels, centroids, clean layers, scene names.

No rasters or shapefiles ship with the tables, so each view derives its rows from columns that vary enough to exercise
the operators. Every order is total, so results do not depend on the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import by_size, table

VERTEX_ORDER = ("l_linenumber", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, k, x, y: one ring per order, a vertex per line."""
    w = Window.partitionBy("image").orderBy(*VERTEX_ORDER)
    return _lines(spark, sf_dir).select("image", F.row_number().over(w).alias("k"), F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its key as `image`. The name comes before any window, so that what follows knows that the rows are dealt
    by image already, and does not deal them again."""
    return table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "image")


def parts(spark: SparkSession, sf_dir: str) -> int:
    """The partitions that boxes are dealt over."""
    return by_size(table(spark, sf_dir, "lineitem"))


def boxes(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """image, box, class_id, score, y1, x1, y2, x2; class 0 is the background. `dealt`: by image over partitions whose
    number goes with the table, so that what a task holds does not grow with it."""
    w = Window.partitionBy("image").orderBy(*VERTEX_ORDER)
    y1, x1 = F.col("l_quantity"), F.round(F.col("l_discount") * 100)
    lines = _lines(spark, sf_dir)
    lines = lines.repartition(parts(spark, sf_dir), "image") if dealt else lines
    return lines.select(
        "image", F.row_number().over(w).alias("box"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("class_id"),
        (F.col("l_extendedprice") / 110000).alias("score"), y1.alias("y1"), x1.alias("x1"),
        (y1 + 10 + F.col("l_linenumber")).alias("y2"), (x1 + 20 + F.round(F.col("l_tax") * 100)).alias("x2"),
        F.col("l_partkey").alias("part"),
    )


def predictions(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """The boxes that a detector is sure of; some images have none."""
    return boxes(spark, sf_dir, dealt).filter("score >= 0.5")


def ground_truth(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """image, gt, class_id, y1, x1, y2, x2: the boxes of a class, moved a little; a third of them far enough to be missed.
    Negative classes are crowds."""
    b = boxes(spark, sf_dir, dealt).filter("class_id > 0")
    far = F.expr("CASE WHEN part % 3 = 0 THEN 500 ELSE 0 END")
    moved = [(F.col(c) + d + (far if c in ("y1", "y2") else 0)).alias(c) for c, d in (("y1", 2), ("x1", 1), ("y2", 1), ("x2", 3))]
    return b.select("image", F.col("box").alias("gt"), F.expr("CASE WHEN part % 11 = 0 THEN -class_id ELSE class_id END").alias("class_id"), *moved)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, r, c, v: each embedding as an 8 x 8 image of bytes."""
    flat = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), F.posexplode("embedding").alias("p", "f"))
    v = F.least(F.greatest(F.floor(F.col("f").cast("double") * 64 + 128), F.lit(0)), F.lit(255)).cast("int")
    return flat.select("image", F.floor(F.col("p") / 8).cast("int").alias("r"), (F.col("p") % 8).cast("int").alias("c"), v.alias("v"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, height, width, data: the images of pixels(), each in one row of bytes."""
    value = lambda f: F.least(F.greatest(F.floor(f.cast("double") * 64 + 128), F.lit(0)), F.lit(255))
    text = F.array_join(F.transform("embedding", lambda f: F.lpad(F.hex(value(f)), 2, "0")), "")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image"), F.floor(F.size("embedding") / 8).cast("int").alias("height"), F.lit(8).alias("width"), F.unhex(text).alias("data"))


def scene_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes in the layout of sources.geotiff.read: each embedding as 4 bands of 4 x 4 pixels of two bytes."""
    value = lambda f: F.least(F.greatest(F.floor(f.cast("double") * 256), F.lit(0)), F.lit(65535))
    byte = lambda n: F.lpad(F.hex(n), 2, "0")
    pair = lambda f: F.concat(byte(value(f) % 256), byte(F.floor(value(f) / 256)))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("image_name"), F.lit("<u2").alias("dtype"), F.lit(4).alias("bands"), F.lit(4).alias("height"), F.lit(4).alias("width"),
        F.array(*map(F.lit, (1000.0, 0.5, 0.0, 2000.0, 0.0, -0.5))).alias("gt"), F.unhex(F.array_join(F.transform("embedding", pair), "")).alias("data"),
    )


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fid, ring: a square on its corner for each part, centre and half width in whole numbers."""
    p = F.col("p_partkey")
    x, y, r = (p * 37 % 480).cast("double"), (p * 91 % 1400).cast("double"), (F.col("p_size") % 6 + 1).cast("double")
    at = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return table(spark, sf_dir, "part").select(p.alias("fid"), F.array(at(x - r, y), at(x, y + r), at(x + r, y), at(x, y - r)).alias("ring"))


def tangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fid, kind, ring: for each part a ring that crosses itself: a bow-tie, a square that is run through twice, or two
    squares that overlap, joined by a way there and back."""
    p = F.col("p_partkey")
    x, y, r = (p * 37 % 480).cast("double"), (p * 91 % 1400).cast("double"), (F.col("p_size") % 6 + 1).cast("double")
    at = lambda *steps: F.array(*[F.struct((x + a * r).alias("x"), (y + b * r).alias("y")) for a, b in steps])
    square = ((0, 0), (2, 0), (2, 2), (0, 2))
    ring = F.when(p % 3 == 0, at((-1, -1), (1, 1), (1, -1), (-1, 1))).when(p % 3 == 1, at(*square, *square)).otherwise(at(*square, (0, 0), *((a + 1, b + 1) for a, b in square), (1, 1)))
    return table(spark, sf_dir, "part").select(p.alias("fid"), (p % 3).cast("int").alias("kind"), ring.alias("ring"))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, idx, id_i, id_j, x, y: detections with the tile they come from."""
    minute = F.hour("ts") * 60 + F.minute("ts")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("image"), F.col("event_id").alias("idx"), F.floor(F.col("value") / 32).cast("int").alias("id_i"),
        F.floor(minute / 160).cast("int").alias("id_j"), F.col("value").alias("x"), minute.cast("double").alias("y"),
    )


def clean_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """layer, fid, x0, y0, x1, y1: rectangles of four layers of known false positives, one for each part."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        (p % 4).cast("int").alias("layer"), p.alias("fid"), ((p * 37) % 480).cast("double").alias("x0"), ((p * 91) % 1400).cast("double").alias("y0"),
        ((p * 37) % 480 + F.col("p_size") / 10.0).alias("x1"), ((p * 91) % 1400 + F.col("p_size") / 5.0).alias("y1"),
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, path, width, height: file names in the fixed layout sensor_date time_catalog."""
    key = F.col("o_orderkey")
    name = F.concat(
        F.lit("WV0"), (key % 3 + 1).cast("string"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lit("_"),
        F.lpad(key.cast("string"), 16, "0"), F.lit("_u16rf3413.v2_pansh.tif"),
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("image"), F.concat(F.lit("/data/scenes/"), F.substring("o_orderpriority", 1, 1), F.lit("/"), name).alias("path"),
        (key % 1000 + 1).cast("int").alias("width"), (key * 7 % 900 + 1).cast("int").alias("height"),
    )
