"""Classes of several sources under common ids, and random regions for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The id and source of the background, which belongs to every source.
BACKGROUND, NOWHERE = 0, ""
# The share of random regions around the boxes of an image.
AROUND = 0.9
#: A prime, of which 5 does not divide the predecessor: the fifth power is a permutation of the numbers below it.
PRIME, FACTOR, SHIFT = 2147483647, 48271, 12345


def key(source: Column, own: Column) -> Column:
    """The name of a class or an image of a source."""
    return F.concat_ws(".", source, own.cast("string"))


def short_name(name: Column) -> Column:
    return F.substring_index(name, ",", 1)


def registry(classes: DataFrame, order: str = "at") -> DataFrame:
    """class_id, source, id, key, name: the background as 0, then the classes (source, id, name) by their first appearance
    in the order; a class that is added again keeps its first name. Classes are few: they are numbered in one task."""
    first = classes.groupBy("source", "id").agg(F.min(F.struct(order, "name")).alias("f"))
    ids = first.select(F.row_number().over(Window.orderBy(f"f.{order}", "source", "id")).alias("class_id"), "source", "id", key(F.col("source"), F.col("id")).alias("key"), short_name(F.col("f.name")).alias("name"))
    background = classes.sparkSession.range(1).select(F.lit(BACKGROUND).alias("class_id"), F.lit(NOWHERE).alias("source"), F.lit(0).cast(dict(ids.dtypes)["id"]).alias("id"), F.lit(".0").alias("key"), F.lit("BG").alias("name"))
    return background.unionByName(ids)


def active(classes: DataFrame) -> DataFrame:
    """source and active, the class ids that a source has, the background with them."""
    own = classes.filter(F.col("class_id") != BACKGROUND).groupBy("source").agg(F.sort_array(F.collect_set("class_id")).alias("own"))
    return own.select("source", F.concat(F.array(F.lit(BACKGROUND)), "own").alias("active"))


def with_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """rows (source, id) with class_id and active; a class that is not registered has neither."""
    sides = classes.select("source", "id", "class_id").join(active(classes), "source")
    return rows.join(sides, ["source", "id"], "left")


def spread(z: Column) -> Column:
    """A permutation of the numbers below PRIME that mixes them; products stay below 2 ** 63."""
    square = z * z % PRIME
    return (square * square % PRIME * z % PRIME * FACTOR + SHIFT) % PRIME


def random(seed: Column, *counters: Column) -> Column:
    """A number below PRIME for a seed and counters, always the same: a task that runs again draws the same."""
    steps = F.array(*[c.cast("long") for c in (*counters, F.lit(0))])
    return F.aggregate(steps, F.pmod(seed.cast("long"), F.lit(PRIME).cast("long")), lambda z, c: spread((z + c) % PRIME))


def _drawn(rows: DataFrame, seed: str, roi: str) -> DataFrame:
    """rows with r0 to r3, random(seed, roi, k): their steps are columns, so that none is worked out twice and the first,
    which all four have, once."""
    def step(rows: DataFrame, starts: dict[str, Column]) -> DataFrame:
        z = rows.withColumns(starts)
        z = z.withColumns({f"_s{n}": F.col(n) * F.col(n) % PRIME for n in starts})
        return z.withColumns({n: (F.col(f"_s{n}") * F.col(f"_s{n}") % PRIME * F.col(n) % PRIME * FACTOR + SHIFT) % PRIME for n in starts}).drop(*[f"_s{n}" for n in starts])

    rows = step(rows, {"_z": (F.pmod(F.col(seed).cast("long"), F.lit(PRIME).cast("long")) + F.col(roi).cast("long")) % PRIME})
    rows = step(rows, {f"r{k}": (F.col("_z") + k) % PRIME for k in range(4)}).drop("_z")
    return step(rows, {f"r{k}": F.col(f"r{k}") % PRIME for k in range(4)})


def _span(rows: DataFrame, low: str, high: str, one: str, two: str, axis: str) -> DataFrame:
    """rows with two different whole numbers from low up to high, as axis1 and axis2, the smaller first, all pairs alike:
    the second is drawn from those that are left, so none is rejected. There have to be two."""
    n = F.col(high) - F.col(low)
    rows = rows.withColumns({"_a": F.floor(F.col(one) * n / F.lit(PRIME)), "_b": F.floor(F.col(two) * (n - 1) / F.lit(PRIME))})
    rows = rows.withColumn("_b", F.when(F.col("_b") >= F.col("_a"), F.col("_b") + 1).otherwise(F.col("_b")))
    return rows.withColumns({f"{axis}1": (F.col(low) + F.least("_a", "_b")).cast("long"), f"{axis}2": (F.col(low) + F.greatest("_a", "_b")).cast("long")})


def random_rois(images: DataFrame, gt: DataFrame, count: int) -> DataFrame:
    """image, roi, y1, x1, y2, x2 (whole numbers) of `count` regions of each image (image, height, width): nine of ten around
    its boxes (image, gt, y1, x1, y2, x2), as many for each, up to a box's size beyond it; the others anywhere, all of them
    where an image has no box. A region without room for two different corners is left out."""
    ranked = gt.select("image", F.row_number().over(Window.partitionBy("image").orderBy("gt")).alias("nth"), *[F.col(c).cast("long").alias(c) for c in ("y1", "x1", "y2", "x2")])
    many = ranked.groupBy("image").agg(F.count(F.lit(1)).alias("n"))
    sized = images.join(many, "image", "left").withColumn("each", F.when(F.col("n") > 0, F.floor(F.lit(AROUND) * count / F.col("n"))).otherwise(0).cast("int"))
    sized = sized.withColumn("n", F.coalesce("n", F.lit(0)))
    h, w = F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")
    near = sized.filter("each > 0").join(ranked, "image").select(
        "image", F.explode(F.sequence(((F.col("nth") - 1) * F.col("each")).cast("long"), (F.col("nth") * F.col("each") - 1).cast("long"))).alias("roi"),
        F.greatest(F.col("y1") - h, F.lit(0)).alias("ly"), F.least(F.col("y2") + h, F.col("height").cast("long")).alias("hy"),
        F.greatest(F.col("x1") - w, F.lit(0)).alias("lx"), F.least(F.col("x2") + w, F.col("width").cast("long")).alias("hx"),
    )
    rest = sized.filter(F.col("each") * F.col("n") < count).select(
        "image", F.explode(F.sequence((F.col("each") * F.col("n")).cast("long"), F.lit(count).cast("long") - 1)).alias("roi"),
        F.lit(0).cast("long").alias("ly"), F.col("height").cast("long").alias("hy"), F.lit(0).cast("long").alias("lx"), F.col("width").cast("long").alias("hx"),
    )
    every = near.unionByName(rest).filter("hy - ly > 1 and hx - lx > 1")
    drawn = _drawn(every, "image", "roi")
    return _span(_span(drawn, "ly", "hy", "r0", "r1", "y"), "lx", "hx", "r2", "r3", "x").select("image", "roi", "y1", "x1", "y2", "x2")
