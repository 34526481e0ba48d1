"""Histogram operators over long-form pixels (image, r, c, v), and windowed filters in numpy."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stretch(px: DataFrame) -> DataFrame:
    """Each image's values stretched to 0..255 and rounded, half to even; a constant image becomes 0."""
    ends = px.groupBy("image").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    wide = F.col("hi") - F.col("lo")
    return px.join(ends, "image").select("image", "r", "c", F.when(wide > 0, F.rint((F.col("v") - F.col("lo")) * 255 / wide)).otherwise(0).cast("int").alias("v"))


def histogram(px: DataFrame) -> DataFrame:
    """image, v, n and cdf (values up to v). At most 256 rows an image."""
    h = px.groupBy("image", "v").agg(F.count(F.lit(1)).alias("n"))
    return h.withColumn("cdf", F.sum("n").over(Window.partitionBy("image").orderBy("v")))


def equalise(px: DataFrame) -> DataFrame:
    """Histogram equalisation by a lookup table of each image; one with a single value keeps it."""
    w = Window.partitionBy("image")
    h = histogram(px).withColumn("n0", F.min_by("n", "v").over(w)).withColumn("all", F.sum("n").over(w))
    room = F.col("all") - F.col("n0")
    lut = h.select("image", "v", F.when(room > 0, F.rint((F.col("cdf") - F.col("n0")) * 255 / room)).otherwise(F.col("v")).cast("int").alias("e"))
    return px.join(lut, ["image", "v"]).select("image", "r", "c", F.col("e").alias("v"))


def otsu(px: DataFrame) -> DataFrame:
    """image, threshold: the value whose split has the largest variance between the two sides, the least of several; 0
    for a constant image."""
    up = Window.partitionBy("image").orderBy("v")
    every = Window.partitionBy("image")
    h = histogram(px).withColumn("s", F.sum(F.col("n") * F.col("v")).over(up)).withColumn("all", F.sum("n").over(every)).withColumn("total", F.sum(F.col("n") * F.col("v")).over(every))
    left, right = F.col("cdf"), F.col("all") - F.col("cdf")
    gap = F.col("s") / left - (F.col("total") - F.col("s")) / right
    h = h.filter(right > 0).withColumn("between", F.round(left * right * gap * gap / (F.col("all") * F.col("all")), 6))
    best = Window.partitionBy("image").orderBy(F.desc("between"), F.asc("v"))
    top = h.withColumn("n1", F.row_number().over(best)).filter("n1 = 1").select("image", F.col("v").alias("t"))
    return px.select("image").distinct().join(top, "image", "left").select("image", F.coalesce("t", F.lit(0)).alias("threshold"))


def mask_box(px: DataFrame, over: int) -> DataFrame:
    """The bounding box of each image's pixels over a value, far side exclusive; zeros without any."""
    on = F.col("v") > over
    ends = px.groupBy("image").agg(*[f(F.when(on, F.col(c))).alias(n) for n, f, c in (("y1", F.min, "r"), ("x1", F.min, "c"), ("y2", F.max, "r"), ("x2", F.max, "c"))])
    return ends.select("image", *[F.coalesce(F.col(c) + (1 if c.endswith("2") else 0), F.lit(0)).alias(c) for c in ("y1", "x1", "y2", "x2")])


def disk_median(image: np.ndarray, radius: int) -> np.ndarray:
    """The median of the pixels (whole numbers of a byte) within the radius, counting only pixels of the image; of an even
    number the upper one.

    All rows go along the columns together, each with the histogram of its disk: a step takes the pixels of the disk's
    edge in and out. Memory is a histogram for each row."""
    h, w = image.shape
    reach = [math.isqrt(radius * radius - d * d) for d in range(-radius, radius + 1)]
    area = sum(2 * x + 1 for x in reach)
    # Columns of the image amid the value 256, which stands for what is outside.
    left = 2 * radius + 1
    columns = np.full((left + w + radius, h + 2 * radius), 256, np.int64)
    columns[left : left + w, radius : radius + h] = image.T
    counts = np.zeros((h, 17, 16), np.uint16 if area < 1 << 16 else np.uint32)
    counts[:, 16, 0] = area
    flat, row = counts.reshape(-1), np.arange(h)
    out = np.empty((w, h), image.dtype)
    for c in range(-radius, w):
        for d, x in enumerate(reach):
            flat[row * 272 + columns[left + c - 1 - x, d : d + h]] -= 1
            flat[row * 272 + columns[left + c + x, d : d + h]] += 1
        if c < 0:
            continue
        middle = ((area - counts[:, 16, 0]) // 2)[:, None]
        coarse = counts.sum(axis=2, dtype=np.int64)
        below = np.cumsum(coarse, axis=1)
        part = (below > middle).argmax(axis=1)
        before = (below[row, part] - coarse[row, part])[:, None]
        out[c] = part * 16 + (before + np.cumsum(counts[row, part], axis=1) > middle).argmax(axis=1)
    return np.ascontiguousarray(out.T)


def gaussian(image: np.ndarray, sigma: float = 2.0, reach: float = 4.0) -> np.ndarray:
    """A separable Gaussian; the border repeats."""
    k = int(reach * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-k, k + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        wide = np.pad(image, [(k, k) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        n = image.shape[axis]
        image = sum(kernel[i] * (wide[i : i + n] if axis == 0 else wide[:, i : i + n]) for i in range(2 * k + 1))
    return image


def filtered(images: DataFrame, kernel, name: str) -> DataFrame:
    """image, height, width and the kernel's output, row by row, as an array of doubles, of images of one band of bytes
    (image, height, width, data). An image is one row, in and out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, w = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = [kernel(np.frombuffer(x.as_buffer(), np.uint8).reshape(a, b).astype(float)).ravel() for x, a, b in zip(batch.column(3), h, w)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.float64()))], names=["image", "height", "width", name])

    return images.select("image", "height", "width", "data").mapInArrow(run, f"image long, height int, width int, {name} array<double>")


def long_form(df: DataFrame, name: str) -> DataFrame:
    """image, r, c and value of the output of filtered()."""
    each = df.select("image", "width", F.posexplode(name).alias("p", name))
    return each.select("image", F.floor(F.col("p") / F.col("width")).cast("int").alias("r"), (F.col("p") % F.col("width")).cast("int").alias("c"), name)
