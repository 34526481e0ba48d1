"""Dataflow verbs over image rows: map, flat map, stateful map, grouped map, tiling, and the image record."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CROP, OVERLAP = 200, 0.2


def map_rows(df: DataFrame, f: Callable[[dict], dict], schema: str) -> DataFrame:
    """One row out for each row in; f gets and gives dictionaries. Rows travel in Arrow batches."""
    return flat_map(df, lambda row: [f(row)], schema)


def flat_map(df: DataFrame, f: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Any number of rows out for each row in."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [out for row in frame.to_dict("records") for out in f(row)]
            if rows:
                yield pd.DataFrame(rows)

    return df.mapInPandas(run, schema)


def map_with_state(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """make() builds the callable once for each task (a model, say), which then sees every row of it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = make()
        for frame in frames:
            if len(frame):
                yield pd.DataFrame([f(row) for row in frame.to_dict("records")])

    return df.mapInPandas(run, schema)


def map_batches(df: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """f gets and gives whole batches of rows as frames, without a call for each row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield f(frame)

    return df.mapInPandas(run, schema)


def map_groups(df: DataFrame, key: str, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """f sees each group whole; the library's own operators avoid it, as a group has to fit in a task."""
    return df.groupBy(key).applyInPandas(f, schema)


def tiles(scenes: DataFrame, crop: int = CROP, overlap: float = OVERLAP) -> DataFrame:
    """ty, tx, id_i, id_j, h, w of each tile of the rows' width and height; edge tiles are cut."""
    stride = int(crop * (1 - overlap))
    starts = lambda side: F.explode(F.sequence(F.lit(0), F.col(side) - 1, F.lit(stride)))
    t = scenes.filter("width > 0 and height > 0").withColumn("ty", starts("height")).withColumn("tx", starts("width"))
    return t.withColumn("id_i", F.floor(F.col("ty") / stride).cast("int")).withColumn("id_j", F.floor(F.col("tx") / stride).cast("int")) \
        .withColumn("h", F.least(F.lit(crop), F.col("height") - F.col("ty"))).withColumn("w", F.least(F.lit(crop), F.col("width") - F.col("tx")))


# The order of the image record's numbers before the active classes.
META = (
    "image_id", "original_h", "original_w", "original_c", "h", "w", "c",
    "window_y1", "window_x1", "window_y2", "window_x2", "scale",
)


def pack_meta(images: DataFrame, active: str = "active") -> DataFrame:
    """meta: the columns of META and the array of active classes as one array of doubles."""
    return images.withColumn("meta", F.concat(F.array(*[F.col(c).cast("double") for c in META]), F.col(active).cast("array<double>")))


def parse_meta(df: DataFrame) -> DataFrame:
    """m: the fields of meta by name; active holds all classes, however many there are."""
    whole = [F.element_at("meta", k + 1).cast("double" if n == "scale" else "int").alias(n) for k, n in enumerate(META)]
    rest = F.slice("meta", len(META) + 1, F.greatest(F.size("meta") - len(META), F.lit(0)))
    return df.withColumn("m", F.struct(*whole, rest.cast("array<int>").alias("active")))
