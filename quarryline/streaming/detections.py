"""Deduplication of a stream of detections: a tile that comes late meets the detections of the tiles around it.

The state is keyed by cells of the map, not by images, so a large image is spread over many keys. A cell keeps the
detections in it and within the radius around it until the watermark has passed the last of them; what comes meets what
is kept, and close pairs leave as they occur. Each batch of pairs is folded into the table of components: roots only
fall, so the least root of an id is its root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators import spatial
from ..session import ship

#: Side of a cell in radii: about 1.13 copies of a detection, and some hundred objects of a few radii in a cell.
WIDTH = 32
#: Kept detections that are compared at once.
AT_ONCE = 4096
#: Batches after which the table of components is written whole.
WHOLE = 16
POINT = "idx long, x double, y double, i int, j int"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether tiles a and b (one axis) are in a common block of 4 tiles at stride 3."""
    one, two = (a // 3, np.maximum((a - 1) // 3, 0)), (b // 3, np.maximum((b - 1) // 3, 0))
    return (one[0] == two[0]) | (one[0] == two[1]) | (one[1] == two[0]) | (one[1] == two[1])


def _met(own: pd.DataFrame, near: pd.DataFrame, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The ids of close pairs of a detection of the cell and a later one of the cell or around it."""
    p, q = ({c: f[c].to_numpy() for c in ("idx", "x", "y", "i", "j")} for f in (own, near))
    found = []
    step = max(AT_ONCE * 256 // max(len(near), 1), 1)
    for at in range(0, len(own), step):
        s = {c: v[at : at + step, None] for c, v in p.items()}
        dx, dy = s["x"] - q["x"], s["y"] - q["y"]
        d = np.sqrt(dx * dx + dy * dy)
        r, c = np.nonzero((s["idx"] < q["idx"]) & (d > 0) & (d < radius) & _common(s["i"], q["i"]) & _common(s["j"], q["j"]))
        found.append((p["idx"][at + r], q["idx"][c]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


class CloseInCell(StatefulProcessor):
    """Keyed by image and cell. The lists `own` (of the cell) and `near` (of the cell and around it) are read in parts."""

    def __init__(self, radius: float):
        self.radius = radius

    def init(self, handle) -> None:
        self.handle = handle
        self.own, self.near = handle.getListState("own", POINT), handle.getListState("near", POINT)
        self.until = handle.getValueState("until", "at long")

    @staticmethod
    def _parts(kept) -> Iterator[pd.DataFrame]:
        part = []
        for row in kept.get():
            part.append(row)
            if len(part) == AT_ONCE:
                yield pd.DataFrame(part, columns=["idx", "x", "y", "i", "j"])
                part = []
        if part:
            yield pd.DataFrame(part, columns=["idx", "x", "y", "i", "j"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = None
        for frame in rows:
            inside = frame["inside"].to_numpy(bool)
            near = frame[["idx", "x", "y", "i", "j"]]
            own = near[inside]
            found = [_met(own, near, self.radius)] if len(own) else []
            if len(own):
                found += [_met(own, part, self.radius) for part in self._parts(self.near)]
            found += [_met(part, near, self.radius) for part in self._parts(self.own)]
            if len(own):
                self.own.appendList([tuple(r) for r in own.itertuples(index=False)])
            self.near.appendList([tuple(r) for r in near.itertuples(index=False)])
            newest = int(frame["at"].max())
            last = newest if last is None else max(last, newest)
            a, b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
            if len(a):
                yield pd.DataFrame({"image": [key[0]] * len(a), "a": a, "b": b})
        if last is not None:
            self._wait(last)

    def _wait(self, last: int) -> None:
        known = self.until.get()[0] if self.until.exists() else None
        if known is None or last > known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.until.update((last,))
            self.handle.registerTimer(last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for kept in (self.own, self.near, self.until):
            kept.clear()
        return iter([])

    def close(self) -> None:
        pass


def close_pairs(found: DataFrame, late: str | None = None, radius: float = spatial.RADIUS) -> DataFrame:
    """image, a, b (a < b) of a stream of detections (image, idx, id_i, id_j, x, y), as spatial.close_pairs gives them; a
    pair may come more than once. With `late` a column ts is the event time: a cell is forgotten once the watermark, that
    long behind, has passed its last detection; without it cells stay. Rows with a null in any of the columns have no pair."""
    wide, named = radius * WIDTH, ["image", "idx", "id_i", "id_j", "x", "y"]
    rows = found.dropna(subset=[*named, *(["ts"] if late else [])])
    rows = rows.withWatermark("ts", late) if late else rows
    cells = lambda c: F.sequence(F.floor((F.col(c) - radius) / wide), F.floor((F.col(c) + radius) / wide))
    points = [F.col("idx").cast("long").alias("idx"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("id_i").cast("int").alias("i"), F.col("id_j").cast("int").alias("j")]
    near = lambda rows: rows.withColumn("cx", F.explode(cells("x"))).withColumn("cy", F.explode(cells("y")))
    if not late:
        # Nothing is forgotten, so the state is that of a join of the stream with itself, inside the JVM.
        own = rows.select("image", F.floor(F.col("x") / wide).alias("cx"), F.floor(F.col("y") / wide).alias("cy"), *points)
        other = near(rows).select(F.col("image").alias("image_b"), F.col("cx").alias("cx_b"), F.col("cy").alias("cy_b"), *[p.alias(f"{n}_b") for p, n in zip(points, ("idx", "x", "y", "i", "j"))])
        d = F.sqrt((F.col("x") - F.col("x_b")) * (F.col("x") - F.col("x_b")) + (F.col("y") - F.col("y_b")) * (F.col("y") - F.col("y_b")))
        first = lambda c: F.floor(F.col(c) / 3)
        last = lambda c: F.greatest(F.floor((F.col(c) - 1) / 3), F.lit(0))
        common = lambda p, q: (first(p) == first(q)) | (first(p) == last(q)) | (last(p) == first(q)) | (last(p) == last(q))
        same = (F.col("image") == F.col("image_b")) & (F.col("cx") == F.col("cx_b")) & (F.col("cy") == F.col("cy_b"))
        close = (F.col("idx") < F.col("idx_b")) & (d > 0) & (d < radius) & common("i", "i_b") & common("j", "j_b")
        return own.join(other, same & close).select("image", F.col("idx").alias("a"), F.col("idx_b").alias("b"))
    ship(found.sparkSession)
    at = near(rows)
    inside = (F.col("cx") == F.floor(F.col("x") / wide)) & (F.col("cy") == F.floor(F.col("y") / wide))
    sent = at.select("image", "cx", "cy", *points, inside.alias("inside"), F.unix_millis("ts").alias("at"), "ts")
    schema = f"image {dict(found.dtypes)['image']}, a long, b long"
    return sent.groupBy("image", "cx", "cy").transformWithStateInPandas(CloseInCell(radius), schema, "Append", "EventTime")


def _written(spark: SparkSession, root: str, before: int | None = None) -> list[str]:
    """The finished folders of the table of components (of batches below `before`): the newest whole one and those after it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [n for n in names if n.startswith(("part-", "whole-")) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    number = lambda n: int(n.split("-")[1])
    done = [n for n in done if before is None or number(n) < before]
    start = max((number(n) for n in done if n.startswith("whole-")), default=-1)
    return [f"{root}/{n}" for n in sorted(done) if number(n) >= start]


def components(spark: SparkSession, root: str, image: str = "long", before: int | None = None) -> DataFrame:
    """image, idx, root of the detections in a pair so far, or in the batches below `before`."""
    folders = _written(spark, root, before)
    if not folders:
        return spark.createDataFrame([], f"image {image}, idx long, root long")
    return spark.read.parquet(*folders).groupBy("image", "idx").agg(F.min("root").alias("root"))


def fold(root: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: add a batch of pairs to the components in the folder `root`, which all executors must share.
    The pairs are led to the roots of their ends; where these differ, components meet, and their members move. A batch that
    runs again starts from what was there before it."""

    def add(pairs: DataFrame, n: int) -> None:
        spark = pairs.sparkSession
        pairs = spatial.checkpointed(pairs.distinct())
        before = components(spark, root, dict(pairs.dtypes)["image"], n)
        known = before.join(pairs.select("image").distinct(), "image", "left_semi")
        led = pairs
        for end in ("a", "b"):
            led = led.join(known.select("image", F.col("idx").alias(end), F.col("root").alias(f"r{end}")), ["image", end], "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
        meet = led.filter("ra <> rb").select("image", F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        joined = spatial.checkpointed(spatial.components(meet))
        moved = known.join(joined.select("image", F.col("idx").alias("root"), F.col("root").alias("new")), ["image", "root"]).select("image", "idx", F.col("new").alias("root"))
        new = joined.select("image", "idx", "root").unionByName(moved)
        whole = n % WHOLE == WHOLE - 1
        if whole:
            new = before.unionByName(new).groupBy("image", "idx").agg(F.min("root").alias("root"))
        new.write.mode("overwrite").parquet(f"{root}/{'whole' if whole else 'part'}-{n:012d}")

    return add


def start(found: DataFrame, root: str, checkpoint: str, late: str | None = None, radius: float = spatial.RADIUS, **trigger) -> StreamingQuery:
    """Keep the components of a stream of detections in the folder `root`. The session's streams get RocksDB state stores,
    which keyed state needs."""
    spark = found.sparkSession
    if spark.conf.get(PROVIDER) != ROCKS:
        spark.conf.set(PROVIDER, ROCKS)
    out = close_pairs(found, late, radius).writeStream.foreachBatch(fold(root)).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(**trigger) if trigger else out).start()


def kept(found: DataFrame, root: str) -> DataFrame:
    """The detections (a table of those that came) that stay by the components so far: after the stream's end, those of
    spatial.deduplicate."""
    gone = components(found.sparkSession, root, dict(found.dtypes)["image"]).filter("idx <> root").select("image", "idx")
    return found.join(gone, ["image", "idx"], "left_anti")
