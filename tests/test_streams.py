"""Streams of detections against the batch operators."""

import random

from pyspark.sql import functions as F

from quarryline.operators import spatial
from quarryline.streaming import detections

SCHEMA = "image string, idx long, id_i int, id_j int, x double, y double, ts timestamp"


def points(seed: int, n: int) -> list[tuple]:
    """Detections of two images; a third of all lie in one spot, some at the same place, across cells' borders and below 0."""
    r, out = random.Random(seed), []
    for k in range(n):
        x, y = (r.uniform(70, 90), r.uniform(-15, 15)) if k % 3 == 0 else (float(r.randint(-300, 300)), float(r.randint(-300, 300)))
        out.append((r.choice("ab"), k, abs(int(x)) // 40, abs(int(y)) // 40, x, y))
    return out


def arrive(spark, rows, folder, parts: int, hours=lambda k: k):
    """The rows in a mixed order as `parts` files, each an hour after the one before."""
    rows = random.Random(5).sample(rows, len(rows))
    for k in range(parts):
        part = spark.createDataFrame(rows[k::parts], SCHEMA.replace(", ts timestamp", ""))
        part.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hours(k)))).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def as_rows(df):
    return sorted(map(tuple, df.select("image", "idx").collect()))


def test_the_end_of_a_stream_is_the_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(detections, "WHOLE", 2)  # the table is written whole on the way
    monkeypatch.setattr(detections, "AT_ONCE", 7)  # and lists are read in many parts
    at = str(tmp_path / "in")
    arrive(spark, [*points(1, 240), ("a", 1000, 0, 0, None, 1.0)], at, 3)
    q = detections.start(stream(spark, at), str(tmp_path / "roots"), str(tmp_path / "cp"), availableNow=True)
    q.awaitTermination()
    every = spark.read.parquet(at)
    assert as_rows(detections.kept(every, str(tmp_path / "roots"))) == as_rows(spatial.deduplicate(every.drop("ts")))
    # More tiles after a stop: they join the components that are open.
    arrive(spark, [(i, k + 5000, a, b, x, y) for i, k, a, b, x, y in points(2, 90)], at, 2)
    q = detections.start(stream(spark, at), str(tmp_path / "roots"), str(tmp_path / "cp"), availableNow=True)
    q.awaitTermination()
    every = spark.read.schema(SCHEMA).parquet(at)
    want = spatial.components(spatial.close_pairs(every)).select("image", "idx", "root")
    assert sorted(map(tuple, detections.components(spark, str(tmp_path / "roots"), "string").collect())) == sorted(map(tuple, want.collect()))


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    pairs = [spark.createDataFrame(p, "image string, a long, b long") for p in ([("a", 5, 6), ("a", 8, 9)], [("a", 6, 8), ("b", 1, 2)], [("a", 2, 9)])]
    add = detections.fold(str(tmp_path))
    for n in (0, 1, 1, 2, 2):
        add(pairs[n], n)
    assert sorted(map(tuple, detections.components(spark, str(tmp_path), "string").collect())) == [("a", k, 2) for k in (2, 5, 6, 8, 9)] + [("b", 1, 1), ("b", 2, 1)]
    assert not detections.components(spark, str(tmp_path / "none")).count()


def test_cells_are_forgotten_behind_the_watermark(spark, tmp_path):
    # Two detections of a spot an hour apart meet. What comes two days later elsewhere moves the watermark, which holds
    # from the next batch on; detections of the spot after that meet each other only.
    at = str(tmp_path / "in")
    for k, (hour, x) in enumerate(((0, 1.0), (1, 2.0), (48, 900.0), (49, 3.0), (50, 4.0))):
        arrive(spark, [("a", k, 0, 0, x, 1.0)], at, 1, lambda _, hour=hour: hour)
        q = detections.start(stream(spark, at), str(tmp_path / "roots"), str(tmp_path / "cp"), "2 hours", availableNow=True)
        q.awaitTermination()
    assert sorted(map(tuple, detections.components(spark, str(tmp_path / "roots"), "string").collect())) == [("a", 0, 0), ("a", 1, 0), ("a", 3, 3), ("a", 4, 3)]


def test_a_stream_without_a_watermark_keeps_its_state_in_the_jvm(spark, tmp_path):
    # Each key of a Python processor costs some milliseconds, and there are ten keys for each image.
    arrive(spark, points(3, 12), str(tmp_path / "in"), 1)
    plan = detections.close_pairs(stream(spark, str(tmp_path / "in")))._jdf.queryExecution().analyzed().toString()
    assert "Join Inner" in plan and "TransformWithState" not in plan
