"""Steps that go by image, and how their rows are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from quarryline.operators import detection


def test_mean_average_precision_is_that_of_the_rows(spark, monkeypatch):
    """Folded hits, and large images by rows, against average_precision of all matches at each threshold."""
    r = random.Random(8)
    box = lambda n: [float(v) for y, x in [(r.randint(0, 60), r.randint(0, 60))] for v in (y, x, y + 20 + n % 5, x + 20)]
    boxes = "box int, class_id int, score double, y1 double, x1 double, y2 double, x2 double"
    pred = spark.createDataFrame([(i, n, 1, r.randint(0, 6) / 6, *box(n)) for i in range(9) for n in range(3 * i)], f"image long, {boxes}")
    gt = spark.createDataFrame([(i, n, 1, *box(n)) for i in range(1, 10) for n in range(4 + i)], "image long, gt int, class_id int, y1 double, x1 double, y2 double, x2 double")
    n_gt, steps = gt.groupBy("image").agg(F.count("gt").alias("n_gt")), (0.3, 0.5, 0.6, 0.8)
    pairs = detection.overlaps(detection.ranked(pred), gt, same_class=True)
    every = n_gt.withColumn("threshold", F.explode(F.array(*map(F.lit, steps))))
    rows = detection.average_precision(detection.match(pred, pairs.drop("score"), steps), every, ["image", "threshold"])
    want = {x.image: x.ap for x in rows.groupBy("image").agg(F.avg("ap").alias("ap")).collect()}
    for fold in (4096, 10):
        monkeypatch.setattr(detection, "FOLD", fold)
        got = {x.image: x.ap for x in detection.mean_average_precision(pred, pairs, n_gt, steps).collect()}
        assert got == pytest.approx(want, abs=1e-12) and len(got) == 9 and sum(v > 0 for v in got.values()) > 4


@pytest.mark.parametrize("name, most", [("images_with_class", 1), ("anchor_targets", 5), ("anchor_sample", 5), ("mean_average_precision", 6)])
def test_rows_by_image_are_dealt_once(spark, name, most):
    """Steps by image, and those by image and box, use rows that are dealt by image as they are."""
    import quarryline.plans.training  # noqa: F401
    from quarryline.plans.registry import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= most


def test_partitions_go_with_the_table(spark, monkeypatch):
    from quarryline import session
    from quarryline.sources import adapters

    monkeypatch.setattr(session, "SHARE", 10_000)
    assert adapters.boxes(spark, "/root/testdata/sf0.001", True).rdd.getNumPartitions() == 12


def test_left_overlaps_keep_boxes_without_a_pair(spark):
    kind = "image long, box int, y1 double, x1 double, y2 double, x2 double"
    a = spark.createDataFrame([(1, 1, 0.0, 0.0, 90.0, 9.0), (1, 2, 500.0, 0.0, 510.0, 9.0), (1, 3, None, 0.0, 1.0, 9.0), (2, 1, 0.0, 0.0, 9.0, 9.0)], kind)
    got = detection.overlaps(a, a.withColumnRenamed("box", "gt"), left=True, parts=3)
    assert {(x.image, x.box, x.gt_b) for x in got.filter("iou IS NOT NULL").collect()} == {(1, 1, 1), (1, 2, 2), (2, 1, 1)}
    assert {(x.image, x.box) for x in got.collect()} == {(1, 1), (1, 2), (1, 3), (2, 1)}
