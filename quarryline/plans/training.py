"""Registered queries: proposals and the targets that a detector is trained on."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import dataset, detection
from ..sources import adapters as A
from . import oracle_views as V
from .queries import _BEST, QUERIES, r3
from .registry import ORACLES, query, with_views


@query("anchor_sample", with_views("t AS (" + ORACLES["anchor_targets"] + ")") + """SELECT image, box, CASE WHEN k <= CASE target WHEN 1 THEN 1 ELSE 3 - least(n, 1) END THEN target ELSE 0 END AS target FROM
 (SELECT *, row_number() OVER (PARTITION BY image, target ORDER BY (image * 7919 + box * 104729) % 10007, box) AS k, count(*) FILTER (target = 1) OVER (PARTITION BY image) AS n FROM t)""")
def anchor_sample(spark, sf_dir):
    """Targets of three anchors an image, at most one of them positive; the others become neutral."""
    return detection.balanced(QUERIES["anchor_targets"](spark, sf_dir), 3, 1, (F.col("image") * 7919 + F.col("box") * 104729) % 10007)


@query("anchor_deltas", with_views(V.BOXES, V.GT, _BEST) + """, m AS (SELECT *, row_number() OVER (PARTITION BY image, box ORDER BY iou DESC, gt) AS k FROM ov WHERE iou > 0)
 SELECT m.image, m.box, round(((g.y1 + g.y2) / 2 - (b.y1 + b.y2) / 2) / (b.y2 - b.y1) / 0.1, 3) + 0.0 AS dy, round(((g.x1 + g.x2) / 2 - (b.x1 + b.x2) / 2) / (b.x2 - b.x1) / 0.1, 3) + 0.0 AS dx,
 round(ln((g.y2 - g.y1) / (b.y2 - b.y1)) / 0.2, 3) + 0.0 AS dh, round(ln((g.x2 - g.x1) / (b.x2 - b.x1)) / 0.2, 3) + 0.0 AS dw FROM m JOIN boxes b ON b.image = m.image AND b.box = m.box JOIN gts g ON g.image = m.image AND g.gt = m.gt WHERE m.k = 1""")
def anchor_deltas(spark, sf_dir):
    """The deltas from each anchor to its best ground truth, in their standard deviations."""
    m = detection.best_match(A.boxes(spark, sf_dir), A.ground_truth(spark, sf_dir), "box", "gt")
    d = [v / s for v, s in zip(B.refinement(B.box(), B.box(suffix="_b")), detection.DEVIATIONS)]
    return m.select("image", "box", *[r3(v, n) for v, n in zip(d, ("dy", "dx", "dh", "dw"))])


@query("detection_targets", with_views(V.BOXES, V.GT, _BEST) + """, m AS (SELECT b.image, b.box, o.gt, o.gt_class, o.iou, row_number() OVER (PARTITION BY b.image, b.box ORDER BY o.iou DESC, o.gt) AS k FROM boxes b LEFT JOIN (SELECT * FROM ov WHERE iou > 0 AND gt_class > 0) o ON b.image = o.image AND b.box = o.box),
 c AS (SELECT image, box, max(iou) AS crowd FROM ov WHERE gt_class < 0 GROUP BY image, box),
 s AS (SELECT m.image, m.box, m.gt, m.gt_class, coalesce(m.iou, 0) >= 0.5 AS positive, (m.image * 7919 + m.box * 104729) % 10007 AS o FROM m LEFT JOIN c ON c.image = m.image AND c.box = m.box WHERE k = 1 AND (coalesce(m.iou, 0) >= 0.5 OR coalesce(c.crowd, 0) < 0.001)),
 p AS (SELECT *, row_number() OVER (PARTITION BY image, positive ORDER BY o, box) AS n, least(count(*) FILTER (positive) OVER (PARTITION BY image), 1) AS many FROM s)
 SELECT image, box, positive, CASE WHEN positive THEN gt_class ELSE 0 END AS class_id, CASE WHEN positive THEN CAST(gt AS INT) END AS gt FROM p WHERE CASE WHEN positive THEN n <= 1 ELSE n <= CAST(many / 0.33 AS INT) - many END""")
def detection_targets(spark, sf_dir):
    """Of an image's proposals one positive and two negatives for it, with class and ground truth; no negative without
    a positive, as the share of positives is fixed."""
    order = (F.col("image") * 7919 + F.col("box") * 104729) % 10007
    return detection.targets(A.boxes(spark, sf_dir), A.ground_truth(spark, sf_dir), 3, 0.33, order).select("image", "box", "positive", "class_id", "gt")



@query("proposals", with_views(V.BOXES, """top_ AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, box) AS n FROM boxes QUALIFY n <= 6),
 moved AS (SELECT image, box, score, n, least(greatest(cy - nh / 2, 0), 64) AS y1, least(greatest(cx - nw / 2, 0), 48) AS x1, least(greatest(cy + nh / 2, 0), 64) AS y2, least(greatest(cx + nw / 2, 0), 48) AS x2 FROM
 (SELECT *, y1 + h / 2 + score * 0.1 * h AS cy, x1 + w / 2 - score * 0.1 * w AS cx, h * exp(score * 0.2) AS nh, w * exp(-score * 0.2) AS nw FROM (SELECT *, y2 - y1 AS h, x2 - x1 AS w FROM top_))),
 step AS (SELECT image, 0 AS n, CAST([] AS STRUCT(box BIGINT, y1 DOUBLE, x1 DOUBLE, y2 DOUBLE, x2 DOUBLE)[]) AS kept FROM (SELECT DISTINCT image FROM moved) UNION ALL
 SELECT s.image, CAST(r.n AS INT), CASE WHEN len(list_filter(s.kept, lambda k: greatest(least(k.y2, r.y2) - greatest(k.y1, r.y1), 0) * greatest(least(k.x2, r.x2) - greatest(k.x1, r.x1), 0) > (0.7::DOUBLE + 1e-9) * ((k.y2 - k.y1) * (k.x2 - k.x1) + (r.y2 - r.y1) * (r.x2 - r.x1)
 - greatest(least(k.y2, r.y2) - greatest(k.y1, r.y1), 0) * greatest(least(k.x2, r.x2) - greatest(k.x1, r.x1), 0)))) > 0 THEN s.kept ELSE list_append(s.kept, {'box': r.box, 'y1': r.y1, 'x1': r.x1, 'y2': r.y2, 'x2': r.x2}) END
 FROM step s JOIN moved r ON s.image = r.image AND r.n = s.n + 1),
 last_ AS (SELECT image, unnest(kept) AS k, unnest(range(1, len(kept) + 1)) AS rank FROM (SELECT image, kept FROM step QUALIFY row_number() OVER (PARTITION BY image ORDER BY n DESC) = 1))""", recursive=True) + "SELECT image, CAST(k.box AS INT) AS box, CAST(rank AS INT) AS rank, round(k.y1, 3) + 0.0 AS y1, round(k.x2, 3) + 0.0 AS x2 FROM last_ WHERE rank <= 4")
def proposals(spark, sf_dir):
    """The six best anchors of an image, moved by their deltas, clipped, suppressed at 0.7, the best four."""
    b = A.boxes(spark, sf_dir)
    s = F.col("score")
    deltas = (s, -s, s, -s)
    out = detection.proposals(b, deltas, tuple(map(F.lit, (0.0, 0.0, 64.0, 48.0))), before=6, after=4)
    return out.select("image", "box", "rank", r3(F.col("y1"), "y1"), r3(F.col("x2"), "x2"))


@query("smooth_l1", with_views(V.BOXES) + "SELECT image, round(sum(CASE WHEN d < 1 THEN d * d / 2 ELSE d - 0.5 END), 6) + 0.0 AS loss FROM (SELECT image, abs(y1 / 20 - x1 / 5) AS d FROM boxes) GROUP BY image")
def smooth_l1(spark, sf_dir):
    return A.boxes(spark, sf_dir).groupBy("image").agg((F.round(F.sum(B.smooth_l1(F.col("y1") / 20, F.col("x1") / 5)), 6) + 0.0).alias("loss"))


@query("trim_zero_rows", with_views(V.BOXES) + "SELECT image, box FROM (SELECT *, CASE WHEN class_id = 0 THEN 0 ELSE y1 END AS a, CASE WHEN class_id = 0 THEN 0 ELSE x1 END AS b FROM boxes) WHERE NOT (a = 0 AND b = 0)")
def trim_zero_rows(spark, sf_dir):
    """Rows of padding, all of whose numbers are 0, go."""
    padded = A.boxes(spark, sf_dir).select("image", "box", *[F.when(F.col("class_id") == 0, 0.0).otherwise(F.col(c)).alias(c) for c in ("y1", "x1")])
    return detection.without_padding(padded, ["y1", "x1"]).select("image", "box")


def _drawn(roi: str, axis: int) -> str:
    """The number that is drawn for an image, a region and a counter, as SQL."""
    z = "image % 2147483647"
    for c in (roi, str(axis), "0"):
        at = f"(({z} + {c}) % 2147483647)"
        z = f"list_reduce([0, {at}], lambda a, z: ((z * z % 2147483647) * (z * z % 2147483647) % 2147483647 * z % 2147483647 * 48271 + 12345) % 2147483647)"
    return z


def _pair(low: str, high: str, axis: int) -> str:
    a = f"CAST(floor({_drawn('roi', 2 * axis)} * ({high} - {low}) / 2147483647) AS BIGINT)"
    b = f"CAST(floor({_drawn('roi', 2 * axis + 1)} * ({high} - {low} - 1) / 2147483647) AS BIGINT)"
    return f"{a} AS a{axis}, {b} AS b{axis}"


_HEIGHT, _WIDTH, _COUNT = 96, 80, 10


@query("random_rois", with_views(V.BOXES, V.GT) + f""", im AS (SELECT DISTINCT l_orderkey AS image FROM lineitem), g AS (SELECT image, row_number() OVER (PARTITION BY image ORDER BY gt) AS nth, count(*) OVER (PARTITION BY image) AS n, CAST(y1 AS BIGINT) AS y1, CAST(x1 AS BIGINT) AS x1, CAST(y2 AS BIGINT) AS y2, CAST(x2 AS BIGINT) AS x2 FROM gts WHERE y1 < {_HEIGHT}),
 near AS (SELECT image, unnest(range((nth - 1) * (9 // n), nth * (9 // n))) AS roi, greatest(y1 - (y2 - y1), 0) AS ly, least(y2 + (y2 - y1), {_HEIGHT}) AS hy, greatest(x1 - (x2 - x1), 0) AS lx, least(x2 + (x2 - x1), {_WIDTH}) AS hx FROM g),
 rest AS (SELECT image, unnest(range(coalesce(n, 0) * CASE WHEN n > 0 THEN 9 // n ELSE 0 END, {_COUNT})) AS roi, 0 AS ly, {_HEIGHT} AS hy, 0 AS lx, {_WIDTH} AS hx FROM im LEFT JOIN (SELECT image, max(n) AS n FROM g GROUP BY image) USING (image)),
 d AS (SELECT *, {_pair("ly", "hy", 0)}, {_pair("lx", "hx", 1)} FROM (SELECT * FROM near UNION ALL SELECT * FROM rest) WHERE hy - ly > 1 AND hx - lx > 1),
 e AS (SELECT *, CASE WHEN b0 >= a0 THEN b0 + 1 ELSE b0 END AS c0, CASE WHEN b1 >= a1 THEN b1 + 1 ELSE b1 END AS c1 FROM d)
 SELECT image, roi, ly + least(a0, c0) AS y1, lx + least(a1, c1) AS x1, ly + greatest(a0, c0) AS y2, lx + greatest(a1, c1) AS x2 FROM e""")
def random_rois(spark, sf_dir):
    """Random regions of images of 96 x 80, most around their boxes, drawn by counters."""
    images = A.boxes(spark, sf_dir).select("image").distinct().withColumn("height", F.lit(_HEIGHT)).withColumn("width", F.lit(_WIDTH))
    return dataset.random_rois(images, A.ground_truth(spark, sf_dir).filter(F.col("y1") < _HEIGHT), _COUNT)
