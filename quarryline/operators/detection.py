"""Detection algebra: overlaps, suppression, matching, average precision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes as B
from .spatial import checkpointed

BOX = ("y1", "x1", "y2", "x2")
# The deviations of box deltas.
DEVIATIONS = (0.1, 0.1, 0.2, 0.2)


#: An overlap is over a threshold from here on: one that is the threshold's, but for the noise of exponentials, is not.
HAIR = 1e-9
#: Boxes of a group that are folded as one array at most.
FOLD = 4096
#: Side of the cells that boxes meet in; boxes of a tile of 200 pixels are in at most 16.
CELL = 64.0


def _in_cells(df: DataFrame, names: tuple[str, ...], cy: str, cx: str, outer: bool = False) -> DataFrame:
    explode = F.explode_outer if outer else F.explode
    cells = lambda lo, hi: explode(F.sequence(F.floor(F.col(lo) / CELL), F.greatest(F.floor(F.col(lo) / CELL), F.floor(F.col(hi) / CELL))))
    return df.withColumn(cy, cells(names[0], names[2])).withColumn(cx, cells(names[1], names[3]))


def overlaps(a: DataFrame, b: DataFrame, key: str = "image", least: float = 0.0, same_class: bool = False, left: bool = False, parts: int | None = None) -> DataFrame:
    """All pairs of an image that overlap by more than `least`, with iou. b's columns get the suffix _b. With `left` there
    are rows of a beside them, at least one for each without a pair, that have nulls for b and iou. Rows are dealt over
    `parts` partitions, or the session's number.

    Boxes meet in the cells that they cover, so that a large image is spread over tasks; a pair that shares several
    cells counts in the first of them."""
    right = b.select(*[F.col(c).alias(c if c == key else f"{c}_b") for c in b.columns])
    right = _in_cells(right, ("y1_b", "x1_b", "y2_b", "x2_b"), "_cy", "_cx")
    own = _in_cells(a, BOX, "_cy", "_cx", left)
    if parts:
        own, right = (df.repartition(parts, key, "_cy", "_cx") for df in (own, right))
    first = (F.col("_cy") == F.floor(F.greatest("y1", "y1_b") / CELL)) & (F.col("_cx") == F.floor(F.greatest("x1", "x1_b") / CELL))
    touch = (F.col("y1") < F.col("y2_b")) & (F.col("y1_b") < F.col("y2")) & (F.col("x1") < F.col("x2_b")) & (F.col("x1_b") < F.col("x2"))
    iou = B.iou(B.box(), B.box(suffix="_b"))
    if left:
        right = right.withColumnsRenamed({key: "_key", "_cy": "_cy_b", "_cx": "_cx_b"})
        on = (F.col(key) == F.col("_key")) & (F.col("_cy") == F.col("_cy_b")) & (F.col("_cx") == F.col("_cx_b")) & first & touch & (iou > least)
        on = on & (F.col("class_id") == F.col("class_id_b")) if same_class else on
        return own.join(right, on, "left").withColumn("iou", F.when(F.col("_key").isNotNull(), iou)).drop("_key", "_cy", "_cx", "_cy_b", "_cx_b")
    met = own.join(right, [key, "_cy", "_cx"])
    met = met.filter(first).drop("_cy", "_cx")
    if same_class:
        met = met.filter("class_id = class_id_b")
    return met.filter(touch).withColumn("iou", iou).filter(F.col("iou") > least)


def top(df: DataFrame, keys: list[str], k: int, score: str = "score", tie: str = "box") -> DataFrame:
    """The k best rows of each group."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def suppress(df: DataFrame, keys: list[str], threshold: float, cap: int | None = None, tie: str = "box") -> DataFrame:
    """Greedy non-maximum suppression in each group: boxes by falling score (ties by id), each kept unless a kept one
    overlaps it by more than the threshold and HAIR. Groups of at most FOLD boxes are folded as sorted arrays inside the JVM; larger
    ones, if there are any, are solved in rounds over their overlaps. cap bounds the boxes of a group."""
    threshold += HAIR
    if cap:
        df = top(df, keys, cap, tie=tie).drop("rank")
    df = df.select(*keys, tie, "score", *BOX)
    large = df.groupBy(*keys).count().filter(F.col("count") > FOLD).select(*keys)
    if not large.limit(1).count():
        return _folded(df, keys, threshold, tie)
    large = checkpointed(large)
    small = _folded(df.join(large, keys, "left_anti"), keys, threshold, tie)
    return small.unionByName(_in_rounds(df.join(large, keys, "left_semi"), keys, threshold, tie))


def _folded(df: DataFrame, keys: list[str], threshold: float, tie: str) -> DataFrame:
    item = F.struct((-F.col("score")).alias("s"), F.col(tie).alias("id"), *BOX)
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("sorted"))

    def kept(acc, x):
        a = tuple(x[c] for c in BOX)
        hit = F.exists(acc, lambda y: B.iou(a, tuple(y[c] for c in BOX)) > threshold)
        return F.when(hit, acc).otherwise(F.concat(acc, F.array(x)))

    empty = F.slice(F.col("sorted"), 1, 0)
    return grouped.select(*keys, F.explode(F.aggregate("sorted", empty, kept)).alias("x")).select(
        *keys, F.col("x.id").alias(tie), (-F.col("x.s")).alias("score"), *[F.col(f"x.{c}").alias(c) for c in BOX]
    )


def _in_rounds(df: DataFrame, keys: list[str], threshold: float, tie: str) -> DataFrame:
    """A box without a better one among its neighbours is settled, and its neighbours fall; what is left goes on. Only pairs
    that overlap by more than the threshold are rows."""
    df = checkpointed(df)
    own = df.select(F.struct(*keys).alias("image"), F.col(tie).alias("id"), "score", *BOX)
    pairs = overlaps(own, own, least=threshold).filter("score > score_b or (score = score_b and id < id_b)")
    pairs = checkpointed(pairs.select("image", F.col("id").alias("a"), F.col("id_b").alias("b")))
    fallen = []
    while pairs.limit(1).count():
        settled = checkpointed(pairs.select("image", "a").distinct().join(pairs.select("image", F.col("b").alias("a")), ["image", "a"], "left_anti"))
        gone = checkpointed(pairs.join(settled, ["image", "a"], "left_semi").select("image", "b").distinct())
        fallen.append(gone)
        pairs = pairs.join(settled, ["image", "a"], "left_anti").join(gone, ["image", "b"], "left_anti")
        pairs = checkpointed(pairs.join(gone.withColumnRenamed("b", "a"), ["image", "a"], "left_anti"))
    for gone in fallen:
        df = df.join(gone.select(*[F.col(f"image.{k}").alias(k) for k in keys], F.col("b").alias(tie)), [*keys, tie], "left_anti")
    return df


def refine(df: DataFrame, confidence: float = 0.3, threshold: float = 0.3, limit: int = 200) -> DataFrame:
    """Detections of an image: foreground, confident, not empty, suppressed by class, the best `limit`."""
    good = df.filter((F.col("class_id") > 0) & (F.col("score") >= confidence) & (B.area(B.box()) > 0))
    return top(suppress(good, ["image", "class_id"], threshold), ["image"], limit)


def match(pred: DataFrame, pairs: DataFrame, thresholds: tuple[float, ...] = (0.5,)) -> DataFrame:
    """image, threshold, box, score, gt: predictions by falling score each take the best free ground truth with at least
    the overlap; gt is null without one. pairs (image, box, gt_b, iou) are the overlaps of equal classes, of boxes
    (`overlaps`) or of masks (`mask_overlaps`); they are made once for all thresholds. Images of at most FOLD predictions
    are folded, larger ones, if there are any, are solved in rounds."""
    pairs = pairs.filter(F.col("iou") >= min(thresholds))
    large = pred.groupBy("image").count().filter(F.col("count") > FOLD).select("image")
    if not large.limit(1).count():
        return _matched_folded(pred, pairs, thresholds)
    large = checkpointed(large)
    small = _matched_folded(pred.join(large, "image", "left_anti"), pairs.join(large, "image", "left_anti"), thresholds)
    return small.unionByName(_matched_in_rounds(pred.join(large, "image", "left_semi"), pairs.join(large, "image", "left_semi"), thresholds))


def _matched_folded(pred: DataFrame, pairs: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    offers = pairs.groupBy("image", "box").agg(F.array_sort(F.collect_list(F.struct((-F.col("iou")).alias("s"), F.col("gt_b").alias("gt")))).alias("offers"))
    item = F.struct((-F.col("score")).alias("s"), F.col("box").alias("id"), F.coalesce("offers", F.expr("CAST(array() AS array<struct<s:double,gt:int>>)")).alias("offers"))
    lists = pred.join(offers, ["image", "box"], "left").groupBy("image").agg(F.array_sort(F.collect_list(item)).alias("preds"))

    def take(acc, p):
        free = F.filter(p["offers"], lambda o: (-o["s"] >= F.col("threshold")) & ~F.array_contains(acc, o["gt"]))
        return F.concat(acc, F.array(F.coalesce(F.get(free, F.lit(0))["gt"], F.lit(-1))))

    lists = lists.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    taken = lists.withColumn("taken", F.aggregate("preds", F.expr("CAST(array() AS array<int>)"), take))
    rows = taken.select("image", "threshold", F.explode(F.arrays_zip("preds", "taken")).alias("z"))
    gt_of = F.col("z.taken")
    return rows.select("image", "threshold", F.col("z.preds.id").alias("box"), (-F.col("z.preds.s")).alias("score"), F.when(gt_of >= 0, gt_of).alias("gt"))


def _matched_in_rounds(pred: DataFrame, pairs: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """A prediction takes the best ground truth that is free once no better prediction may want that one: it stays free,
    and stays the best, until the prediction's turn."""
    pred = checkpointed(pred.select("image", "box", "score"))
    key = ["image", "threshold"]
    offers = pairs.join(pred, ["image", "box"]).withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).filter("iou >= threshold")
    offers = checkpointed(offers.select(*key, "box", "score", F.col("gt_b").alias("gt"), "iou"))
    taken = None
    while offers.limit(1).count():
        wish = offers.groupBy(*key, "box").agg(F.max(F.struct("iou", (-F.col("gt")).alias("less"))).alias("best")).select(*key, "box", (-F.col("best.less")).cast("int").alias("gt"))
        first = offers.groupBy(*key, "gt").agg(F.max(F.struct("score", (-F.col("box")).alias("less"))).alias("best")).select(*key, (-F.col("best.less")).cast("int").alias("box"), "gt")
        won = checkpointed(wish.join(first, [*key, "box", "gt"]))
        taken = won if taken is None else taken.unionByName(won)
        offers = checkpointed(offers.join(won.select(*key, "box"), [*key, "box"], "left_anti").join(won.select(*key, "gt"), [*key, "gt"], "left_anti"))
    every = pred.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    met = every.withColumn("gt", F.lit(None).cast("int")) if taken is None else every.join(taken, [*key, "box"], "left")
    return met.select(*key, "box", "score", "gt")


def mask_overlaps(pred: DataFrame, gt: DataFrame) -> DataFrame:
    """image, box, gt_b, iou of masks in long form: pred has image, box, class_id and a pixel (r, c) a row, gt the same
    with gt. Masks meet by pixel; only classes that agree."""
    left, right = pred.select("image", "class_id", "r", "c", "box"), gt.select("image", "class_id", "r", "c", F.col("gt").alias("gt_b"))
    shared = left.join(right, ["image", "class_id", "r", "c"]).groupBy("image", "box", "gt_b").agg(F.count(F.lit(1)).alias("k"))
    n_a = pred.groupBy("image", "box").agg(F.count(F.lit(1)).alias("n_a"))
    n_b = gt.groupBy("image", F.col("gt").alias("gt_b")).agg(F.count(F.lit(1)).alias("n_b"))
    met = shared.join(n_a, ["image", "box"]).join(n_b, ["image", "gt_b"])
    return met.select("image", "box", "gt_b", (F.col("k") / (F.col("n_a") + F.col("n_b") - F.col("k"))).alias("iou"))


def average_precision(matched: DataFrame, n_gt: DataFrame, keys: list[str]) -> DataFrame:
    """ap of each group of n_gt from ranked hits: precision made non-increasing from the right, summed over recall
    steps. A group without predictions has 0."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("box"))
    hit = F.col("gt").isNotNull().cast("int")
    curve = n_gt.join(matched, keys, "left").withColumn("hits", F.sum(hit).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("rank", F.row_number().over(w))
    curve = curve.withColumn("precision", F.col("hits") / F.col("rank")).withColumn("hit", hit)
    right = Window.partitionBy(*keys).orderBy("rank").rowsBetween(0, Window.unboundedFollowing)
    curve = curve.withColumn("envelope", F.max("precision").over(right))
    return curve.groupBy(*keys).agg((F.sum(F.when(F.col("hit") == 1, F.col("envelope")).otherwise(0.0)) / F.max("n_gt")).alias("ap"))


def ranked(pred: DataFrame) -> DataFrame:
    """pred with rank, from 1, among the predictions of its image by falling score (ties by box)."""
    return pred.withColumn("rank", F.row_number().over(Window.partitionBy("image").orderBy(F.desc("score"), "box")))


def mean_average_precision(pred: DataFrame, pairs: DataFrame, n_gt: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """image, ap of each image of n_gt: the mean over the thresholds of average_precision by image and threshold. pairs are
    those of `match` with the rank of `ranked`; where they and n_gt are dealt by image they are not dealt again.

    Images of at most FOLD predictions are folded: a precision falls behind each hit until the next, so hits and their ranks
    among all predictions are enough, and thresholds above an image's largest overlap have no hit. Larger images go by rows."""
    pairs = pairs.filter(F.col("iou") >= min(thresholds))
    large = pred.groupBy("image").count().filter(F.col("count") > FOLD).select("image")
    if not large.limit(1).count():
        return _mean_folded(pairs, n_gt, thresholds)
    large = checkpointed(large)
    small = _mean_folded(pairs.join(large, "image", "left_anti"), n_gt.join(large, "image", "left_anti"), thresholds)
    pred, pairs, n_gt = (df.join(large, "image", "left_semi") for df in (pred, pairs.select("image", "box", "gt_b", "iou"), n_gt))
    n_gt = n_gt.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    every = average_precision(_matched_in_rounds(pred, pairs, thresholds), n_gt, ["image", "threshold"])
    return small.unionByName(every.groupBy("image").agg(F.avg("ap").alias("ap")))


def _mean_folded(pairs: DataFrame, n_gt: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    offers = pairs.groupBy("image", "rank").agg(F.array_sort(F.collect_list(F.struct((-F.col("iou")).alias("s"), F.col("gt_b").alias("gt")))).alias("offers"))
    lists = offers.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("rank", "offers"))).alias("preds"))

    def at(threshold):
        """The sum over the hits of the largest precision from there on."""
        def take(acc, p):
            free = F.filter(p["offers"], lambda o: (-o["s"] >= threshold) & ~F.array_contains(acc["gts"], o["gt"]))
            hit = F.get(free, F.lit(0))["gt"]
            precision = (F.size(acc["gts"]) + 1) / p["rank"]
            return F.when(hit.isNull(), acc).otherwise(F.struct(F.concat(acc["gts"], F.array(hit)).alias("gts"), F.concat(F.array(precision), acc["precisions"]).alias("precisions")))

        none = F.expr("named_struct('gts', CAST(array() AS array<int>), 'precisions', CAST(array() AS array<double>))")
        hits = F.aggregate("preds", none, take, lambda acc: acc["precisions"])
        zero = F.struct(F.lit(0.0).alias("most"), F.expr("CAST(array() AS array<double>)").alias("every"))
        more = lambda acc, p: F.struct(F.greatest(acc["most"], p).alias("most"), F.concat(F.array(F.greatest(acc["most"], p)), acc["every"]).alias("every"))
        return F.aggregate(F.aggregate(hits, zero, more, lambda acc: acc["every"]), F.lit(0.0), lambda a, x: a + x)  # by rank

    best = -F.array_min(F.transform("preds", lambda p: p["offers"][0]["s"]))
    used = F.filter(F.array(*map(F.lit, thresholds)), lambda t: t <= F.col("best"))
    sums = lists.withColumn("best", best).select("image", F.transform(used, at).alias("sums"))
    total = F.aggregate("sums", F.lit(0.0), lambda a, x: a + x / F.col("n_gt"))
    return n_gt.join(sums, "image", "left").select("image", (F.coalesce(total, F.lit(0.0)) / len(thresholds)).alias("ap"))


def best_match(a: DataFrame, b: DataFrame, id_a: str, id_b: str) -> DataFrame:
    """For each row of a the row of b with the largest overlap (ties: the smaller id)."""
    w = Window.partitionBy("image", id_a).orderBy(F.desc("iou"), F.asc(f"{id_b}_b"))
    return overlaps(a, b).withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")


def without_padding(df: DataFrame, numbers: list[str]) -> DataFrame:
    """The rows that have a number other than 0."""
    some = F.lit(False)
    for c in numbers:
        some = some | (F.col(c) != 0)
    return df.filter(some)


def balanced(df: DataFrame, total: int, positives: int, order) -> DataFrame:
    """Targets (image, box, target 1, 0 or -1) of which an image keeps at most `positives` of 1 and fills up to `total`
    with -1, the first in the order; all others become 0."""
    w = Window.partitionBy("image", "target").orderBy(order, "box")
    found = F.least(F.sum((F.col("target") == 1).cast("int")).over(Window.partitionBy("image")), F.lit(positives))
    room = F.when(F.col("target") == 1, F.lit(positives)).otherwise(total - found)
    ranked = df.withColumn("k", F.row_number().over(w)).withColumn("room", room)
    return ranked.withColumn("target", F.when(F.col("k") <= F.col("room"), F.col("target")).otherwise(0)).drop("k", "room")


def targets(proposals: DataFrame, gt: DataFrame, total: int, share: float, order, least: float = 0.5, crowd: float = 0.001) -> DataFrame:
    """image, box, positive, class_id, gt: the proposals of an image to train on. Positive are those that overlap a ground
    truth by `least`; negative the others that no crowd covers. At most `share` of `total` are positive, and there are as
    many negatives as keep that share. Deltas and masks of the positives come from their gt."""
    o = overlaps(proposals, gt)
    real = F.col("class_id_b") > 0
    item = F.struct("iou", (-F.col("gt_b")).alias("g"), F.col("class_id_b").alias("c"))
    found = o.groupBy("image", "box").agg(F.max(F.when(real, item)).alias("best"), F.max(F.when(F.col("class_id_b") < 0, F.col("iou"))).alias("crowd"))
    j = proposals.select("image", "box").join(found, ["image", "box"], "left").withColumn("positive", F.coalesce(F.col("best.iou"), F.lit(0.0)) >= least)
    j = j.filter(F.col("positive") | (F.coalesce("crowd", F.lit(0.0)) < crowd))
    most = int(total * share) or 1
    many = F.least(F.sum(F.col("positive").cast("int")).over(Window.partitionBy("image")), F.lit(most))
    j = j.withColumn("n", F.row_number().over(Window.partitionBy("image", "positive").orderBy(order, "box"))).withColumn("many", many)
    j = j.filter(F.when(F.col("positive"), F.col("n") <= most).otherwise(F.col("n") <= F.round(F.col("many") / share).cast("int") - F.col("many")))
    return j.select("image", "box", "positive", F.when(F.col("positive"), F.col("best.c")).otherwise(0).alias("class_id"), F.when(F.col("positive"), -F.col("best.g")).cast("int").alias("gt"))


def proposals(anchors: DataFrame, deltas: tuple, window: tuple, before: int = 6000, after: int = 1000, threshold: float = 0.7) -> DataFrame:
    """The `before` best anchors of each image, moved by deltas (columns, in deviations), clipped to the window and
    suppressed; the `after` best of what stays, with rank."""
    best = top(anchors.withColumns({f"d{k}": d for k, d in enumerate(deltas)}), ["image"], before).drop("rank")
    moved = B.clip(B.apply_deltas(B.box(), tuple(F.col(f"d{k}") * s for k, s in enumerate(DEVIATIONS))), window)
    shifted = best.select("image", "box", "score", *[v.alias(c) for v, c in zip(moved, BOX)])
    return top(suppress(shifted, ["image"], threshold), ["image"], after)
