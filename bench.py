"""Time the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from quarryline.plans.queries import QUERIES
from quarryline.session import local_session

HEADLINE = (
    "polygon_area_perimeter", "tile_filter_number", "histogram_equalise", "otsu_threshold", "close_pairs", "deduplicate", "clean_points",
    "clean_rectangles", "iou_pairs", "suppression", "greedy_match", "average_precision", "anchor_targets", "recall", "stitch_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    seconds = {}
    QUERIES["top_detections"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM's code paths
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
