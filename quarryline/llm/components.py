"""Connected components over written tables: least labels of neighbours with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def merge(scratch: common.Scratch, labels: DataFrame, edges: DataFrame, tag: str) -> DataFrame:
    """labels (doc, comp) after merging the components that edges (a, b) join; a component is named by its least doc.

    Edges become edges of components, of which few are left; their least labels spread along the edges, and each label
    jumps to its own label, one job a turn."""
    la, lb = labels.select(F.col("doc").alias("a"), F.col("comp").alias("ca")), labels.select(F.col("doc").alias("b"), F.col("comp").alias("cb"))
    one = edges.join(la, "a").join(lb, "b").filter("ca != cb").select("ca", "cb")
    both = scratch.write(one.unionByName(one.select(F.col("cb").alias("ca"), F.col("ca").alias("cb"))).distinct(), f"edges-{tag}")
    state = scratch.write(both.groupBy("ca").agg(F.min("cb").alias("cb")).select("ca", F.least("ca", "cb").alias("to"), F.lit(True).alias("moved")), f"state-{tag}-0")
    turn = 0
    while state.filter("moved").limit(1).count():
        turn += 1
        around = both.join(state.select(F.col("ca").alias("cb"), F.col("to").alias("near")), "cb").groupBy("ca").agg(F.min("near").alias("near"))
        far = state.select(F.col("ca").alias("to"), F.col("to").alias("far"))
        least = F.least("to", "near", "far")
        state = scratch.write(state.select("ca", "to").join(around, "ca").join(far, "to").select("ca", least.alias("to"), (least != F.col("to")).alias("moved")), f"state-{tag}-{turn}")
    if not turn:
        return labels
    known = state.select(F.col("ca").alias("comp"), "to")
    return scratch.write(labels.join(known, "comp", "left").select("doc", F.coalesce("to", "comp").alias("comp")), f"labels-{tag}")
