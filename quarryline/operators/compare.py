"""Comparison of two layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted, with the side in front."""
    first = one.exceptAll(two).select(F.lit("only first").alias("side"), "*")
    return first.unionByName(two.exceptAll(one).select(F.lit("only second").alias("side"), "*"))


def same(one: DataFrame, two: DataFrame, repeats: bool = True) -> bool:
    """Equal as multisets, or as sets without repeats."""
    if not repeats:
        one, two = one.distinct(), two.distinct()
    return difference(one, two).limit(1).count() == 0
