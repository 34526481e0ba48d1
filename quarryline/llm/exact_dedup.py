"""Exact dedup by skew-safe combining, in DataFrame functions only.

Rows are combined within their task first (the partial aggregate), then in salted groups, then the winners of the
salts are combined globally. Each of the three steps groups by the digest and the whole normalised text, so two texts
are one group only if they are equal, whatever their digests. Texts thus move only once per task and distinct text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SALTS = 8
_TWO64 = "18446744073709551616"


def _rank(chars: Column, doc_id: Column) -> Column:
    """chars and doc_id in one decimal that a hash aggregate can keep in place: more code points win, then the smaller
    doc_id; a null doc_id comes last."""
    last = F.lit("9223372036854775808").cast("decimal(20,0)") - doc_id.cast("decimal(20,0)")
    return (
        chars.cast("decimal(10,0)") * F.lit(_TWO64).cast("decimal(20,0)") + F.coalesce(last, F.lit(0).cast("decimal(20,0)"))
    ).cast("decimal(38,0)")


def _winner(rank: Column) -> Column:
    low = rank % F.lit(_TWO64).cast("decimal(38,0)")
    return F.when(low > 0, (F.lit("9223372036854775808").cast("decimal(38,0)") - low).cast("long"))


def _base(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = common.strip_space(F.col(text_col))
    base = df.select(F.col(id_col).alias("doc_id"), norm.alias("norm"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"))
    return base.select("doc_id", "norm", "chars", F.unhex(F.sha2("norm", 256)).alias("digest"), F.xxhash64("norm").alias("check"))


def _groups(base: DataFrame, salts: int) -> DataFrame:
    """digest, check, keep_id, n for each distinct text."""
    salted = (
        base.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("salt", "digest", "check", "norm")
        .agg(F.max(_rank(F.col("chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    )
    whole = salted.groupBy("digest", "check", "norm").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    return whole.select("digest", "check", _winner(F.col("best")).alias("keep_id"), "n")


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty. Of equal texts (white space deleted) the row with the most code points, then the
    smallest id stays; a null id comes last, its rows have keep_id null if it wins, and kept is then true for it.
    Rows that repeat an id and a text all count in group_size, and each of them is kept if their id is. An empty
    table gives no rows; other columns of df are not read."""
    base = _base(df, id_col, text_col)
    groups = _groups(base, salts).select("digest", "check", "keep_id", F.col("n").alias("group_size"))
    # The digest with a second, independent hash leads each row to its group; only a few bytes a row move, and the
    # join is one that adaptive execution can split when a third of all rows share a digest.
    return base.select("doc_id", "digest", "check").join(groups, ["digest", "check"]).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that stay, with all their columns. Rows that repeat both the id and the normalised text of a
    row that stays are equal to it for this operator, and one of them stays."""
    scratch = common.Scratch(df.sparkSession)
    groups = _groups(_base(df, id_col, text_col), SALTS).select("keep_id", "digest")
    winners = scratch.write(groups, "winners")
    wid, wdigest, digest, n = (common.free_name(df, x) for x in ("_w_id", "_w_digest", "_digest", "_nth"))
    winners = winners.select(F.col("keep_id").alias(wid), F.col("digest").alias(wdigest))
    own = df.withColumn(digest, F.unhex(F.sha2(common.strip_space(F.col(text_col)), 256)))
    met = own.join(winners, F.col(id_col).eqNullSafe(F.col(wid)) & (F.col(digest) == F.col(wdigest)), "left_semi")
    if not df.groupBy(id_col).count().filter("count > 1").limit(1).count():
        return met.select(*df.columns)
    # Some id occurs more than once. Each task keeps its first row of a key before rows move.
    sortable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    order = [F.length(F.coalesce(F.col(text_col), F.lit(""))).desc(), *[F.col(c) for c in sortable]]
    numbered = met.withColumn(n, F.row_number().over(Window.partitionBy(id_col, digest).orderBy(*order)))
    return numbered.filter(F.col(n) == 1).select(*df.columns)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return annotate(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id ASC NULLS LAST) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM g
"""
