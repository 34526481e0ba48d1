import re

from pyspark.sql import functions as F

import corpus_pipeline as pipeline


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_stages_one_after_the_other(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        seen[name] = (docs.collect(), spark.read.parquet(str(tmp_path / str(k))).collect())
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
    # Each filter only drops rows, and drops what it is for.
    for name in ("quality classifier", "exact dedup", "MinHash near-dedup"):
        before, after = seen[name]
        assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len(after) == len({r.doc_id for r in after})
    before, after = seen["exact dedup"]
    assert sorted({norm(r.text) for r in before}) == sorted(norm(r.text) for r in after)
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r.doc_id for r in seen["quality classifier"][1]}
    clean = [i for i, q in marks.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    mixed, packed = seen["packing"]
    assert sum(r.start == 0 for r in packed) == len(mixed)
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_stages_on_odd_rows_and_no_rows(spark, odd, none, small):
    """Nulls in every column, empty and long texts, repeated rows, columns with names that the stages use themselves."""
    clash = lambda df: df.withColumn("score", F.lit(1)).withColumn("_nth", F.lit("n")).withColumn("_size", F.lit(None).cast("int")).withColumn("_kept_id", F.lit(3)).withColumn("class_id", F.lit("c"))
    for docs in (clash(odd), clash(none)):
        rows = docs.collect()
        for name, stage in pipeline.STAGES[:4]:
            out = stage(spark, docs, small)
            assert out.columns == docs.columns, name
            found = out.collect()
            assert set(map(str, found)) <= set(map(str, rows)), name
            assert rows or not found, name
        packed = pipeline.STAGES[4][1](spark, docs, small).collect()
        assert sum(r.start == 0 for r in packed) == len(rows)


def test_near_copies_without_an_id(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base), (2, base.replace("w3 ", "x3 ")), (None, base + "  "), (None, "other words that nobody else has at all"), (None, None), (3, "")]
    kept = pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in spark.createDataFrame([rows[0], *rows[3:]], "doc_id long, text string").collect())


def test_exact_copies_with_a_map_column(spark):
    rows = [(1, "a b", {"x": 1}), (1, "ab", {"y": 2}), (1, "a b", {"z": 3}), (2, "ab", None), (None, "c", None), (None, "c ", {})]
    kept = pipeline.drop_exact_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>"), "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, "a b"), (None, "c ")], key=str)
