"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node, with its smallest ids; more than k + 1 of them can never be among k results. NN-descent
starts from random neighbours; each round joins every node's neighbour lists (forward and a bounded set of reverse
ones) with the vectors, compares the members of a list that contains something new, and keeps the nearest of each
node. Queries walk the finished graph: in each round the nearest unexpanded nodes of a query's beam are joined with
their neighbours. Vectors travel in the width they come in, scaled by a power of two, and are compared as cosines in
double precision, so that groups of near copies keep their order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from ..session import ship

DEGREE = 24
REVERSE = 24
ROUNDS = 12
STOP = 0.003  # share of graph entries that a round must change to go on
BEAM = 256
EXPAND = 32
STEPS = 16
ENTRIES = 16
ROUNDING = 1e-12  # above the error of a cosine in double precision


def nodes(scratch: common.Scratch, df: DataFrame, id_col: str, vec_col: str, k: int, divisor: int) -> DataFrame:
    """node (dense from 0), ids (the k + 1 smallest), queries (ids to answer), vec. Rows whose id is
    null or whose vector is null, zero, holds a null or non-finite component or has another length than most take no
    part; rows that repeat an id and a vector count once."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(some, F.lit(False)))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("v") == (usual[0] if usual else 0)).distinct()
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("at") <= k + 1)
    asked = rows.filter(F.col("id") % divisor == 0).select(F.col("id").alias("query"), "v")
    members = first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    ranked = common.running_sum(
        scratch, members.withColumn("one", F.lit(1).cast("long")).withColumn("low", F.element_at("ids", 1)), [F.col("low"), F.col("ids"), F.col("v")], "one", "node", parts
    )
    out = scratch.write(ranked.select("node", "ids", "v"), "nodes")
    # Queries are matched to their nodes by the vector itself.
    return out, scratch.write(asked.join(out.select("node", "v"), "v").select("query", "node", "v"), "queries")


def _width(df: DataFrame, vec_col: str) -> type:
    """Floats travel as floats, all else as doubles."""
    kind = df.schema[vec_col].dataType
    return np.float32 if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else np.float64


def _scaled(m: np.ndarray) -> np.ndarray:
    """A power of two scales each vector, so that squares neither overflow nor vanish."""
    return np.ldexp(m, -np.frexp(np.abs(m).max(axis=1))[1][:, None])


def _units(df: DataFrame, width: type) -> DataFrame:
    """node and its scaled vector in bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _scaled(np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1)).astype(width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in m], pa.binary())], names=["node", "unit"])

    return df.select("node", "v").mapInArrow(run, "node long, unit binary")


def _directions(units: list[bytes], width: type) -> np.ndarray:
    m = np.frombuffer(b"".join(units), width).reshape(len(units), -1).astype(np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _compare(width: type):
    """Each row is a list of members (node, new, least similarity kept, unit); out come the pairs with a new member
    that would enter a member's neighbours, the best DEGREE of each node in a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst, sim = [], [], []
            lists = batch.column(0)
            for k in range(batch.num_rows):
                m = lists[k].values
                node = np.asarray(m.field("dst"))
                if len(node) < 2:
                    continue
                fresh = np.asarray(m.field("new")).astype(bool)
                least = np.asarray(m.field("least"))
                unit = _directions(m.field("unit").to_pylist(), width)
                s = unit @ unit.T
                good = (fresh[:, None] | fresh[None, :]) & (s > least[:, None])
                np.fill_diagonal(good, False)
                i, j = np.nonzero(good)
                src.append(node[i])
                dst.append(node[j])
                sim.append(s[i, j])
            if not src:
                continue
            a, b, s = np.concatenate(src), np.concatenate(dst), np.concatenate(sim)
            order = np.lexsort((b, -s, a))
            a, b, s = a[order], b[order], s[order]
            fresh = np.ones(len(a), bool)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            a, b, s = a[fresh], b[fresh], s[fresh]
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            nth = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
            near = nth < DEGREE
            yield pa.RecordBatch.from_arrays([pa.array(a[near]), pa.array(b[near]), pa.array(s[near])], names=["src", "dst", "sim"])

    return run


def _nearest(df: DataFrame, key: str, n: int, *order) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("at", at).filter(F.col("at") <= n).drop("at")


def graph(scratch: common.Scratch, units: DataFrame, n: int, width: type, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """src, dst: the neighbours of each node after NN-descent."""
    spark = scratch.spark
    start = units.select(F.col("node").alias("src"), F.explode(F.sequence(F.lit(1), F.lit(degree))).alias("j"))
    start = start.select("src", F.pmod(F.xxhash64("src", "j"), F.lit(n)).alias("dst")).filter("src != dst").distinct()
    g = scratch.write(start.select("src", "dst", F.lit(-2.0).alias("sim"), F.lit(True).alias("new")), "graph-0")
    turn = 0
    while turn < rounds:
        turn += 1
        reverse = _nearest(g.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "new"), "src", REVERSE, F.desc("new"), F.xxhash64("dst", "src", F.lit(turn)))
        lists = g.select("src", "dst", "new").unionByName(reverse).groupBy("src", "dst").agg(F.max("new").alias("new"))
        least = g.groupBy(F.col("src").alias("node")).agg(F.when(F.count(F.lit(1)) >= degree, F.min("sim")).otherwise(-2.0).alias("least"))
        known = units.join(least, "node", "left").select(F.col("node").alias("dst"), F.coalesce("least", F.lit(-2.0)).alias("least"), "unit")
        met = lists.join(known, "dst").groupBy("src").agg(F.collect_list(F.struct("dst", "new", "least", "unit")).alias("members"), F.max("new").alias("new"))
        found = met.filter("new").select("members").mapInArrow(_compare(width), "src long, dst long, sim double")
        both = g.select("src", "dst", "sim", F.lit(False).alias("new")).unionByName(found.withColumn("new", F.lit(True)))
        merged = both.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
        # An old entry without a similarity stands for itself until it is compared.
        g = scratch.write(_nearest(merged, "src", degree, F.desc("sim"), F.asc("dst")), f"graph-{turn}")
        scratch.drop(f"graph-{turn - 1}")
        changed = g.filter("new").count()
        if changed <= STOP * degree * n:
            break
    return g.select("src", "dst")


def _cosines(keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.asarray(batch.column(len(keep)).flatten()).reshape(batch.num_rows, -1)
            b = np.asarray(batch.column(len(keep) + 1).flatten()).reshape(batch.num_rows, -1)
            a, b = _scaled(a), _scaled(b)
            score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score)], names=[*keep, "score"])

    return run


def _scored(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    met = pairs.join(vectors.select("node", F.col("v").alias("nv")), "node").join(queries.select("query", F.col("v").alias("qv")), "query")
    return met.select("query", "node", "qv", "nv").mapInArrow(_cosines(["query", "node"]), "query long, node long, score double")


def _near(width: type):
    """Each row is a query, its unit and the nodes to score."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, node, score = [], [], []
            ids, own, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for k, q in enumerate(ids):
                m = lists[k].values
                query.append(np.full(len(m), q))
                node.append(np.asarray(m.field("node")))
                score.append(_directions(m.field("unit").to_pylist(), width) @ _directions([own[k]], width)[0])
            if query:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (query, node, score)], names=["query", "node", "score"])

    return run


def _estimated(pairs: DataFrame, queries: DataFrame, units: DataFrame, width: type) -> DataFrame:
    """Scores for the walk. A query has at most EXPAND * (DEGREE + REVERSE) pairs in a step."""
    lists = pairs.join(units, "node").groupBy("query").agg(F.collect_list(F.struct("node", "unit")).alias("nodes"))
    met = lists.join(queries.select("query", F.col("unit").alias("own")), "query").select("query", "own", "nodes")
    return met.mapInArrow(_near(width), "query long, node long, score double")


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, divisor: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query (an id that divisor divides), or all
    candidates if fewer. Ties go to the smaller id; an empty table or one vector gives no rows."""
    spark = df.sparkSession
    ship(spark)
    scratch = common.Scratch(spark)
    vectors, queries = nodes(scratch, df, id_col, vec_col, k, divisor)
    n = vectors.count()
    width = _width(df, vec_col)
    units = scratch.write(_units(vectors, width), "units")
    asked = scratch.write(queries.select("query", "node").join(units, "node"), "asked")
    edges = scratch.write(graph(scratch, units, max(n, 1), width), "edges") if n > 1 else spark.createDataFrame([], "src long, dst long")
    back = _nearest(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), "src", REVERSE, F.xxhash64("dst"))
    walk = scratch.write(edges.unionByName(back).distinct(), "walk")
    own = queries.select("query", "node")
    random = queries.select("query", F.explode(F.sequence(F.lit(1), F.lit(ENTRIES))).alias("j")).select("query", F.pmod(F.xxhash64("query", "j"), F.lit(max(n, 1))).alias("node"))
    beam = scratch.write(_estimated(own.unionByName(random).distinct(), asked, units, width).withColumn("open", F.lit(True)), "beam-0")
    for step in range(1, STEPS + 1):
        front = _nearest(beam.filter("open"), "query", EXPAND, F.desc("score"), F.asc("node")).select("query", "node")
        reached = front.join(walk, front.node == walk.src).select("query", F.col("dst").alias("node")).distinct()
        fresh = reached.join(beam.select("query", "node"), ["query", "node"], "left_anti")
        closed = beam.join(front.withColumn("hit", F.lit(True)), ["query", "node"], "left").select("query", "node", "score", (F.col("open") & F.col("hit").isNull()).alias("open"))
        grown = closed.unionByName(_estimated(fresh, asked, units, width).withColumn("open", F.lit(True)))
        beam = scratch.write(_nearest(grown, "query", BEAM, F.desc("score"), F.asc("node")), f"beam-{step}")
        scratch.drop(f"beam-{step - 1}")
        if not beam.filter("open").limit(1).count():
            break
    # Of the beam, all that rounding could bring among the nearest are scored anew; k + 1 nodes hold k other ids.
    ranked = beam.withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc("node"))))
    ranked = ranked.withColumn("last", F.min(F.when(F.col("at") <= k + 1, F.col("score"))).over(Window.partitionBy("query")))
    best = scratch.write(_scored(ranked.filter(F.col("score") >= F.col("last") - ROUNDING).select("query", "node"), queries, vectors), "best")
    hits = best.join(vectors.select("node", "ids"), "node")
    hits = hits.select(F.col("query").alias("query_id"), F.explode("ids").alias("vec_id"), "score").filter("query_id != vec_id")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return hits.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_nn_descent(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
