"""Mixing sources to target weights by entropy balancing.

The rate of a document of source s and size x is min(3, exp(lambda_s * x)): of all rates up to 3 whose sizes meet the
source's target, the ones with the least relative entropy to taking each document once. The lambdas solve the convex
dual; each step, Newton's or else the middle of a bracket that holds the root, is one aggregate over the table of (source,
size, documents), and steps go on until every source is met as well as rates can. Rates are fixed-point numbers, so sums are exact and reruns agree. Systematic rounding in the order (source, size, id) turns
rates into copies; what is left of a source's difference is then closed with a few single documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

CYCLE = (5, 2, 1)
LIMIT = 3
ONE = 1 << 20  # fixed point of the rates
FIXES = 12
#: Rows of sources that are broadcast at most (a few MB), and the parts of a source beyond.
BROADCAST_ROWS, SALTS = 50_000, 32


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def targets(scratch: common.Scratch, sizes: DataFrame, cycle=CYCLE, limit: int = LIMIT) -> DataFrame:
    """sid, source, source_size, mean (of sizes by word), target for each source. Sources stay distributed: only sums
    over them reach the driver."""
    own = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size").cast("double") * F.col("size")).alias("squares")
    ).withColumn("one", F.lit(1).cast("long"))
    ranked = common.running_sum(scratch, own, [F.col("source").asc_nulls_last()], "one", "sid", 8)
    weights = F.array(*[F.lit(float(x)) for x in cycle])
    ranked = scratch.write(
        ranked.select(
            "sid", "source", "source_size", (F.col("squares") / F.greatest("source_size", F.lit(1))).alias("mean"),
            F.element_at(weights, (F.pmod("sid", F.lit(len(cycle))) + 1).cast("int")).alias("weight"),
        ),
        "sources",
    )
    cap = F.col("source_size") * F.lit(float(limit))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, met = 0.0, -1
    while True:
        full = (F.col("weight") * F.lit(level) >= cap) if met >= 0 else F.lit(False)
        spent, open_weight, n = ranked.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum(full.cast("long"))
        ).first()
        if met == (n or 0) or not open_weight:
            break
        met, level = n or 0, (total - (spent or 0)) / open_weight
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _rate(lam: Column, size: Column, mean: Column, limit: int) -> Column:
    """The fixed-point rate; lam is null where every document is at the limit."""
    tilt = F.least(F.lit(math.log(limit)), lam * size / mean)
    return F.when(lam.isNull(), F.lit(limit * ONE)).otherwise(F.round(F.exp(tilt) * ONE)).cast("long")


def _middle(lo: Column, hi: Column) -> Column:
    """The middle on a scale that is linear around 0 and logarithmic beyond."""
    flat = lambda x: F.signum(x) * F.log1p(F.abs(x))
    mid = (flat(lo) + flat(hi)) / 2
    mid = F.signum(mid) * F.expm1(F.abs(mid))
    return F.when((mid > lo) & (mid < hi), mid).otherwise((lo + hi) / 2)


def by_source(rows: DataFrame, side: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """rows with the columns of side, which has a few rows for each source. Rows are not dealt by source, as one may hold
    a third of them: a side of a checked size goes to all tasks, a larger one is copied to SALTS parts of each source."""
    keys = keys or ["sid"]
    if side.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(side), keys)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    return salted.join(side.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [*keys, "salt"]).drop("salt")


def solve(scratch: common.Scratch, sizes: DataFrame, sources: DataFrame, limit: int = LIMIT) -> DataFrame:
    """sources with lam for each, by guarded Newton steps over the histogram of sizes. A source that is not met at the
    end is an error."""
    cells = scratch.write(sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "cells")
    shortest = cells.groupBy(F.col("source").alias("s_source")).agg(F.min("size").alias("shortest"))
    unit = F.col("mean") / F.col("shortest")
    # Every rate is 0 at lo and the limit at hi.
    state = sources.join(shortest, _same(F.col("source"), F.col("s_source")), "left").select(
        *sources.columns, (unit * -30).alias("lo"), (unit * 2 * math.log(limit)).alias("hi"),
        (F.col("target") >= limit * F.col("source_size")).alias("full"), F.lit(True).alias("halved"), F.lit(None).cast("double").alias("last"),
    )
    first = F.log(F.greatest(F.col("target") / F.greatest("source_size", F.lit(1)), F.lit(1e-12)))
    state = scratch.write(state.withColumn("lam", F.when(~F.col("full"), first)), "state-0")
    keep = sources.columns
    step = 0
    while True:
        step += 1
        s = state.filter("not full").select(F.col("source").alias("s_source"), "lam", "mean")
        c = cells.join(s, _same(F.col("source"), F.col("s_source")))
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), limit)
        words = rate.cast("decimal(20,0)") * (F.col("size") * F.col("docs")).cast("decimal(18,0)")
        slope = F.when(rate < limit * ONE, rate * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = c.groupBy("s_source").agg(
            F.sum(words).alias("words"), F.sum(F.round(slope).cast("decimal(20,0)") * (F.col("size") * F.col("docs")).cast("decimal(18,0)")).alias("slope")
        )
        old = state.join(sums, _same(F.col("source"), F.col("s_source")), "left")
        gap = F.coalesce(F.col("words").cast("double") / ONE, F.lit(0.0)) - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.col("gap") / (F.nullif(F.col("slope").cast("double"), F.lit(0.0)) / ONE)
        # Newton's step is taken after a halving of the bracket and for as long as it halves the gap.
        works = F.col("halved") | (F.abs("gap") <= F.col("last") / 2)
        inside = F.coalesce(works & (newton > F.col("new_lo")) & (newton < F.col("new_hi")), F.lit(False))
        # In a bracket this narrow no rate moves by more than one of its fixed-point steps.
        narrow = F.col("new_hi") - F.col("new_lo") <= F.greatest(F.abs("new_lo"), F.abs("new_hi")) * 2.0**-28
        near = F.col("full") | (F.abs("gap") <= 1e-6 * F.col("target") + 0.5)
        new = old.withColumn("gap", gap).withColumn("new_lo", lo).withColumn("new_hi", hi).withColumn("near", near).withColumn("inside", inside)
        new = new.withColumn("closed", F.coalesce(narrow, F.lit(False))).withColumn(
            "new_lam", F.when(F.col("near") | F.col("closed"), F.col("lam")).when(F.col("inside"), newton).otherwise(_middle(F.col("new_lo"), F.col("new_hi")))
        )
        state = scratch.write(
            new.select(
                *keep, F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), "full", (~F.col("inside")).alias("halved"), F.abs("gap").alias("last"),
                F.col("new_lam").alias("lam"), (F.col("near") | F.col("closed")).alias("done"), "near",
            ),
            f"state-{step}",
        )
        if not state.filter("not done").limit(1).count():
            break
        state = state.drop("done", "near")
    missed = state.filter(~F.col("near") & (F.col("last") > 1e-6 * F.col("target") + 0.5 + F.col("source_size") * (4.0 / ONE))).first()
    if missed is not None:
        raise RuntimeError(f"source {missed['source']!r} misses its target of {missed['target']:.0f} words by {missed['last']:.0f}")
    return state.select(*keep, "lam")


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", limit: int = LIMIT) -> DataFrame:
    """One row per row of df: doc_id, size, source_size, target, taken, copies.

    Null texts have size 0 and get no copies; a null source is a source of its own, the last. Rows that repeat an id
    count each. A table without words takes nothing; an empty one gives no rows. Other columns are not read."""
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    sizes = scratch.write(
        df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), common.n_words(F.col(text_col)).alias("size")), "sizes"
    )
    sources = scratch.write(solve(scratch, sizes, targets(scratch, sizes, limit=limit), limit), "targets")
    s = sources.select("sid", F.col("source").alias("s_source"), "lam", "mean", "source_size", "target")
    named = scratch.write(s.withColumn("source_key", F.xxhash64("s_source")), "named")
    rated = by_source(sizes.withColumn("source_key", F.xxhash64("source")), named, ["source_key"]).filter(_same(F.col("source"), F.col("s_source"))).select(
        "doc_id", "sid", "size", F.when(F.col("size") > 0, _rate(F.col("lam"), F.col("size"), F.col("mean"), limit)).otherwise(0).cast("long").alias("rate")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("sid"), F.col("size"), F.col("doc_id")]
    summed = common.running_sum(scratch, rated.withColumn("one", F.lit(1).cast("long")), keys, ["rate", "one"], ["before", "nth"], parts)
    half = F.lit(ONE // 2)
    step = F.floor((F.col("before") + F.col("rate") + half) / ONE) - F.floor((F.col("before") + half) / ONE)
    rows = scratch.write(summed.select("doc_id", "sid", "size", "nth", step.cast("long").alias("copies")), "rounded")
    # At most FIXES documents of each source change by one copy: each time one of the largest size that fits the
    # difference. Which sizes these are comes from the histogram of (source, size, copies).
    cells = scratch.write(rows.filter("size > 0").groupBy("sid", "size", "copies").agg(F.count(F.lit(1)).alias("n")), "histogram")
    took = cells.groupBy("sid").agg(F.sum(F.col("size") * F.col("copies") * F.col("n")).alias("took"))
    gaps = scratch.write(sources.join(took, "sid", "left").select("sid", (F.round("target") - F.coalesce("took", F.lit(0))).cast("long").alias("gap")), "gap-0")
    for turn in range(FIXES):
        fits = (F.col("n") > 0) & (F.col("size") <= F.abs("gap")) & F.when(F.col("gap") > 0, F.col("copies") < limit).otherwise(F.col("copies") > 0)
        best = by_source(cells, gaps.filter("gap <> 0")).filter(fits).groupBy("sid").agg(F.max(F.struct("size", "copies")).alias("best"))
        now = gaps.join(best, "sid", "left").select("sid", "gap", "best.size", F.col("best.copies").alias("copies"), F.signum("gap").cast("long").alias("by"))
        now = scratch.write(now, f"fixes-{turn}")
        picked = now.filter("size is not null").select("sid", "size", "copies", "by")
        if not picked.limit(1).count():
            break
        fixes = picked if not turn else fixes.unionByName(picked)
        used = picked.select("sid", "size", "copies", F.lit(1).alias("used"))
        cells = scratch.write(cells.join(used, ["sid", "size", "copies"], "left").select("sid", "size", "copies", (F.col("n") - F.coalesce("used", F.lit(0))).alias("n")), f"histogram-{turn + 1}")
        gaps = scratch.write(now.select("sid", (F.col("gap") - F.coalesce(F.col("size") * F.col("by"), F.lit(0))).alias("gap")), f"gap-{turn + 1}")
    final = rows
    if turn or picked.limit(1).count():
        # Of each cell the documents that come first; every task keeps but the first few before rows move.
        many = scratch.write(fixes.groupBy("sid", "size", "copies", "by").agg(F.count(F.lit(1)).alias("m")), "fixes")
        cell = Window.partitionBy("sid", "size", "copies", "by").orderBy("nth")
        first = by_source(rows, many, ["sid", "size", "copies"]).withColumn("k", F.row_number().over(cell)).filter((F.col("k") <= FIXES) & (F.col("k") <= F.col("m")))
        changed = scratch.write(first.select("nth", "by"), "changed")
        final = rows.join(changed, "nth", "left").withColumn("copies", F.col("copies") + F.coalesce("by", F.lit(0)))
    return by_source(final, sources.select("sid", "source_size", "target")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.col("copies").cast("int").alias("copies")
    )


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of df as often as the mix takes them, with all their columns. Rows that share an id and a size are
    told apart by nothing but that; their copies go to any of them, one by one."""
    size, nth = common.free_name(df, "_size"), common.free_name(df, "_nth")
    mid, msize, mnth, n = (common.free_name(df, x) for x in ("_m_id", "_m_size", "_m_nth", "_m_copies"))
    took = copies(df, id_col, text_col, source_col).filter("copies > 0 or size > 0")
    took = took.select(
        F.col("doc_id").alias(mid), F.col("size").alias(msize), F.col("copies").alias(n),
        F.row_number().over(Window.partitionBy("doc_id", "size").orderBy(F.col("copies").desc())).alias(mnth),
    ).filter(f"{n} > 0")
    own = df.withColumn(size, common.n_words(F.col(text_col)))
    repeated = own.groupBy(id_col, size).count().filter("count > 1").limit(1).count() > 0
    if repeated:  # only then do texts have to be sorted
        own = own.withColumn(nth, F.row_number().over(Window.partitionBy(id_col, size).orderBy(text_col, source_col)))
    else:
        own = own.withColumn(nth, F.lit(1))
    met = own.join(took, own[id_col].eqNullSafe(F.col(mid)) & (F.col(size) == F.col(msize)) & (F.col(nth) == F.col(mnth)))
    return met.withColumn(size, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*df.columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    return copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
