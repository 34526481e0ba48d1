"""Shared pieces: the shared folder, written tables, word rules and a distributed prefix sum."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

_owned: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all machines share. Where it is unset (tests), a temporary
    folder, so only a local master may leave it unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(sc, "_quarryline_dir"):
        sc._quarryline_dir = "file://" + tempfile.mkdtemp(prefix="quarryline-shared-")
    return sc._quarryline_dir


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark reaches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder; what is written there is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/quarryline/{kind}-{uuid.uuid4().hex}"
    owned = _owned.setdefault(spark.sparkContext.applicationId, [])
    if not owned:
        atexit.register(_clean, spark, owned)
    owned.append(path)
    return path


def _clean(spark: SparkSession, owned: list[str]) -> None:
    for path in owned:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may have ended already
            return


#: Spark's own switch: shuffle files of a query go when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of MBs: those that a parquet reader or an Arrow batch holds at once, and those of a file, as a writer looks at the
#: size of its buffers for the first time after a hundred rows.
READ, BATCH = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"
LARGE = 4


class Scratch:
    """Tables written in the shared folder to cut lineage. drop() deletes those that are not needed any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str, large: bool = False, rows: int = 0) -> DataFrame:
        """`large`: the rows that are read have MBs each, so few are held at once; `rows`: how many a file has at most."""
        path = new_folder(self.spark, name)
        wanted = {CLEANUP: "true"} | ({READ: str(LARGE), BATCH: str(LARGE)} if large else {})
        before = {key: self.spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            self.spark.conf.set(key, value)
        try:
            df.write.option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.paths.pop(name))


def strip_space(text: Column) -> Column:
    """The text without any white space of the contracts; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def normal_words(text: Column) -> Column:
    """The words of the text with one space between them; null counts as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "))


def n_words(text: Column) -> Column:
    """Number of words of the contracts as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def running_sum(scratch: Scratch, df: DataFrame, keys: list[Column], values, outs, partitions: int) -> DataFrame:
    """df with the sums of the long columns values over all earlier rows in the order of keys, as the columns outs.

    Range partitions hold neighbouring rows, so a key that a third of all rows share is spread as soon as the keys
    differ in a later column. The sums of the partitions are one row for each partition; their offsets come from that
    small table. Rows that tie in all keys get their sums in any order."""
    from pyspark.sql import Window

    values, outs = ([values], [outs]) if isinstance(values, str) else (values, outs)
    pid = free_name(df, "_pid")
    own = [free_name(df, f"_own{i}") for i in range(len(values))]
    kept = scratch.write(df.repartitionByRange(partitions, *keys).withColumn(pid, F.spark_partition_id()), f"ranged-{outs[0]}")
    sums = kept.groupBy(pid).agg(*[F.sum(v).alias(o) for v, o in zip(values, own)]).collect()  # one row per partition
    offsets, total = [], [0] * len(values)
    for row in sorted(sums, key=lambda r: r[0]):
        offsets.append((row[0], *total))
        total = [t + (s or 0) for t, s in zip(total, row[1:])]
    side = df.sparkSession.createDataFrame(offsets or [(0, *total)], ", ".join([f"{pid} int", *[f"{o} long" for o in own]]))
    w = Window.partitionBy(pid).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    met = kept.join(F.broadcast(side), pid)
    for v, o, b in zip(values, outs, own):
        met = met.withColumn(o, F.col(b) + F.coalesce(F.sum(v).over(w), F.lit(0)))
    return met.drop(pid, *own)
