"""Session helpers shared by tests, bench and operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarryline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows that go to Python at once where the session leaves it to Spark: texts and tiles are large, and a batch is held
#: by the JVM and by Python.
BATCH = 256
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers can import it, and keep the
    batches that they get small."""
    sc = spark.sparkContext
    if spark.conf.get(ROWS) == "10000":
        spark.conf.set(ROWS, str(BATCH))
    if getattr(sc, "_quarryline_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quarryline-")
    target = os.path.join(folder, "quarryline.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    sc.addPyFile(target)
    sc._quarryline_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the parquet tables below sf_dir."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the session's partitions: a table of small rows is one file split, yet much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of a table's files for each partition of by_size.
SHARE = 4 << 20


def by_size(df: DataFrame) -> int:
    """Partitions for the rows of files: the session's number, or one for each SHARE bytes where these are more, so that what
    a task holds does not grow with the table."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    size = sum(path(f).getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path(f)).getLen() for f in df.inputFiles())
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE))
