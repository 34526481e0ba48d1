"""Size-tiered compaction of immutable shards under a versioned manifest.

A store is a folder: data/ holds shard files that are never changed, manifest/ one file for each version. append()
writes arrivals as small shards. compact() takes the live shards of each size tier, merges them into files near the
target size and commits a version that lists them in place of their inputs. A version becomes visible in one step, by a
name that must not exist yet: a hard link on local disks and mounts, a rename elsewhere. So a reader sees all of a commit
or none and, on these and on HDFS, two writers can't both commit the same version. Object stores check first and rename
then; there only one writer may work at a time. Files of tasks that fail or of writers that lose are never listed.

Merging is one narrow job per tier and run: the scan planner packs whole small files into partitions of the target
size (largest first, so similar sizes meet), and each partition writes one file. No row is shuffled.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

TARGET = 64 << 20
FANOUT = 4  # sizes within a factor of this are one tier
MIN_RUN = 4
ARRIVAL_ROWS = 2000


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int
    level: int  # merges behind it
    version: int  # that added it


class CommitConflict(Exception):
    """Another writer has committed this version."""


class Store:
    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, fanout: int = FANOUT, min_run: int = MIN_RUN):
        self.spark, self.root, self.target, self.fanout, self.min_run = spark, root.rstrip("/"), target, fanout, min_run
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/manifest"))

    # Manifest.
    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifest"))]
        return max([0, *(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))])

    def _manifest(self, version: int) -> dict:
        if not version:
            return {"schema": None, "shards": []}
        at = self._path(f"{self.root}/manifest/v{version:012d}.json")
        if not self._fs.exists(at):
            raise LookupError(f"version {version} does not exist or was vacuumed")
        stream = self._fs.open(at)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def shards(self, version: int | None = None) -> list[Shard]:
        return [Shard(**s) for s in self._manifest(self.version() if version is None else version)["shards"]]

    def _commit(self, base: int, schema: str | None, shards: list[Shard]) -> int:
        """Make shards the version after base, or raise CommitConflict. The manifest is written whole under a name that
        no reader looks at; the step to the final name fails if that name exists."""
        if self.version() > base:  # whose names vacuum() may have taken away
            raise CommitConflict(f"version {base + 1} exists")
        text = json.dumps({"schema": schema, "shards": [asdict(s) for s in shards]})
        temporary = self._path(f"{self.root}/manifest/.{uuid.uuid4().hex}")
        final = self._path(f"{self.root}/manifest/v{base + 1:012d}.json")
        out = self._fs.create(temporary, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(*(self._fs.makeQualified(at).toUri().getPath() for at in (temporary, final)))
                self._fs.delete(temporary, False)
            else:
                self._rename(temporary, final)
        except Exception as error:
            self._fs.delete(temporary, False)
            if isinstance(error, FileExistsError) or "FileAlreadyExists" in str(error) or "exists" in str(error):
                raise CommitConflict(f"version {base + 1} exists") from error
            raise
        return base + 1

    def _rename(self, temporary, final) -> None:
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri() if temporary.toUri().getScheme() else self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        context.rename(temporary, final, none)

    def _written(self, df: DataFrame, level: int, version: int, **options) -> list[Shard]:
        """Write df as new files and list those that the writer's own commit has kept."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.options(compression="zstd", **options).parquet(folder)
        found = [s for s in self._fs.listStatus(self._path(folder)) if s.getPath().getName().startswith("part-")]
        found.sort(key=lambda s: s.getPath().getName())
        return [Shard(s.getPath().toString(), s.getLen(), level, version) for s in found]

    # Writers.
    def append(self, df: DataFrame, rows: int = ARRIVAL_ROWS) -> int:
        """Add the rows of df as shards of at most that many rows."""
        while True:
            base = self.version()
            new = self._written(df, 0, base + 1, maxRecordsPerFile=rows)
            while True:
                old = self._manifest(base)
                schema = df.schema.json()
                if old["schema"] not in (None, schema):
                    raise ValueError("the rows have other columns than the store")
                try:
                    return self._commit(base, schema, [Shard(**s) for s in old["shards"]] + new)
                except CommitConflict:  # an append goes with any other commit
                    base = self.version()

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """The runs to merge: the shards of one tier, oldest first, cut where a run has reached 64 target sizes. A
        tier with fewer than min_run shards waits for more, unless it fills a target."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes <= self.target // 2:
                tiers.setdefault(int(math.log(max(s.bytes, 1), self.fanout)), []).append(s)
        runs = []
        for tier in sorted(tiers):
            run, size = [], 0
            for s in sorted(tiers[tier], key=lambda s: (s.version, s.path)):
                run.append(s)
                size += s.bytes
                if size >= 64 * self.target:
                    runs.append(run)
                    run, size = [], 0
            if len(run) >= self.min_run or size >= self.target:
                runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self) -> int:
        """Merge until no tier has a run, and return the newest version. Inputs stay on disk for readers of older
        versions until vacuum()."""
        while True:
            base = self.version()
            manifest = self._manifest(base)
            shards = [Shard(**s) for s in manifest["shards"]]
            runs = self.plan(shards)
            if not runs:
                return base
            gone, new = set(), []
            session = self.spark.newSession()  # the packing of files is set for the merge alone
            session.conf.set("spark.sql.files.maxPartitionBytes", str(self.target))
            session.conf.set("spark.sql.files.openCostInBytes", "0")
            session.conf.set("spark.sql.files.minPartitionNum", "1")
            for run in runs:
                level = 1 + max(s.level for s in run)
                df = session.read.schema(_schema(manifest["schema"])).parquet(*[s.path for s in run])
                new += self._written(df, level, base + 1)
                gone |= {s.path for s in run}
            left = [s for s in shards if s.path not in gone]
            if len(left) + len(new) >= len(shards):  # nothing more can be packed into fewer files
                for s in new:
                    self._fs.delete(self._path(s.path), False)
                return base
            while True:
                try:
                    self._commit(base, manifest["schema"], left + new)
                    break
                except CommitConflict:
                    # Appends in between add shards; if the inputs are all live still, the merge holds.
                    base = self.version()
                    now = self.shards(base)
                    if not gone <= {s.path for s in now}:
                        break
                    left = [s for s in now if s.path not in gone]

    def vacuum(self, keep: int = 1) -> None:
        """Delete the files that none of the last keep versions lists, and the manifests of older versions. Call it only
        when no writer is at work."""
        newest = self.version()
        live = {s.path for v in range(max(1, newest - keep + 1), newest + 1) for s in self.shards(v)}
        for folder in self._fs.listStatus(self._path(f"{self.root}/data")):
            for s in self._fs.listStatus(folder.getPath()):
                if s.getPath().getName().startswith("part-") and s.getPath().toString() not in live:
                    self._fs.delete(s.getPath(), False)
        for s in self._fs.listStatus(self._path(f"{self.root}/manifest")):
            name = s.getPath().getName()
            if name.startswith("v") and int(name[1:-5]) <= newest - keep:
                self._fs.delete(s.getPath(), False)

    # Readers.
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; a store without shards of rows gives an empty table of its columns."""
        manifest = self._manifest(self.version() if version is None else version)
        schema = _schema(manifest["schema"])
        paths = [s["path"] for s in manifest["shards"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def _schema(text: str | None):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text)) if text else StructType([])


def compacted(df: DataFrame, root: str | None = None, target: int = TARGET) -> Store:
    """Append the rows of df to a store (a new one without root) and compact it. Rows may repeat, columns may be null
    or have any name that Parquet takes; an empty df makes a version without rows."""
    store = Store(df.sparkSession, root or common.new_folder(df.sparkSession, "shards"), target)
    store.append(df)
    store.compact()
    store.vacuum()
    return store


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """Each document as the newest version holds it after compaction; a null text has null n_chars and text_sha256."""
    rows = compacted(spark.read.parquet(f"{sf_dir}/documents.parquet")).read()
    return rows.select("doc_id", "lang", "source", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


SQL = "SELECT doc_id, lang, source, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256 FROM documents"
