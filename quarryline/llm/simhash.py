"""SimHash near-dedup: fingerprints of word shingles, linked by searches in BK-trees.

A bit of a fingerprint is 1 if it is set in more than half of the XXH64 hashes of the text's shingles. Two fingerprints
that differ in at most `radius` bits agree in all but `radius` of any number of blocks of bits, so each choice of the
blocks that agree gives a shard by their values. The number of blocks goes with the number of fingerprints, so that
shards stay small. A shard's fingerprints become BK-trees: a child hangs on the edge of its Hamming distance to its
parent, and a search goes down the edges within the radius of the distance to the node alone.

The tree of a small shard is built and searched in one task. A shard of more than TREE fingerprints gets several trees,
each of bounded size; they are broadcast to the shard's fingerprints where all trees together are within a bound that is
checked, and copied to the parts of the shard otherwise. Of what a search finds, a spanning forest leaves the task, so
that a crowd of close fingerprints does not write all its pairs; trees and forests lose no component.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, components
from . import textkernel as tk
from ..session import ship

WORDS = 3
RADIUS = 3
BITS = 64
SEED = 42
#: Fingerprints of a tree at most, and of a shard on average before blocks become more.
TREE, SHARD = 4096, 16
#: Bytes of all trees of large shards up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
#: Shingles hashed at once, and searches that walk a tree at once.
SHINGLES, SEARCHES = 1 << 16, 512
_EDGE = "a long, b long"
_TREE = "shard long, piece int, fps binary, parents binary"


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The fingerprint of a text: only A-Z are lower-cased; fewer words than a shingle's are one shingle; none give 0."""
    from xxhash import xxh64_intdigest

    own = (text or b"").lower().split()
    if not own:
        return 0
    if len(own) < words:
        return xxh64_intdigest(b" ".join(own), SEED)
    every = len(own) - words + 1
    hashes = map(xxh64_intdigest, map(b" ".join, zip(*(own[k:] for k in range(words)))), itertools.repeat(SEED))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, every, SHINGLES):
        part = np.fromiter(itertools.islice(hashes, SHINGLES), "<u8", min(SHINGLES, every - at))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > every, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id and the fingerprint, a long of the same bits, of each row."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    own = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return own.mapInArrow(tk.resting(run), f"doc_id {dict(own.dtypes)['doc_id']}, fp long")


class Forest:
    """BK-trees over fingerprints, one for each group of equal `group`; every fingerprint is a node, its place its number."""

    def __init__(self, fps: np.ndarray, parents: np.ndarray, roots: np.ndarray):
        self.fps, self.parents, self.roots = fps, parents, roots
        inner = np.flatnonzero(parents >= 0)
        edges = np.bitwise_count(fps[inner] ^ fps[parents[inner]]).astype(np.int64)
        keys = parents[inner] * (BITS + 1) + edges
        order = np.argsort(keys, kind="stable")
        #: Children in the order of their parent and edge, and that order's keys.
        self.children, self.keys = inner[order], keys[order]

    @classmethod
    def build(cls, fps: np.ndarray, group: np.ndarray) -> Forest:
        """Level by level: those that wait below a node fall into groups by their distance to it, and the first of each
        group becomes the node's child on that edge."""
        parents = np.full(len(fps), -1, np.int64)
        _, first, own = np.unique(group, return_index=True, return_inverse=True)
        roots, below = first[own], first[own]
        waiting = np.flatnonzero(below != np.arange(len(fps)))
        while len(waiting):
            at = below[waiting]
            key = at * (BITS + 1) + np.bitwise_count(fps[waiting] ^ fps[at])
            _, first, own = np.unique(key, return_index=True, return_inverse=True)
            child = waiting[first]
            parents[child] = at[first]
            below[waiting] = child[own]
            waiting = waiting[child[own] != waiting]
        return cls(fps, parents, roots)

    def within(self, asked: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of searches and nodes within the radius of them."""
        for start in range(0, len(asked), SEARCHES):
            who = np.arange(start, min(start + SEARCHES, len(asked)))
            node = roots[who]
            while len(who):
                far = np.bitwise_count(asked[who] ^ self.fps[node]).astype(np.int64)
                hit = far <= radius
                if hit.any():
                    yield who[hit], node[hit]
                low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(far - radius, 0))
                n = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(far + radius, BITS), "right") - low
                total = np.cumsum(n)
                step = np.arange(total[-1]) - np.repeat(total - n, n)
                who, node = np.repeat(who, n), self.children[np.repeat(low, n) + step]


class Union:
    """Components of the numbers below n; joined in bulk."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _forest_edges(fps: np.ndarray, union: Union) -> pa.RecordBatch:
    away = np.flatnonzero(fps[union.label] != fps)
    signed = fps.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[away]), pa.array(signed[union.label[away]])], names=["a", "b"])


def _by_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(group numbers, fingerprints) of whole shards, of batches that are sorted by all columns before the last."""
    held: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        table = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if table is None or not table.num_rows:
            continue
        keys = [c.to_numpy() for c in table.columns[:-1]]
        new = np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]
        end = table.num_rows if batch is None else int(np.flatnonzero(new)[-1])
        held = table.slice(end)
        if end:
            yield table.slice(0, end), np.cumsum(new[:end]) - 1


def _search_small(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _by_shard(batches):
            fps = table.column("fp").to_numpy().view(np.uint64)
            forest, union = Forest.build(fps, group), Union(len(fps))
            for who, node in forest.within(fps, forest.roots, radius):
                union.join(who, node)
            yield _forest_edges(fps, union)

    return run


def _trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree of each piece of a large shard; also its fingerprints, for the searches."""
    for table, group in _by_shard(batches):
        fps = table.column("fp").to_numpy().view(np.uint64)
        for at in np.split(np.arange(len(fps)), np.flatnonzero(np.diff(group)) + 1):
            tree = Forest.build(fps[at], np.zeros(len(at), np.int64))
            row = [table.column("shard")[at[0]].as_py()], [table.column("piece")[at[0]].as_py()], [tree.fps.tobytes()], [tree.parents.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["shard", "piece", "fps", "parents"])


def _search_large(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nodes, parents, asked in zip(*(batch.column(c) for c in ("fps", "parents", "asked"))):
                own, more = (np.frombuffer(x.as_buffer(), np.uint64) for x in (nodes, asked))
                forest = Forest(own, np.frombuffer(parents.as_buffer(), np.int64), np.zeros(0, np.int64))
                union = Union(len(own) + len(more))
                for who, node in forest.within(more, np.zeros(len(more), np.int64), radius):
                    union.join(node, who + len(own))
                yield _forest_edges(np.concatenate([own, more]), union)

    return run


def masks(n: int, radius: int = RADIUS, bits: int = BITS, shard: int = SHARD) -> list[int]:
    """The bits that have to agree, for each choice of blocks: the fewest blocks whose kept bits tell n fingerprints
    apart into shards of `shard` on average."""
    need = math.log2(max(n, 2) / shard)
    blocks = radius + 1
    while bits * (blocks - radius) / blocks < need and blocks < bits:
        blocks += 1
    ends = [bits * k // blocks for k in range(blocks + 1)]
    part = [(1 << hi) - (1 << lo) for lo, hi in zip(ends, ends[1:])]
    return [sum(part[k] for k in kept) for kept in itertools.combinations(range(blocks), blocks - radius)]


def links(scratch: common.Scratch, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: edges between the distinct fingerprints of prints (fp) whose components are those of all links."""
    spark = scratch.spark
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks(prints.count(), radius)]
    shard = F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)]))
    dealt = prints.select(shard.alias("shard"), "fp")
    sizes = scratch.write(dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")
    members = scratch.write(dealt.join(sizes, "shard"), "members")
    small = members.filter(F.col("n") <= TREE).select("shard", "fp").repartition(parts, "shard").sortWithinPartitions("shard")
    edges = small.mapInArrow(tk.resting(_search_small(radius)), _EDGE)
    large = members.filter(F.col("n") > TREE)
    if not large.limit(1).count():
        return edges
    piece = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / TREE)).cast("int")
    pieces = large.select("shard", piece.alias("piece"), "fp").repartition(parts, "shard", "piece").sortWithinPartitions("shard", "piece")
    trees = scratch.write(pieces.mapInArrow(tk.resting(_trees), _TREE), "trees")
    asked = trees.select("shard", F.col("piece").alias("part"), F.col("fps").alias("asked"))
    size = trees.agg(F.sum(F.length("fps") + F.length("parents"))).first()[0]
    if size <= BROADCAST_BYTES:
        met = asked.repartition(parts, "shard", "part").join(F.broadcast(trees), "shard")
    else:  # every part of a shard gets a copy of each of its trees
        copied = trees.join(asked.select("shard", "part"), "shard")
        met = asked.join(copied, ["shard", "part"])
    met = met.filter("part <= piece").select("fps", "parents", "asked")
    return edges.unionByName(met.mapInArrow(tk.resting(_search_large(radius)), _EDGE))


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of df: doc_id, fingerprint (16 hexadecimal digits), component_id.

    A null text counts as empty; texts without words have fingerprint 0, which links like any other. Rows that repeat
    an id count each. A row with a null id has its component, whose id is the smallest of ids that are not null, or null
    where there is none. An empty table gives no rows; other columns are not read."""
    scratch = common.Scratch(df.sparkSession)
    own = scratch.write(fingerprints(df, id_col, text_col, words), "fingerprints")
    prints = scratch.write(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    edges = scratch.write(links(scratch, prints.select("fp"), radius), "links")
    labels = components.merge(scratch, prints.select(F.col("fp").alias("doc"), F.col("fp").alias("comp")), edges, "fp")
    named = prints.join(labels, prints.fp == labels.doc).select("fp", "comp", "least")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = scratch.write(named.select("fp", "comp").join(least, "comp").select("fp", "component_id"), "components")
    return own.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df whose id is the smallest of their component, with all their columns; rows with a null id stay where
    no row of their component has an id."""
    kid = common.free_name(df, "_kept_id")
    own = annotate(df, id_col, text_col)
    kept = own.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(kid)).distinct()
    first = df.join(kept, F.col(id_col) == F.col(kid), "left_semi")
    nameless = df.filter(F.col(id_col).isNull())
    if not nameless.limit(1).count():
        return first
    alone = own.filter("component_id is null").select("fingerprint").distinct().withColumnRenamed("fingerprint", kid)
    text = common.free_name(df, "_text")
    cast = nameless.withColumn(text, F.col(text_col))
    ship(df.sparkSession)
    prints = F.pandas_udf(lambda s: s.map(lambda t: f"{fingerprint(None if t is None else t.encode()):016x}"), "string")
    return first.unionByName(cast.withColumn(text, prints(text)).join(alone, F.col(text) == F.col(kid), "left_semi").select(*df.columns))


def op12_simhash(spark, sf_dir: str) -> DataFrame:
    return annotate(spark.read.parquet(f"{sf_dir}/documents.parquet"))
