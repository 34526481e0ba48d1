"""Near-dedup by BagMinHash signatures of word-shingle multisets, bands and a check of the multisets.

Each shingle's count is a weight. The weights are discretised to whole numbers, and the axis of weights is cut into
blocks (0,1], (1,2], (2,4], (4,8] ... Each (shingle, block) has a Poisson process of points of its own, drawn from its
hash; a point has a time, a component of the signature and a place in its block. A text sees the points of the blocks
below its weight and, of the block that its weight cuts, those placed below. A component holds the least time seen, so
two texts agree in a component with the probability of their weighted Jaccard similarity. Points are drawn in the
order of time only until every component is filled, so a signature costs little more than a pass over the shingles.

Texts with the same words are one node. In each bucket (band and its values) all nodes are first compared with the least
one. Texts whose shingles are too often nobody else's are then known to have no further link. Buckets that still hold
several components are cut into tiles, and pairs of tiles are compared within a task, each pair of texts in the first
band it shares: no pair that shares a band stays unlinked, and only links leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, components
from . import textkernel as tk
from ..session import ship

WORDS = 5
SIMILARITY = 0.8
#: A pair at 0.8 shares no band with probability (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5
#: Ids that are broadcast at most (16 MB).
BROADCAST_IDS = 1 << 21
#: Texts of a tile on average.
TILE = 200
_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def shingles(texts: list, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts: text, hash and count of each distinct shingle; then words and the hash of all words of each text."""
    raw, starts = tk.joined(texts)
    unit, at, _ = tk.word_hashes(raw)
    doc = np.searchsorted(starts, at, side="right") - 1
    first = np.searchsorted(at, starts)
    n = np.diff(first)
    whole = tk.span_hash(unit, first[:-1], first[1:]) ^ tk.mix(n.astype(np.uint64))
    h = tk.window_hash(unit, words)
    inside = np.flatnonzero(doc[: len(h)] == doc[words - 1 :]) if len(h) else np.empty(0, np.int64)
    d, h = doc[inside], h[inside]
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])) if len(d) else np.empty(0, np.int64)
    return d[new], h[new], np.diff(np.append(new, len(d))), n, whole


def _uniform(seed: np.ndarray, k: np.ndarray, salt: int) -> np.ndarray:
    h = tk.mix(seed + k.astype(np.uint64) * _GOLDEN + _U(salt))
    return ((h >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, docs: int, size: int = BANDS * ROWS) -> np.ndarray:
    """docs x size least times; inf in rows of texts without shingles."""
    sig = np.full(docs * size, np.inf)
    levels = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    d, block = np.repeat(doc, levels), np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    seed = tk.mix(np.repeat(shingle, levels) + block.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
    low = np.where(block > 0, 2.0 ** (block - 1), 0.0)
    span = np.where(block > 0, low, 1.0)
    room = np.minimum(np.repeat(count, levels) - low, span)
    weight = np.bincount(doc, count, docs)
    until = np.divide(math.log(size) + 4, weight, out=np.zeros(docs), where=weight > 0)
    t, k = np.zeros(len(d)), np.zeros(len(d), np.int64)
    todo = np.arange(len(d))
    while len(todo):
        live = todo
        while len(live):
            many = int(np.clip((1 << 15) // len(live), 1, 512))
            ks = k[live][:, None] + np.arange(many)
            gap = -np.log(_uniform(seed[live][:, None], ks, 1)) / (size * span[live])[:, None]
            gap[:, 0] += t[live]
            when = np.cumsum(gap, axis=1)
            i, j = np.nonzero(when < until[d[live]][:, None])
            own, at = live[i], ks[i, j]
            seen = np.floor(_uniform(seed[own], at, 2) * span[own]) < room[own]
            own, at, times = own[seen], at[seen], when[i, j][seen]
            np.minimum.at(sig, d[own] * size + np.floor(_uniform(seed[own], at, 3) * size).astype(np.int64), times)
            t[live], k[live] = when[:, -1], k[live] + many
            live = live[when[:, -1] < until[d[live]]]
        # The few texts with an empty component go on: all their points up to twice the time are drawn again.
        short = (np.isinf(sig).reshape(docs, size).any(axis=1)) & (weight > 0)
        until = np.where(short, until * 2, 0.0)
        todo = np.flatnonzero(short[d])
        t[todo], k[todo] = 0.0, 0
    return sig.reshape(docs, size)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """docs x bands hashes of the bands' values."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, -1)
    h = np.full(bits.shape[:2], 0, np.uint64) + np.arange(bands, dtype=np.uint64)
    for r in range(bits.shape[2]):
        h = tk.mix(h * _GOLDEN + bits[:, :, r])
    return h.view(np.int64)


def _binary(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def sketches(df: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """doc, h1, h2 (of all words), words, keys (of the bands; null below `words` words)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in tk.slices(texts):
                d, h, c, n, whole = shingles(texts[lo:hi], words)
                keys = band_keys(signatures(d, h, c, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(whole.view(np.int64)), pa.array(tk.mix(whole + _GOLDEN * n.astype(np.uint64)).view(np.int64)),
                        pa.array(n, pa.int64()), pa.array([k if m >= words else None for k, m in zip(keys, n)], pa.list_(pa.int64())),
                    ],
                    names=["doc", "h1", "h2", "words", "keys"],
                )

    return _binary(df, id_col, text_col).mapInArrow(tk.resting(run), "doc long, h1 long, h2 long, words long, keys array<long>")


def _prints(docs: DataFrame, words: int) -> DataFrame:
    """doc and its multiset as sorted 32-bit prints of (shingle, occurrence); two texts of n shingles agree in
    n * n / 2**32 of them by chance, which moves a similarity by less than 0.0003 even at a million words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in tk.slices(texts):
                d, h, c, _, _ = shingles(texts[lo:hi], words)
                nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                own = np.repeat(d, c)
                p = (tk.mix(np.repeat(h, c) + nth.astype(np.uint64) * _GOLDEN) >> _U(32)).astype(np.uint32)
                p = p[np.lexsort((p, own))]
                at = np.searchsorted(own, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([p[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())], names=["doc", "prints"]
                )

    return docs.mapInArrow(tk.resting(run), "doc long, prints binary")


def _overlap(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b and their weighted Jaccard similarity from the prints."""
    for batch in batches:
        out = np.empty(batch.num_rows)
        x, y = batch.column(2), batch.column(3)
        for k in range(batch.num_rows):
            p, q = np.frombuffer(x[k].as_buffer(), np.uint32), np.frombuffer(y[k].as_buffer(), np.uint32)
            both = np.concatenate([p, q])
            both.sort(kind="stable")
            # Prints that a text holds twice by chance count as often as the rarer side has them, up to this.
            same = int((both[1:] == both[:-1]).sum())
            out[k] = same / max(1, len(both) - same)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["a", "b", "sim"])


def _verified(scratch, pairs: DataFrame, prints: DataFrame, least: float, tag: str) -> DataFrame:
    a, b = prints.select(F.col("doc").alias("a"), F.col("prints").alias("pa")), prints.select(F.col("doc").alias("b"), F.col("prints").alias("pb"))
    met = pairs.join(a, "a").join(b, "b").select("a", "b", "pa", "pb").mapInArrow(tk.resting(_overlap), "a long, b long, sim double")
    return scratch.write(met.filter(F.col("sim") >= least), f"links-{tag}")


def _linkable(live: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """live with known, the number of prints of each text that another text of live has too; texts that cannot reach
    the similarity with any size of partner are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                p = np.unique(np.frombuffer(batch.column(1)[k].as_buffer(), np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), batch.column(0)[k].as_py())), pa.array(p)], names=["doc", "print"])

    docs = live.select("doc").distinct()
    each = prints.join(docs, "doc", "left_semi").select("doc", "prints").mapInArrow(run, "doc long, print int")
    alone = each.groupBy("print").agg(F.min("doc").alias("doc"), F.max("doc").alias("hi")).filter("doc = hi").groupBy("doc").agg(F.count(F.lit(1)).alias("alone"))
    return live.join(alone, "doc", "left").withColumn("known", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone").filter(F.col("known") >= least * F.col("n"))


def _pairs_within(least: float):
    """Rows of one group after the other: group, band, doc, n, known, comp, tile, keys, prints; out come the links of
    texts of different components, and of different tiles if the group has two."""

    def links(t: pa.Table) -> tuple[list, list, list]:
        band, doc, n, known, comp, tile = (t.column(c).to_numpy() for c in ("band", "doc", "n", "known", "comp", "tile"))
        keys = np.asarray(t.column("keys").combine_chunks().flatten()).reshape(len(doc), -1)
        prints = [np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("prints")]
        two = tile.min() != tile.max()
        out: tuple[list, list, list] = ([], [], [])
        for i in range(len(doc)):
            j = np.arange(i + 1, len(doc))
            # What two texts have in common is at most what each has in common with any other one.
            most = np.minimum(known[j], known[i])
            ok = (comp[j] != comp[i]) & (most >= least * (n[i] + n[j] - most))
            if two:
                ok &= tile[j] != tile[i]
            j = j[ok]
            if len(j):
                j = j[(keys[j] == keys[i]).argmax(axis=1) == band[0]]
            for k in j.tolist():
                both = np.concatenate([prints[i], prints[k]])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                if same >= least * (len(both) - same):
                    for column, v in zip(out, (doc[i], doc[k], same / (len(both) - same))):
                        column.append(v)
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _then_none(batches):
            t = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if t is None or not t.num_rows:
                continue
            g = t.column("group").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            ends = np.append(cut[1:], len(g))
            if batch is not None:  # the last group may go on
                held, cut, ends = t.slice(cut[-1]), cut[:-1], ends[:-1]
            found: tuple[list, list, list] = ([], [], [])
            for lo, hi in zip(cut.tolist(), ends.tolist()):
                if hi - lo > 1:
                    for column, more in zip(found, links(t.slice(lo, hi - lo))):
                        column += more
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=["a", "b", "sim"])

    return run


def _then_none(items: Iterable) -> Iterator:
    yield from items
    yield None


def _tiled(scratch: common.Scratch, live: DataFrame, rows: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """a, b, sim: the links between components within the buckets of live."""
    docs = scratch.write(rows.select("doc", "keys").join(live.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"]).join(prints, "doc"), "texts")
    count = live.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    put = live.join(scratch.write(count.select("key", "tiles"), "tiles"), "key").withColumn("tile", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"))
    put = put.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    put = put.withColumn("group", F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other")))
    put = put.join(docs, "doc").select("group", "band", "doc", "n", "known", "comp", "tile", "keys", "prints")
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    return put.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(tk.resting(_pairs_within(least)), "a long, b long, sim double")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """One row per row of df: doc_id, class_id (the least id of its class), class_size, kept.

    A class is a connected component of the links of similarity `least` or more. Texts with the same words are one
    class; a text without words (or null) is a class of its own, and one with fewer than `words` words meets only equal
    ones. Rows that repeat an id are one document. A row with a null id gets the class of the equal texts with an id,
    or null and kept. An empty table gives no rows; other columns are not read."""
    spark = df.sparkSession
    ship(spark)
    scratch = common.Scratch(spark)
    own = scratch.write(sketches(df, id_col, text_col, words), "sketches")
    reps = scratch.write(
        own.filter("words > 0 and doc is not null").groupBy("h1", "h2").agg(F.min("doc").alias("rep"), F.max("words").alias("words")), "reps"
    )
    size = F.col("words") - (words - 1)
    rows = own.filter("keys is not null").join(reps.select(F.col("rep").alias("doc"), "h1", "h2"), ["doc", "h1", "h2"], "left_semi")
    keyed = rows.select("doc", size.alias("n"), F.posexplode("keys").alias("band", "key"))
    shared = scratch.write(keyed.groupBy("key").agg(F.min("doc").alias("lead"), F.max("doc").alias("hi")).filter("lead < hi").select("key", "lead"), "shared")
    members = scratch.write(keyed.join(shared, "key"), "members")
    labels = scratch.write(members.select("doc").distinct().select("doc", F.col("doc").alias("comp")), "labels")
    wanted = labels.select("doc")
    if wanted.count() <= BROADCAST_IDS:  # else both sides are dealt by id
        wanted = F.broadcast(wanted)
    prints = scratch.write(_prints(_binary(df, id_col, text_col).join(wanted, "doc", "left_semi"), words).dropDuplicates(["doc"]), "prints")
    # First every member of a bucket meets the least one.
    tested = scratch.write(members.filter("doc != lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct(), "pairs-0")
    labels = components.merge(scratch, labels, _verified(scratch, tested, prints, least, "0"), "0")
    live = members.drop("lead").join(labels, "doc")
    buckets = live.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    live = scratch.write(_linkable(scratch.write(live.join(buckets, "key", "left_semi"), "live"), prints, least), "linkable")
    labels = components.merge(scratch, labels, scratch.write(_tiled(scratch, live, rows, prints, least), "links-1"), "1")
    named = scratch.write(reps.join(labels, reps.rep == labels.doc, "left").select("h1", "h2", F.coalesce("comp", "rep").alias("comp")), "named")
    final = own.select("doc", "h1", "h2", "words").join(named, ["h1", "h2"], "left")
    final = scratch.write(final.select("doc", F.when(F.col("words") > 0, F.col("comp")).otherwise(F.col("doc")).alias("comp")), "final")
    sizes = scratch.write(final.groupBy("comp").agg(F.count(F.lit(1)).alias("class_size")), "sizes")
    return final.join(sizes.withColumnRenamed("comp", "c"), F.col("comp").eqNullSafe(F.col("c"))).select(
        F.col("doc").alias("doc_id"), F.col("comp").alias("class_id"), F.when(F.col("comp").isNull(), 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        (F.col("comp").isNull() | F.col("doc").eqNullSafe(F.col("comp"))).alias("kept"),
    )


def _hashed(df: DataFrame, text_col: str, h1: str, h2: str) -> DataFrame:
    """df with two hashes of its words, null for a text without words."""
    own = common.normal_words(F.col(text_col))
    has = F.length(own) > 0
    return df.withColumn(h1, F.when(has, F.xxhash64(own))).withColumn(h2, F.when(has, F.sha2(own, 256)))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df that are the first of their class, with all their columns; rows that repeat an id stay together.
    Of the rows with a null id, those go whose words equal those of a row with an id; the others stay, copies of each
    other too, as no class names them."""
    kid, h1, h2 = (common.free_name(df, x) for x in ("_kept_id", "_h1", "_h2"))
    kept = classes(df, id_col, text_col).filter("kept and doc_id is not null").select(F.col("doc_id").alias(kid)).distinct()
    first = df.join(kept, F.col(id_col) == F.col(kid), "left_semi")
    nameless = df.filter(F.col(id_col).isNull())
    if not nameless.limit(1).count():
        return first
    own = _hashed(nameless, text_col, h1, h2)
    named = _hashed(df.filter(F.col(id_col).isNotNull()).select(text_col), text_col, h1, h2).filter(F.col(h1).isNotNull()).select(h1, h2).distinct()
    return first.unionByName(own.join(named, [h1, h2], "left_anti").select(*df.columns))


def op5_bagminhash(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
