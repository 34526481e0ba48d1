"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its hashed features: words, pairs of neighbouring words and the character
n-grams of words with their boundaries. A softmax over two classes reads the average. Training is numpy stochastic
gradient descent over a bounded sample of labelled rows; scoring covers every whole text. As the softmax is linear in
the average, scoring needs one learned number for each bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from . import textkernel as tk
from ..session import ship

BITS = 17
DIM = 8
GRAMS = (3, 4, 5)
EPOCHS = 5
#: Training steps at least.
STEPS = 15_000
RATE = 0.6
#: Labelled rows of each class that training reads at most, those with the smallest hash of their id.
SAMPLE = 1500
THRESHOLD = 0.3


def _layout(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """One byte array with a space before and behind each text, white space alike, and where each text starts."""
    parts = [b"" if t is None else t for t in texts]
    raw = np.frombuffer(b" " + b"  ".join(parts) + b" ", np.uint8).copy()
    raw[tk.SPACE[raw]] = 32
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(np.fromiter((len(p) + 2 for p in parts), np.int64, len(parts)), out=starts[1:])
    return raw, starts


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def features(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: the buckets in the order of the texts, and where each text's ones start."""
    raw, starts = _layout(texts)
    inner = np.concatenate([[0], np.cumsum(raw == 32)])
    code = raw.astype(np.uint32) + np.uint32(1)
    h = code
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint32(0x01000193) + code[n - 1 :]
        if n in GRAMS:
            # No white space between the first and the last letter.
            at = np.flatnonzero(inner[n - 1 : len(h) + n - 1] == inner[1 : len(h) + 1])
            yield _bucket(h[at] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)), np.searchsorted(at, starts)
    words, at, _ = tk.word_hashes(raw)
    first = np.searchsorted(at, starts)
    yield _bucket((words >> np.uint64(32)).astype(np.uint32)), first
    # Pairs by the difference of their hashes: all pairs of equal words share a bucket.
    pairs = tk.mix(words[1:] - words[:-1])
    doc = np.searchsorted(starts, at, side="right")
    same = np.flatnonzero(doc[1:] == doc[:-1])
    yield _bucket((pairs[same] >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995)), np.searchsorted(at[same], starts)
    # One feature that every text has.
    yield np.zeros(len(texts), np.uint32), np.arange(len(texts) + 1)


def bags(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text; the shares sum to 1."""
    kinds = list(features(texts))
    out = []
    for k in range(len(texts)):
        own = np.concatenate([b[s[k] : s[k + 1]] for b, s in kinds])
        bucket, n = np.unique(own, return_counts=True)
        out.append((bucket.astype(np.int32), (n / n.sum()).astype(np.float32)))
    return out


def train(sample: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """The learned number of each bucket: its vector times the difference of the two output rows. Without labelled
    rows every number is 0, and every score 0.5."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    rows = np.zeros((2, DIM), np.float32)
    classes = [np.asarray([k for k, x in enumerate(sample) if x[0] == c], np.int64) for c in (0, 1)]
    most = max(len(c) for c in classes)
    # The smaller class is repeated to the size of the larger one; small samples get more epochs.
    turn = np.concatenate([np.resize(c, most) for c in classes if len(c)] or [np.empty(0, np.int64)])
    epochs = max(epochs, -(-STEPS // max(1, len(turn)))) if len(turn) else 0
    steps, done = max(1, epochs * len(turn)), 0
    for _ in range(epochs):
        for k in rng.permutation(turn):
            label, bucket, share = sample[k]
            own = vectors[bucket]
            hidden = share @ own
            z = rows @ hidden
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            step = rate * (1 - done / steps)
            back = p @ rows
            rows -= step * np.outer(p, hidden)
            vectors[bucket] = own - (step * share)[:, None] * back
            done += 1
    return (vectors @ (rows[1] - rows[0])).astype(np.float64)


def _held(col):
    return F.coalesce(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5, F.lit(0)) == 0


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Train on the rows of df that labels marks and that are not held out. Rows with a null id or label are not used;
    an id with several labels has the least. The driver gets bags of hashed features, of at most 2 * sample texts."""
    ship(df.sparkSession)
    marks = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("l_id")).agg(F.min(label_col).cast("int").alias("label"))
    marks = marks.filter(~_held(F.col("l_id")))
    order = [F.xxhash64("l_id"), F.col("l_id")]
    chosen = None
    for value in (0, 1):
        part = marks.filter(F.col("label") == value).orderBy(*order).limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # chosen has at most 2 * sample ids.
    met = df.select(F.col(id_col).alias("l_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).join(F.broadcast(chosen), "l_id")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks_, texts = (batch.column(i).to_pylist() for i in (0, 1, 2))
            for lo, hi in tk.slices(texts):
                found = bags(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo:hi], pa.int64()), pa.array(marks_[lo:hi], pa.int32()),
                        pa.array([b.tobytes() for b, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary()),
                    ],
                    names=["id", "label", "bucket", "share"],
                )

    rows = met.select(F.col("l_id").cast("long").alias("l_id"), "label", "text").mapInArrow(tk.resting(extract), "id long, label int, bucket binary, share binary").collect()
    rows.sort(key=lambda r: (r[0], bytes(r[2]), bytes(r[3])))
    return train([(r[1], np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in rows])


def logits(texts: list, table: np.ndarray) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, start in features(texts):
        # One sum for each text, so that a score does not depend on its neighbours.
        some = np.flatnonzero(np.diff(start))
        if len(some):
            total[some] += np.add.reduceat(table[bucket], start[some])
        count += np.diff(start)
    return total / count


def score(df: DataFrame, table: np.ndarray, text_col: str = "text", keep: list[str] | None = None, out_col: str = "score") -> DataFrame:
    """The columns keep of each row with its score as the column out_col, which must not be one of them. Null texts count as empty and get the score of an empty text."""
    ship(df.sparkSession)
    keep = keep or []
    kept = df.select(*[F.col(c) for c in keep])
    source = df.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(common.free_name(kept, "_text")))
    schema = kept.withColumn(out_col, F.lit(0.0)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            out = np.empty(len(texts))
            for lo, hi in tk.slices(texts):
                out[lo:hi] = 1 / (1 + np.exp(-logits(texts[lo:hi], table)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out)], names=[*keep, out_col])

    return source.mapInArrow(tk.resting(run), schema)


def keep_good(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of df that the classifier accepts, with all their columns and only these, whatever their names."""
    name = common.free_name(df, "_score")
    return score(df, fit(df, labels), keep=df.columns, out_col=name).filter(F.col(name) >= THRESHOLD).drop(name)


def judged(df: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """The columns keep of each row of df with score and predicted (1 from a score of 0.3)."""
    return score(df, fit(df, labels), keep=keep).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ["doc_id"])
    return out.select("doc_id", _held(F.col("doc_id")).alias("held_out"), "score", "predicted")
