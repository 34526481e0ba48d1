"""Training-order materialisation: token sequences at permuted slots in files of fixed stride.

The documents' token ids, in the order of doc_id, are one stream that is cut into sequences; only the last one of all is
padded. A prefix sum over the documents' lengths says where in the stream each document lies, so the sequences do not
depend on how the table is dealt to files or tasks. A keyed Feistel permutation of their numbers with cycle-walking
gives each sequence its slot, without a shuffle table. Slots are dealt by range: each partition is one shard, sorted by
slot and written front to back. Slot s is in shard s // per_shard at byte (s % per_shard) * stride, so a reader goes on
anywhere with one seek.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens
from . import textkernel as tk
from .packing import tokenizer_path
from ..session import ship

LENGTH = 2048
PER_SHARD = 4096
END_ID = 2
PAD_ID = 0
KEY = 0x5EED
ROUNDS = 6
_PARTS = "array<struct<doc_id:long,start:long,length:int,offset:int>>"


def permute(numbers: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed bijection of 0 .. n-1: a balanced Feistel network over the least even number of bits that holds n,
    walked along its cycle until it is back below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(zlib.crc32(f"{key}/{r}".encode()) * 0x9E3779B97F4A7C15 & (2**64 - 1)) for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            h = (right ^ k) * np.uint64(0xD6E8FEB86659FD93)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & mask)
        return (left << np.uint64(half)) | right

    out = once(np.asarray(numbers).astype(np.uint64))
    out_of = np.flatnonzero(out >= np.uint64(n))
    while len(out_of):
        out[out_of] = once(out[out_of])
        out_of = out_of[out[out_of] >= np.uint64(n)]
    return out.astype(np.int64)


def _dtype(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def encoded(df: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, crc and ids (zstd) of each row. A null or empty text is its end id alone."""
    dtype = _dtype(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, press = tokens.encoder(path), zstandard.ZstdCompressor(level=6)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            raw = [enc.encode(t) + end for t in batch.column(1).to_pylist()]
            ids = [np.frombuffer(r, "<u4").astype(dtype) for r in raw]
            columns = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array([press.compress(x.tobytes()) for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "crc", "ids"])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return source.mapInArrow(tk.resting(run), "doc_id long, n long, crc long, ids binary")


def _pieces(dtype: str, length: int) -> Callable:
    """Documents (doc_id, at, ids) cut where sequences end: sequence, offset, doc_id, start, length, ids."""
    width = np.dtype(dtype).itemsize

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, unpress = zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()
        kinds = (*[pa.int64()] * 4, pa.int32(), pa.binary())
        names = ["sequence", "offset", "doc_id", "start", "length", "ids"]
        for batch in batches:
            rows, held = [], 0
            ids = batch.column(2)
            for k, (doc_id, at) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                packed = ids[k].as_py()
                raw = unpress.decompress(packed)
                n, start = len(raw) // width, 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    some = min(length - offset, n - start)
                    part = packed if some == n else press.compress(raw[start * width : (start + some) * width])
                    rows.append((sequence, offset, doc_id, start, some, part))
                    start, held = start + some, held + len(part)
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def open_folder(uri: str):
    """(file system, path) of a folder of the shared store, local or remote."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), urlparse(uri).path) if urlparse(uri).scheme in ("", "file") else fs.FileSystem.from_uri(uri)


def _writer(root: str, per_shard: int, length: int, dtype: str):
    """Write each shard under a name of its own and put it in place when it is whole; a task that runs again writes the
    same bytes again, in the place of those that are there. Rows (slot, sequence, offset, doc_id, start, length, ids) come
    in the order of slot and offset."""
    stride = length * np.dtype(dtype).itemsize

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = open_folder(root)
        unpress = zstandard.ZstdDecompressor()
        current, stream, name = None, None, None
        slot, sequence, ids, parts, done = None, None, [], [], []

        def finish() -> None:
            if stream is not None:
                stream.close()
                target = f"{folder}/shard-{current:08d}.bin"
                if store.get_file_info(target).type != fs.FileType.NotFound:
                    store.delete_file(target)
                store.move(name, target)

        def close() -> None:
            nonlocal current, stream, name, ids, parts
            if slot is None:
                return
            if slot // per_shard != current:
                finish()
                current = slot // per_shard
                name = f"{folder}/.shard-{current:08d}.{uuid.uuid4().hex}"
                stream = store.open_output_stream(name)
            used = sum(len(x) for x in ids)
            raw = b"".join(ids) + np.full(length - used // np.dtype(dtype).itemsize, PAD_ID, dtype).tobytes()
            stream.write(raw)
            done.append((slot, sequence, slot // per_shard, slot % per_shard * stride, zlib.crc32(raw), used // np.dtype(dtype).itemsize, parts))
            ids, parts = [], []

        def rows() -> pa.RecordBatch:
            kinds = (*[pa.int64()] * 5, pa.int32(), pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int32())])))
            names = ["slot", "sequence", "shard", "byte_offset", "crc32", "used", "parts"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * 7, kinds)], names=names)

        for batch in batches:
            packed = batch.column(6)
            for k, (own, number, offset, doc_id, start, some) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(6)))):
                if own != slot:
                    close()
                    slot, sequence = own, number
                ids.append(unpress.decompress(packed[k].as_py()))
                parts.append({"doc_id": doc_id, "start": start, "length": some, "offset": offset})
            if done:
                yield rows()
                done.clear()
        close()
        finish()
        yield rows()

    return write


def materialise(df: DataFrame, root: str | None = None, path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> tuple[DataFrame, str]:
    """Write the shards and index.json below root; the rows say for each sequence its slot, its place and the pieces
    of documents in it. An empty table makes no shard. Rows that repeat are written as often; null ids stay null and come
    last. The order within an id is that of a checksum of its ids, so that the same table gives the same files."""
    spark = df.sparkSession
    ship(spark)
    scratch = common.Scratch(spark)
    path, root = path or tokenizer_path(), root or common.new_folder(spark, "tokens")
    dtype = _dtype(path)
    docs = scratch.write(encoded(df, path).withColumn("row", F.monotonically_increasing_id()), "encoded")
    keys = [F.col("doc_id").asc_nulls_last(), F.col("crc"), F.col("n"), F.col("row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = scratch.write(common.running_sum(scratch, docs.select("row", "doc_id", "crc", "n"), keys, "n", "at", parts).select("row", "at"), "starts")
    total = docs.agg(F.sum("n")).first()[0] or 0
    n = -(-total // length)
    met = docs.select("row", "doc_id", "ids").join(starts.hint("shuffle_hash"), "row").select("doc_id", "at", "ids")
    pieces = scratch.write(met.mapInArrow(tk.resting(_pieces(dtype, length)), "sequence long, offset long, doc_id long, start long, length int, ids binary"), "pieces")
    scratch.drop("encoded", "starts")

    @F.pandas_udf("long")
    def slot_of(sequence: pd.Series) -> pd.Series:
        return pd.Series(permute(sequence.to_numpy(), n, key))

    shards = max(1, -(-n // per_shard))
    slotted = pieces.withColumn("slot", slot_of("sequence")).select("slot", "sequence", "offset", "doc_id", "start", "length", "ids")
    dealt = slotted.repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int")).sortWithinPartitions("slot", "offset")
    store = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = store.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(store)
    out = scratch.write(
        dealt.mapInArrow(tk.resting(_writer(root, per_shard, length, dtype)), f"slot long, sequence long, shard long, byte_offset long, crc32 long, used int, parts {_PARTS}"), "places"
    )
    scratch.drop("pieces")
    stride = length * np.dtype(dtype).itemsize
    stream = files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/index.json"), True)
    stream.write(bytearray(json.dumps({"sequences": n, "length": length, "dtype": dtype, "stride": stride, "per_shard": per_shard, "key": key}).encode()))
    stream.close()
    return out, root


def read(root: str, first: int = 0) -> Iterator[np.ndarray]:
    """The sequences from slot `first` on, in training order."""
    store, folder = open_folder(root)
    with store.open_input_stream(f"{folder}/index.json") as f:
        index = json.loads(f.read())
    slot = first
    while slot < index["sequences"]:
        with store.open_input_file(f"{folder}/shard-{slot // index['per_shard']:08d}.bin") as f:
            f.seek(slot % index["per_shard"] * index["stride"])
            while slot < index["sequences"] and (raw := f.read(index["stride"])):
                yield np.frombuffer(raw, index["dtype"])
                slot += 1


def op3_training_order(spark, sf_dir: str) -> DataFrame:
    """Each sequence with its slot, file place and pieces of documents."""
    return materialise(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
