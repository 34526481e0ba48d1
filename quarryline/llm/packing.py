"""Packing by shortest-pack-first over the length histogram.

Documents become pieces of at most max_tokens; the pieces' lengths make a histogram of at most max_tokens entries,
whatever the number of documents. Lengths are placed longest first, each into the pattern with the most room, many
documents at a time. The patterns then say for each length and rank where a piece goes, and pieces get their rank by a
distributed prefix sum.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens
from . import textkernel as tk
from ..session import ship

MAX_TOKENS = 4096
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """The pieces of each row: whole stretches of max_tokens, then the rest. A null or empty text has the end id alone."""
    ship(df.sparkSession)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = batch.column(1)
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                raw = texts[k].as_buffer()
                ids = (enc.encode(bytes(raw)) if raw is not None else b"") + end
                n = len(ids) // 4
                for at in range(0, n, max_tokens):
                    part = ids[4 * at : 4 * (at + max_tokens)]
                    rows.append((doc_id, at, len(part) // 4, zlib.crc32(part), n))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return source.mapInArrow(tk.resting(cut), PIECES)


def patterns(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (count, [(length, copies), ...]) that hold each length as often as the histogram says.

    Longest lengths first; a length goes to the patterns with the most room. Where none has room, new patterns get as
    many copies of the length as fit. A pattern is split when only a part of its packs gets a length."""
    heap: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # (-room, order, count, parts)
    done: list[tuple[int, list[tuple[int, int]]]] = []
    order = 0

    def put(room: int, count: int, parts: list[tuple[int, int]]) -> None:
        nonlocal order
        order += 1
        if room:
            heapq.heappush(heap, (-room, order, count, parts))
        else:
            done.append((count, parts))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and -heap[0][0] >= length:
                room, _, count, parts = heapq.heappop(heap)
                room = -room
                copies = min(room // length, -(-left // count)) if count < left else 1
                used = min(count, left // copies)
                if used < count:
                    put(room, count - used, parts)
                put(room - used // used * copies * length, used, [*parts, (length, copies)])
                left -= used * copies
            else:
                copies = min(max_tokens // length, left)
                used = left // copies
                put(max_tokens - copies * length, used, [(length, copies)])
                left -= used * copies
    return done + [(count, parts) for _, _, count, parts in heap]


def slots(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, copies, offset) for the ranks of each length."""
    out, next_rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for count, parts in patterns(histogram, max_tokens):
        offset = 0
        for length, copies in parts:
            lo = next_rank[length]
            next_rank[length] = lo + count * copies
            out.append((length, lo, lo + count * copies, sequence, copies, offset))
            offset += length * copies
        sequence += count
    return out


def pack(pieces_df: DataFrame, max_tokens: int = MAX_TOKENS, partitions: int | None = None) -> DataFrame:
    """Each piece with its sequence_id and offset. No piece is lost: rows that repeat a piece get places of their own.
    A table without rows gives none."""
    spark = pieces_df.sparkSession
    scratch = common.Scratch(spark)
    kept = scratch.write(pieces_df, "pieces")
    histogram = {r[0]: r[1] for r in kept.groupBy("length").count().collect()}  # at most max_tokens rows
    rows = slots(histogram, max_tokens)
    starts, total = {}, 0
    for length in sorted(histogram):
        starts[length] = total
        total += histogram[length]
    places = spark.createDataFrame(
        [(n, lo + starts[n], hi + starts[n], seq, k, off) for n, lo, hi, seq, k, off in rows] or [(-1, 0, 0, 0, 1, 0)],
        "p_length long, lo long, hi long, seq long, copies long, off long",
    )
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in ("length", "doc_id", "start", "ids_crc32", "doc_tokens")]
    ranked = common.running_sum(scratch, kept.withColumn("one", F.lit(1).cast("long")), keys, "one", "rank", parts)
    # places grows with max_tokens, not with the documents: a few rows for each length.
    met = ranked.join(F.broadcast(places), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    own = F.col("rank") - F.col("lo")
    return met.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("seq") + F.floor(own / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("off") + F.pmod(own, F.col("copies")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(df: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Tokenise and pack the rows of df. Null ids are kept as null; other columns are not read."""
    return pack(pieces(df, path or tokenizer_path(), max_tokens=max_tokens), max_tokens)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
