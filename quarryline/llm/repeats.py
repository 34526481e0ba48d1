"""Windows of 50 words or bytes that also start in a document with a smaller id.

Hashes only find out where equal windows can be and bring them to one place. What is removed is what an engine (an
FM-index over words, a suffix array over bytes) finds in the texts themselves:

1. Of each window, the least hash of its 25-unit pieces is its anchor, so equal windows have equal anchors. Blocks of
   documents send their anchors' prints to buckets, which answer whether another document has the anchor too, its
   route, a hash of the set of blocks that have it, and whether the windows around it differ anywhere.
2. Where they differ, the windows themselves are sent in the same way, so that a block knows which windows another
   document may have. Runs of these are cut at places that their content chooses, and where the route changes: the
   stretches. What surrounds a shared passage is thus left behind, and the stretches of copies are equal, however many
   there are.
3. Stretches of equal content are combined, in their block, then in salted groups, each time by comparing the whole
   content; the least id that has it goes along.
4. The engine gets the distinct stretches of a route and says for each window the least id that has it.
5. Its answers go back the same way: to the groups, to the blocks' entries, to the rows. An id loses the windows that
   a smaller one has.

A group of copies, however large, leaves one stretch for each salt on its route; near copies leave the stretches that
end at their differences, whose number is bounded by the places where a stretch can be cut.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common
from . import textkernel as tk
from ..session import ship

WINDOW = 50
PIECE = 25
#: Bytes of text of a block and of the texts whose anchors a bucket holds, on average.
BLOCK_BYTES, BUCKET_BYTES = 1 << 20, 1 << 22
#: Bytes of text whose pieces are hashed together: the arrays stay in a core's cache, and short texts share the calls.
TOGETHER = 1 << 15
#: Blocks of text for each shard of an engine.
SHARD_BLOCKS = 20
#: A stretch is cut at a window whose hash has this many bits of zero, for bytes and for words.
CUT_BITS = (10, 8)
#: Blocks for each further route of a set.
SPREAD = 4
#: Blocks whose equal stretches are one group at most, on average.
GROUP = 4096
LAST = np.iinfo(np.int64).max
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MARK = "bucket long, block long, prints binary, several binary, around binary, varied binary"
_MASK = "block long, kind int, bucket long, n long, hits binary, route binary, varied binary"
_ENTRY = "block long, k long, route long, doc long, data binary, members array<struct<row: long, at: int, own: boolean>>"
_DONE = "doc_id long, units long, removed long, spans long, sha string"


def units_of(texts: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the units of some texts, one after the other, and how many each text has."""
    if words:
        raw, starts = tk.joined(texts)
        units, start, _ = tk.word_hashes(raw)
        return units, np.diff(np.searchsorted(start, starts))
    return tk.BYTE[np.frombuffer(b"".join(texts), np.uint8)], np.fromiter(map(len, texts), np.int64, len(texts))


def anchors(texts: list[bytes], words: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each text the hashes of all pieces; the first window of each run of windows with one anchor, the anchors, and
    a hash of all that the windows of the run hold. Short texts are worked on together."""
    for i, j in tk.slices(texts, TOGETHER):
        yield from _anchors(*units_of(texts[i:j], words))


def _anchors(units: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    n, span = len(units), WINDOW - PIECE + 1
    some = np.flatnonzero(sizes >= WINDOW)
    if not len(some):
        yield from [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint32))] * len(sizes)
        return
    begin = np.cumsum(sizes) - sizes
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(units * tk.powers(tk.BASE, n), out=total[1:])
    back = tk.powers(tk.INVERSE, n)
    pieces = total[PIECE:] - total[:-PIECE]
    pieces *= back[: n - PIECE + 1]
    pieces = tk.mix_once(pieces)
    least = tk.sliding_min(pieces, span)
    new = np.empty(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[begin[some]] = True
    new[0] = True
    first = np.flatnonzero(new)
    # Runs end with their text, and windows of two texts are none.
    owner = np.searchsorted(begin[some], first, side="right") - 1
    stop = np.where(owner >= 0, (begin + sizes)[some][owner] - (WINDOW - 1), 0)
    end = np.minimum(np.append(first[1:], len(least)), stop)
    own = end > first
    first, end, owner = first[own], end[own] + (WINDOW - 1), some[owner[own]]
    around = tk.mix_once((total[end] - total[first]) * back[first] + end.astype(np.uint64) - first.astype(np.uint64))
    around, least = (around >> np.uint64(32)).astype(np.uint32), tk.mix(least[first])
    cut = np.searchsorted(owner, np.arange(len(sizes) + 1)).tolist()
    first -= begin[owner]
    for at, size, i, j in zip(begin.tolist(), sizes.tolist(), cut, cut[1:]):
        yield pieces[at : at + size - PIECE + 1] if i < j else pieces[:0], first[i:j], least[i:j], around[i:j]


def result(text: bytes, words: bool, gone: np.ndarray | None) -> tuple[int, int, int, str]:
    """Units, removed ones, runs of removed ones, SHA-256 of what is left."""
    if words:
        parts = text.split()
        if gone is not None:
            parts = [w for w, g in zip(parts, gone) if not g]
        left, n = b" ".join(parts), len(parts) if gone is None else len(gone)
    else:
        left, n = text if gone is None else np.frombuffer(text, np.uint8)[~gone].tobytes(), len(text)
    lost = 0 if gone is None else int(gone.sum())
    runs = 0 if gone is None else int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
    return n, lost, runs, hashlib.sha256(left).hexdigest()


class _Prints:
    """The distinct hashes of a block, in order, and for each document which of them its hashes are. Only marks() asks
    which of them two documents have and, if it is given, what is around them and whether that differs."""

    def __init__(self, hashes: list[np.ndarray], docs: list[int], around: list[np.ndarray] | None = None):
        every = np.concatenate([*hashes, np.empty(0, np.uint64)])
        self.docs, self.sizes, self.around = docs, [len(h) for h in hashes], around
        self.order = np.argsort(every)
        h = every[self.order]
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
        self.first = np.flatnonzero(new)
        self.distinct = h[self.first]
        nth = np.empty(len(h), np.int64)
        nth[self.order] = np.cumsum(new) - 1
        self.which = np.split(nth, np.cumsum(self.sizes)[:-1])

    def _least(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct hash the least of its values, and whether they differ."""
        if not len(values):
            return values, np.empty(0, bool)
        values = values[self.order]
        least = np.minimum.reduceat(values, self.first)
        return least, least != np.maximum.reduceat(values, self.first)

    def marks(self, block: int, bits: int) -> pa.Table:
        _, several = self._least(np.repeat(np.asarray(self.docs, np.int64), self.sizes))
        around, varied = (None, None) if self.around is None else self._least(np.concatenate([*self.around, np.empty(0, np.uint32)]))
        bucket = (self.distinct >> np.uint64(64 - bits)).astype(np.int64)
        low = (self.distinct << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
        ends = np.append(cut[1:], len(bucket))
        return pa.table(
            {
                "bucket": pa.array(bucket[cut], pa.int64()), "block": pa.array(np.full(len(cut), block), pa.int64()),
                "prints": pa.array([low[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()),
                "several": pa.array([np.packbits(several[i:j]).tobytes() for i, j in zip(cut, ends)], pa.binary()),
                "around": pa.array([b"" if around is None else around[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()),
                "varied": pa.array([b"" if varied is None else np.packbits(varied[i:j]).tobytes() for i, j in zip(cut, ends)], pa.binary()),
            }
        )

    def answers(self, masks: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each distinct hash whether it is shared; of anchors the route (-1 where there is none) and whether what is
        around them differs."""
        rows = sorted((x for x in masks.to_pylist() if x["kind"] == kind), key=lambda x: x["bucket"])
        bits = lambda c: np.concatenate([*[np.unpackbits(np.frombuffer(x[c], np.uint8), count=x["n"]) for x in rows], np.empty(0, np.uint8)]).astype(bool)
        on = bits("hits")
        route = np.full(len(on), -1, np.int64)
        if kind == 2:
            return on, route, on
        route[on] = np.concatenate([*[np.frombuffer(x["route"], np.int32) for x in rows], np.empty(0, np.int32)])
        return on, route, bits("varied")


def _answer(kind: int) -> Callable:
    """For each block's prints of a bucket: which of them another block has, or two documents of the block; for
    anchors also the route, a hash of the set of blocks that have it. Neighbouring windows of a shared passage are in
    the same documents, so their routes agree, and routes are as even as hashes are. A set of many blocks has several
    routes, among which its anchors are dealt, so that no family of near copies is one route."""

    def run(table: pa.Table) -> pa.Table:
        prints = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("prints")]
        sizes = np.asarray([len(p) for p in prints])
        several = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n) for x, n in zip(table.column("several"), sizes)]).astype(bool)
        every = np.concatenate(prints)
        order = np.argsort(every)
        s = every[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        many = np.diff(np.append(first, len(s)))
        hit = np.empty(len(s), bool)
        hit[order] = np.repeat(many > 1, many)
        hit |= several
        route, varied = np.zeros(len(s), np.int32), np.zeros(len(s), bool)
        if kind == 1:
            around = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("around")])[order]
            differs = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n) for x, n in zip(table.column("varied"), sizes)])[order]
            unlike = (np.minimum.reduceat(around, first) != np.maximum.reduceat(around, first)) | (np.maximum.reduceat(differs, first) > 0)
            varied[order] = np.repeat(unlike, many)
            blocks = tk.mix(np.repeat(table.column("block").to_numpy(), sizes).astype(np.uint64) + np.uint64(1))
            part = s[first].astype(np.uint64) % (1 + many // SPREAD).astype(np.uint64)
            route[order] = np.repeat(tk.mix(np.add.reduceat(blocks[order], first) + part * _GOLDEN) >> np.uint64(33), many)
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "block": table.column("block"), "kind": pa.array(np.full(len(sizes), kind), pa.int32()), "bucket": table.column("bucket"), "n": pa.array(sizes, pa.int64()),
                "hits": pa.array([np.packbits(hit[e - n : e]).tobytes() for e, n in zip(ends, sizes)], pa.binary()),
                "route": pa.array([route[e - n : e][hit[e - n : e]].tobytes() if kind == 1 else b"" for e, n in zip(ends, sizes)], pa.binary()),
                "varied": pa.array([np.packbits(varied[e - n : e]).tobytes() if kind == 1 else b"" for e, n in zip(ends, sizes)], pa.binary()),
            }
        )

    return run


class _Block:
    """The documents of a block with the anchors of their windows."""

    def __init__(self, table: pa.Table, words: bool):
        self.row, self.doc, self.text = (table.column(c).to_pylist() for c in ("row", "doc", "text"))
        found = list(anchors(self.text, words))
        self.pieces = [x[0] for x in found]
        self.first = [x[1] for x in found]
        self.prints = _Prints([x[2] for x in found], self.doc, [x[3] for x in found])

    def shared(self, masks: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each document with shared anchors: its place, the windows that have them, their routes, and whether they
        have to be asked for one by one."""
        _, route, varied = self.prints.answers(masks, 1)
        for k, which in enumerate(self.prints.which):
            own = route[which]
            some = np.flatnonzero(own >= 0)
            if len(some):
                first = self.first[k]
                many = np.append(first[1:], len(self.pieces[k]) - (WINDOW - PIECE))[some] - first[some]
                at = np.arange(many.sum()) + np.repeat(first[some] - (np.cumsum(many) - many), many)
                yield k, at, np.repeat(own[some], many), np.repeat(varied[which[some]], many)

    def hashes(self, k: int, at: np.ndarray) -> np.ndarray:
        p = self.pieces[k]
        return tk.mix_once(p[at] * _GOLDEN + p[at + (WINDOW - PIECE)])

    def windows(self, masks: pa.Table) -> tuple[list[tuple], _Prints]:
        found = list(self.shared(masks))
        return found, _Prints([self.hashes(k, at[ask]) for k, at, _, ask in found], [self.doc[k] for k, *_ in found])


def _mark(words: bool, bits: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        out = _Block(table, words).prints.marks(table.column("block")[0].as_py(), bits)
        tk.rest()
        return out

    return run


def _ask(words: bool, bits: int) -> Callable:
    def run(table: pa.Table, masks: pa.Table) -> pa.Table:
        _, prints = _Block(table, words).windows(masks)
        out = prints.marks(table.column("block")[0].as_py() if table.num_rows else -1, bits)
        tk.rest()
        return out

    return run


def _stretches(at: np.ndarray, h: np.ndarray, route: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last windows and routes of the stretches of the windows `at`, which are in order."""
    begin = h & np.uint64((1 << cut) - 1) == 0
    begin[:1] = True
    begin[1:] |= (route[1:] != route[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(begin)
    return at[first], at[np.append(first[1:], len(at))[: len(first)] - 1], route[first]


def _entries(words: bool) -> Callable:
    def run(table: pa.Table, masks: pa.Table) -> pa.Table:
        b = _Block(table, words)
        found, prints = b.windows(masks)
        on, _, _ = prints.answers(masks, 2)
        entries: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
        for (k, at, route, ask), which in zip(found, prints.which):
            good = ~ask
            good[ask] = on[which]
            at, route = at[good], route[good]
            units = b.text[k].split() if words else b.text[k]
            for i, j, r in zip(*(x.tolist() for x in _stretches(at, b.hashes(k, at), route, CUT_BITS[words]))):
                part = units[i : j + WINDOW]
                entries.setdefault((r, b" ".join(part) if words else part), []).append((b.doc[k], b.row[k], i))
        least = [min(m)[0] for m in entries.values()]
        many = pa.array(np.cumsum([0, *map(len, entries.values())]), pa.int32())
        flat = [(row, at, doc == low) for low, m in zip(least, entries.values()) for doc, row, at in m]
        member = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.bool_()))], names=["row", "at", "own"])
        out = pa.table(
            {
                "block": pa.array(np.full(len(entries), table.column("block")[0].as_py() if table.num_rows else -1), pa.int64()), "k": pa.array(np.arange(len(entries)), pa.int64()),
                "route": pa.array([r for r, _ in entries], pa.int64()), "doc": pa.array(least, pa.int64()), "data": pa.array([d for _, d in entries], pa.binary()),
                "members": pa.ListArray.from_arrays(many, member),
            }
        )
        tk.rest()
        return out

    return run


def _intervals(on: np.ndarray) -> np.ndarray:
    """Starts and ends, one after the other, of the stretches that windows which are on cover."""
    at = np.flatnonzero(on)
    if not len(at):
        return np.empty(0, np.int32)
    new = np.flatnonzero(np.concatenate([[True], np.diff(at) > WINDOW]))
    last = np.append(new[1:], len(at)) - 1
    return np.stack([at[new], at[last] + WINDOW], axis=1).ravel().astype(np.int32)


def _engine(find: Callable) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        docs = table.column("doc").to_numpy()
        least = find(table.column("data").to_pylist(), docs, WINDOW)
        out = pa.table(
            {
                "id": table.column("id"), "own": pa.array([_intervals(m < d) for m, d in zip(least, docs)], pa.list_(pa.int32())),
                "others": pa.array([_intervals((m <= d) & (m < LAST)) for m, d in zip(least, docs)], pa.list_(pa.int32())),
            }
        )
        tk.rest()
        return out

    return run


def _finish(words: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(5)]
            doc, text, at, spans = (batch.column(i) for i in range(4))
            for k in range(batch.num_rows):
                raw, gone = text[k].as_py(), None
                if at[k].is_valid:
                    edge = np.zeros((len(raw.split()) if words else len(raw)) + 1, np.int64)
                    each = spans[k].values
                    own = np.asarray(each.flatten()).reshape(-1, 2) + np.repeat(np.asarray(at[k].values), np.asarray(pa.compute.list_value_length(each)) // 2)[:, None]
                    np.add.at(edge, own[:, 0], 1)
                    np.add.at(edge, own[:, 1], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                for column, v in zip(out, (doc[k].as_py(), *result(raw, words, gone))):
                    column.append(v)
            kinds = (*[pa.int64()] * 4, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names=["doc_id", "units", "removed", "spans", "sha"])

    return run


def removed(df: DataFrame, words: bool, find: Callable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: doc_id, units, removed, spans, sha (of what is left).

    find(contents, docs, window) gives for each content the least doc that has each of its windows (LAST: none).
    Null texts count as empty. A null id comes after all others: its windows are removed where another id has them, and
    never remove any. Rows that repeat an id are one document, which does not remove its own windows. An empty table
    gives no rows; other columns are not read."""
    spark = df.sparkSession
    ship(spark)
    scratch = common.Scratch(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    seen = Observation()
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))).alias("doc"), text.alias("text"))
    docs = scratch.write(docs.observe(seen, F.sum(F.length("text")).alias("bytes")), "docs")
    size = seen.get["bytes"] or 0
    blocks, bits = 1 + size // BLOCK_BYTES, max(4, min(30, int(math.log2(1 + size // BUCKET_BYTES))))
    block = docs.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    marks = block.groupBy("block").applyInArrow(_mark(words, bits), _MARK)
    anchor_masks = scratch.write(marks.groupBy("bucket").applyInArrow(_answer(1), _MASK), "anchors")
    asked = block.groupBy("block").cogroup(anchor_masks.groupBy("block")).applyInArrow(_ask(words, bits), _MARK)
    masks = anchor_masks.unionByName(scratch.write(asked.groupBy("bucket").applyInArrow(_answer(2), _MASK), "windows"))
    entries = scratch.write(block.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(_entries(words), _ENTRY), "entries")
    scratch.drop("anchors", "windows")
    # Equal contents, compared whole, become one for each salt, and blocks are dealt to salts.
    salt = F.pmod(F.xxhash64("block"), F.lit(-(-blocks // GROUP))).alias("salt")
    combined = entries.groupBy("route", "data", salt).agg(F.min("doc").alias("doc"), F.collect_list(F.struct("block", "k", "doc")).alias("who"))
    combined = scratch.write(combined.select(F.monotonically_increasing_id().alias("id"), "route", "data", "doc", "who"), "combined")
    # The suffixes of a text of a few MB fall in large groups, which the engines process as arrays.
    shard = F.pmod("route", F.lit(-(-blocks // SHARD_BLOCKS))).alias("shard")
    hits = scratch.write(combined.select("id", shard, "data", "doc").groupBy("shard").applyInArrow(_engine(find), "id long, own array<int>, others array<int>"), "hits")
    some = hits.filter(F.size("others") > 0).join(combined.select("id", "doc", "who"), "id").select("doc", "own", "others", F.explode("who").alias("who"))
    some = some.select("who.block", "who.k", F.when(F.col("who.doc") == F.col("doc"), F.col("own")).otherwise(F.col("others")).alias("own"), "others")
    each = some.join(entries.select("block", "k", "members"), ["block", "k"]).select("own", "others", F.explode("members").alias("m"))
    each = each.select("m.row", "m.at", F.when(F.col("m.own"), F.col("own")).otherwise(F.col("others")).alias("spans")).filter(F.size("spans") > 0)
    lost = each.groupBy("row").agg(F.collect_list(F.struct("at", "spans")).alias("x")).select("row", F.col("x.at").alias("at"), F.col("x.spans").alias("spans"))
    lost = scratch.write(lost, "lost")
    scratch.drop("entries", "combined", "hits")
    met = docs.join(lost.hint("shuffle_hash"), "row", "left").select("doc", "text", "at", "spans").mapInArrow(tk.resting(_finish(words)), _DONE)
    return met.withColumn("doc_id", F.when(F.col("doc_id") < int(LAST), F.col("doc_id")))
