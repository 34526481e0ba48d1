"""Phrase collocations: frequent phrases of a language, scored at their weakest cut.

Texts become shards: rows of a few MB of one language, cut at piece boundaries. A phrase is frequent only if its words
and its shorter phrases are, so candidates are found in three turns, words, pairs, and phrases of three to five words.
In each turn a shard counts the cells of its phrases in a sketch of one hash row, whose width goes with the words of the
table; the sums are upper bounds, and only phrases whose cell reaches the threshold go on. The sketch is kept sparse, as
rows of some cells that Spark sums, so it is never whole in one place, nor is a shard's part of it. The cells that pass go to the shards as a bitmap, which
may let more through, while they are few enough for one of a bounded size; beyond that each shard gets back those of its
own cells that passed, by a join.

The candidates of a shard are compiled, with a guard on both sides, into automata of a bounded number of phrases each;
scanning the shard's text counts all their matches, overlapping ones too, by their content. Sums over shards are exact,
and the threshold applies to them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from . import textkernel as tk
from ..session import ship

# Fixed values of the contract: what ends a piece, in bytes.
BREAKS = b".,;:!?\n\x0b\x0c\r"
LONGEST, LEAST, TOP, SCALE = 5, 100, 2000, 1000
#: Bytes of text of a shard, or one piece; and what a task holds of all languages before it hands them on.
SHARD, HELD = 4 << 20, 32 << 20
#: Phrases of an automaton at most, and those that are strings at once.
AUTOMATON = 50_000
#: Cells of a row at most: a shard's are many rows, of which Spark unfolds one at a time.
CELLS = 1 << 14
#: Cells of the sketch for each word of the table, as a power of two.
WIDTH = 3
#: Bits of a bitmap of cells at most (32 MB), and cells up to which it has eight bits or more for each or is that large.
BITMAP, PASSING = 28, 1 << 26
#: Copies of the counts of first and last parts, so that a common word's phrases are not one key.
SALTS = 8
#: Languages that are broadcast at most (a few MB).
BROADCAST_ROWS = 50_000
_LINES = bytes.maketrans(BREAKS, b"\n" * len(BREAKS))
_MIX = np.random.default_rng(11).integers(0, 2**63, 2 * LONGEST + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TEXT = "lang string, text binary, words array<string>, counts array<long>"
_CELLS = "shard long, lang string, vocab array<string>, ids binary, cells array<long>, counts array<int>"
_FOUND = "lang string, size int, phrase string, n long"


def pieces(text: bytes | None) -> list[bytes]:
    """The pieces of a text that have words, lower-cased (A-Z), with one space between words."""
    low = (text or b"").lower().translate(_LINES)
    return [b" ".join(words) for piece in low.split(b"\n") if (words := piece.split())]


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a language until they are SHARD bytes, and the counts of their words."""
    held: dict[str, tuple[list[bytes], list[int]]] = {}

    def out(lang: str) -> pa.RecordBatch:
        own, _ = held.pop(lang)
        counts = Counter(b"\n".join(own).split())
        # A piece of one word has no phrase, and its word is counted.
        text = b"\n".join(p for p in own if b" " in p)
        row = [lang], [text], [[w.decode() for w in counts]], [list(counts.values())]
        kinds = (pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=["lang", "text", "words", "counts"])

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            own, size = held.setdefault(lang.as_py(), ([], [0]))
            for piece in pieces(text.as_py()):
                own.append(piece)
                size[0] += len(piece) + 1
                if size[0] >= SHARD:
                    yield out(lang.as_py())
                    own, size = held.setdefault(lang.as_py(), ([], [0]))
            while sum(s[0] for _, s in held.values()) > HELD:
                yield out(max(held, key=lambda k: held[k][1][0]))
    for lang in [k for k, (own, _) in held.items() if own]:
        yield out(lang)


def _cells(ids: np.ndarray, hashes: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of that many words start, none across a break (an id below 0), and their cells in the sketch."""
    if len(ids) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(ids) - size + 1
    whole = np.ones(n, bool)
    total = np.full(n, _MIX[-size], np.uint64)
    for k in range(size):
        whole &= ids[k : k + n] >= 0
        total += hashes[ids[k : k + n]] * _MIX[k]
    at = np.flatnonzero(whole)
    return at, (tk.mix(total[at]) >> np.uint64(64 - bits)).view(np.int64)


def _hashes(lang: str, vocab: list[str]) -> np.ndarray:
    """The hashes of words as Spark's xxhash64 has them."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(f"{lang}\0{w}", 42) for w in vocab), np.uint64, len(vocab))


def _word_cell(lang: Column, word: Column) -> Column:
    return F.xxhash64(F.concat(lang, F.lit("\0"), word))


class Passed:
    """The cells that passed: a bitmap of all, or, with a row of the joined column `passed`, those of a shard."""

    def __init__(self, bitmap: Broadcast | None):
        self.bitmap = bitmap

    def among(self, cells: np.ndarray, passed: pa.Scalar | None) -> np.ndarray:
        if self.bitmap is not None:
            bits = self.bitmap.value
            slot = cells & (64 * len(bits) - 1)
            return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
        own = np.sort(np.asarray(passed.values)) if passed.is_valid else np.zeros(0, np.int64)
        return own[np.minimum(np.searchsorted(own, cells), len(own) - 1)] == cells if len(own) else np.zeros(len(cells), bool)


def _without_lone(ids: np.ndarray) -> np.ndarray:
    """ids without words between two breaks, and with one break for several."""
    wide = np.concatenate([[-1], ids, [-1]])
    lone = (wide[1:-1] >= 0) & (wide[:-2] < 0) & (wide[2:] < 0)
    kept = np.where(lone, -1, ids)
    return kept[(kept >= 0) | (np.concatenate([[-1], kept[:-1]]) >= 0)]


def _sketch_rows(shard: int, lang: str, vocab: list[str], ids: np.ndarray, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A shard as a row of its words and ids, and its cells in rows that have neither."""
    def row(vocab: list[str] | None, ids: bytes | None, cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([shard], pa.int64()), pa.array([lang]), pa.array([vocab], pa.list_(pa.string())), pa.array([ids], pa.binary())]
        columns += [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t)) for v, t in ((cells, pa.int64()), (counts, pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "vocab", "ids", "cells", "counts"])

    cells, counts = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
    yield row(vocab, ids.astype("<i4").tobytes(), cells[:0], counts[:0])
    for at in range(0, len(cells), CELLS):
        yield row(None, None, cells[at : at + CELLS], counts[at : at + CELLS])


def _passed_of(batch: pa.RecordBatch, k: int) -> pa.Scalar | None:
    return batch.column("passed")[k] if "passed" in batch.schema.names else None


def _pairs(bits: int, ask: Passed):
    """Shards with their frequent words as ids and breaks, and the cells of their pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, lang, text, words = (batch.column(c)[k].as_py() for c in ("shard", "lang", "text", "words"))
                hashes = _hashes(lang, words)
                kept = np.flatnonzero(ask.among(hashes.view(np.int64), _passed_of(batch, k)))
                vocab = [words[i] for i in kept]
                number = {w.encode(): i for i, w in enumerate(vocab)}
                tokens = text.replace(b"\n", b" \n ").split(b" ")
                ids = _without_lone(np.fromiter(map(number.get, tokens, repeat(-1)), np.int64, len(tokens)))
                yield from _sketch_rows(shard, lang, vocab, ids, [_cells(ids, hashes[kept], 2, bits)[1]])

    return run


def _state(batch: pa.RecordBatch, k: int) -> tuple[int, str, list[str], np.ndarray, np.ndarray]:
    """shard, lang, vocab, the words' hashes and the ids."""
    shard, lang, vocab, raw = (batch.column(c)[k].as_py() for c in ("shard", "lang", "vocab", "ids"))
    return shard, lang, vocab, _hashes(lang, vocab), np.frombuffer(raw, "<i4").astype(np.int64)


def _longer(bits: int, ask: Passed, longest: int):
    """Shards cut between words whose pair did not pass, and the cells of their longer phrases."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, lang, vocab, hashes, ids = _state(batch, k)
                at, cells = _cells(ids, hashes, 2, bits)
                cut = at[~ask.among(cells, _passed_of(batch, k))] + 1
                ids = _without_lone(np.insert(ids, cut, -1))
                used, place = np.unique(ids[ids >= 0], return_inverse=True)
                ids[ids >= 0] = place
                vocab, hashes = [vocab[i] for i in used.tolist()], hashes[used]
                yield from _sketch_rows(shard, lang, vocab, ids, [_cells(ids, hashes, size, bits)[1] for size in range(3, longest + 1)])

    return run


def _matches(text: str, phrases: list[str]) -> np.ndarray:
    """How often each phrase occurs in the text, by an automaton of them."""
    import ahocorasick

    n = np.zeros(len(phrases), np.int64)
    automaton = ahocorasick.Automaton()
    for i, phrase in enumerate(phrases):
        automaton.add_word(f" {phrase} ", i)
    automaton.make_automaton()
    for i, found in Counter(map(itemgetter(1), automaton.iter(text))).items():
        n[i] = found
    return n


def _parts_of(found: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The rows of the arrays, in their order, in lists of AUTOMATON rows at most."""
    part, room = [], AUTOMATON
    for rows in found:
        while len(rows):
            part.append(rows[:room])
            rows, room = rows[len(part[-1]) :], room - len(part[-1])
            if not room:
                yield part
                part, room = [], AUTOMATON
    if part:
        yield part


def _count(bits: int, ask: Passed, longest: int):
    """The candidates of each shard and how often its text has them."""

    def candidates(hashes: np.ndarray, ids: np.ndarray, passed: pa.Scalar | None) -> Iterator[np.ndarray]:
        for size in range(2, longest + 1):
            at, cells = _cells(ids, hashes, size, bits)
            if size > 2:  # pairs that did not pass are breaks by now
                at = at[ask.among(cells, passed)]
            if not len(at):
                return
            yield np.unique(ids[at[:, None] + np.arange(size)], axis=0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, lang, vocab, hashes, ids = _state(batch, k)
                names = [*vocab, "\n"]
                text = " " + " ".join([names[i] for i in ids.tolist()]) + " "
                for part in _parts_of(candidates(hashes, ids, _passed_of(batch, k))):
                    phrases = [" ".join([vocab[i] for i in row]) for rows in part for row in rows.tolist()]
                    sizes = np.repeat([rows.shape[1] for rows in part], [len(rows) for rows in part])
                    columns = [pa.array([lang] * len(phrases), pa.string()), pa.array(sizes, pa.int32()), pa.array(phrases, pa.string()), pa.array(_matches(text, phrases))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "n"])

    return run


def counts(scratch: common.Scratch, df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, size, phrase, n: the words and the phrases of 2 to `longest` words that occur `least` times or more, by
    language, and the number of all words of each language as the row of the empty phrase, of size 0."""
    ship(scratch.spark)
    own = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    shards = scratch.write(own.mapInArrow(tk.resting(_shards), _TEXT).select(F.monotonically_increasing_id().alias("shard"), "*"), "shards", rows=common.LARGE)
    used = shards.select("shard", "lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("shard", "lang", F.col("w.words").alias("phrase"), F.col("w.counts").alias("n"))
    words = scratch.write(used.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words", large=True)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit(0).alias("size"), F.lit("").alias("phrase"), "n")
    words = words.filter(F.col("n") >= least)
    bits = max(4, min(62, math.ceil(math.log2(1 + (totals.agg(F.sum("n")).first()[0] or 0))) + WIDTH))

    def answered(rows: DataFrame, cells: DataFrame, passing: DataFrame) -> tuple[DataFrame, Passed]:
        """rows, and how they learn which of their cells (shard, cell) are passing."""
        many = passing.count()
        if many > PASSING:
            return rows.join(cells.join(passing, "cell").groupBy("shard").agg(F.collect_list("cell").alias("passed")), "shard", "left"), Passed(None)
        slots = 1 << max(6, min(BITMAP, (8 * many).bit_length()))
        slot = F.col("cell").bitwiseAND(F.lit(slots - 1).cast("long"))
        one = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))").alias("bit")
        found = passing.select(F.shiftright(slot, 6).alias("place"), one).groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
        bitmap = np.zeros(slots // 64, np.uint64)
        bitmap[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return rows, Passed(scratch.spark.sparkContext.broadcast(bitmap))

    def sketched(rows: DataFrame, name: str) -> tuple[DataFrame, Passed]:
        """rows of _CELLS and which of their cells have a sum over all shards that reaches the threshold."""
        cells = rows.select("shard", F.explode(F.arrays_zip("cells", "counts")).alias("c")).select("shard", F.col("c.cells").alias("cell"), F.col("c.counts").alias("n"))
        bound = scratch.write(cells.groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("cell"), f"sketch-{name}", large=True)
        return answered(rows.filter("ids IS NOT NULL").drop("cells", "counts"), cells, bound)

    cell = _word_cell(F.col("lang"), F.col("phrase")).alias("cell")
    rows, ask = answered(shards.drop("counts"), used.select("shard", cell), words.select(cell).distinct())
    pairs = scratch.write(rows.mapInArrow(tk.resting(_pairs(bits, ask)), _CELLS), "pairs", large=True)
    scratch.drop("shards")
    rows, ask = sketched(pairs, "pairs")
    longer = scratch.write(rows.mapInArrow(tk.resting(_longer(bits, ask, longest)), _CELLS), "longer", large=True)
    scratch.drop("pairs")
    rows, ask = sketched(longer, "longer")
    found = rows.mapInArrow(tk.resting(_count(bits, ask, longest)), _FOUND)
    phrases = scratch.write(found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrases", large=True)
    scratch.drop("longer")
    return totals.unionByName(words.select("lang", F.lit(1).alias("size"), "phrase", "n")).unionByName(phrases)


def _part(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def scored(scratch: common.Scratch, counted: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score of each phrase of two words or more: at the cut of the lowest score, of
    several the first. Numbers are decimals of 38 digits, so products are exact."""
    known = counted.filter("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    words = F.split("phrase", " ")
    cuts = counted.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", _part(words, F.lit(1), F.col("k")).alias("first"), _part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    left = known.select("lang", F.col("part").alias("first"), F.col("f").alias("l"), "salt")
    right = known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"), "salt")
    totals = counted.filter("size = 0").select("lang", F.col("n").alias("n"))
    totals = F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals
    met = cuts.join(left, ["lang", "first", "salt"]).join(right, ["lang", "rest", "salt"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = (wide("a") * wide("n")).cast("decimal(34,0)") * F.lit(SCALE).cast("decimal(4,0)")
    met = met.withColumn("above", product.cast("decimal(38,0)")).withColumn("below", (wide("l") * wide("r")).cast("decimal(38,0)"))
    met = met.withColumn("score", F.expr("above div below"))
    best = met.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return scratch.write(best.select("lang", "phrase", "size", "a", "b.l", "b.r", "n", "b.score"), "scored")


def maximal(rows: DataFrame) -> DataFrame:
    """rows without phrases whose words lie in a longer phrase that occurs as often."""
    words = F.split("phrase", " ")
    longer = rows.filter("size > 2").select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("w"))
    longer = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("w") + 1)).alias("at"))
    inner = longer.select("lang", _part(words, F.col("at"), F.col("w")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return rows.join(inner, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < 100 * F.col("a"))).drop("most")


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language.

    Null texts are empty, and a null language is `und`. Rows that repeat count each. Languages without a phrase, and empty
    tables, give no rows; other columns are not read. A text, however long, is cut into shards at its pieces, and a piece
    is whole in a task."""
    scratch = common.Scratch(df.sparkSession)
    rows = maximal(scored(scratch, counts(scratch, df, lang_col, text_col, least, longest)))
    # First the best of each part of a language, so that no task sorts a whole one.
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), s AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM p, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
), f AS (
  SELECT lang, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL
), n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 100
), k AS (SELECT *, unnest(range(1, size)) AS k FROM c
), x AS (
  SELECT k.lang, k.phrase, k.size, k.a, k.w, k.k, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * k.a * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM k JOIN n USING (lang) JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(k.w, 1, k.k), ' ')
  JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(k.w, k.k + 1, k.size), ' ')
), b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, array_to_string(list_slice(w, pos, pos + m - 1), ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS pos FROM (SELECT *, unnest(range(2, size)) AS m FROM c)) GROUP BY ALL
), kept AS (SELECT b.* FROM b LEFT JOIN inner_ i USING (lang, phrase) WHERE i.most IS NULL OR 100 * i.most < 100 * b.a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""
