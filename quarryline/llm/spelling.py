"""Spelling variants: words that differ by one inserted, deleted or replaced letter, and the form that each stands for.

Near words come from positional q-gram indexes. A pair of lengths L and L or L + 1 differs at one place, so of two halves
of the word (cut by L) one is the same in both: each half with its place is the key of a shard of the index, and what
is left of the words is indexed there. A shard that is too large is cut again by the same rule, until few letters are
left, so that its size is bounded by the alphabet; no pair is lost on the way, and each is found in one shard alone.

In a shard the postings of a gram (its two letters, its place, the length of the word) are in the order of the words. A
word's lists, those of its own length and place and those of one letter more at its place or the next, are merged by a
heap; what is in as many lists as one edit leaves at least is verified letter by letter.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from . import textkernel as tk
from ..session import ship

# Fixed values of the contract: what a run of letters is, and which runs lose a letter.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOSES = 31
LEAST_LETTERS, LEAST_COUNT, FACTOR = 7, 2, 10
#: Distinct words that a task counts before it hands them on, and members of a shard before it is cut again.
HELD, MEMBERS = 200_000, 2048
_KEY = ["fam", "path", "fixed"]
_NEAR = "word string, near string, near_n long"


def runs(doc_id, text: bytes | None) -> Iterator[tuple[str, int]]:
    """The words of a text and how often they occur: lower-cased runs, of which some lose a letter by a hash of the
    document's id (a null id is the empty text) and the run."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall((text or b"").lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), prefix)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """word and n of each word of that many letters and occurrences."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for word, n in runs(doc_id.as_py(), text.as_py()):
                    if len(word) >= letters:
                        held[word] += n
                if len(held) >= HELD:
                    yield out()
        yield out()

    own = df.select(F.col(id_col), F.col(text_col).cast("binary"))
    counted = own.mapInArrow(tk.resting(run), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _cut(rows: DataFrame) -> DataFrame:
    """Rows (fam, path, fixed, closed, short, rest, word, n) in the two shards of their halves: `rest` is what may
    differ, `short` its length in the shorter word of a pair, `closed` whether something fixed comes behind it."""
    half = F.floor(F.col("short") / 2).cast("int")
    behind = F.col("short") - half
    ahead = F.length("rest") - behind
    part = lambda at, n: F.col("rest").substr(at, n)
    first = F.struct(
        F.concat("path", F.lit("p")).alias("path"), F.concat("fixed", part(F.lit(1), half)).alias("fixed"), F.col("closed").alias("closed"),
        behind.alias("short"), part(half + 1, F.length("rest")).alias("rest"),
    )
    second = F.struct(
        F.concat("path", F.lit("s")).alias("path"), F.concat("fixed", part(ahead + 1, behind)).alias("fixed"), F.lit(True).alias("closed"),
        half.alias("short"), part(F.lit(1), ahead).alias("rest"),
    )
    return rows.select("fam", F.explode(F.array(first, second)).alias("cut"), "word", "n").select("fam", "cut.*", "word", "n")


def _common(a: str, b: str) -> int:
    """How many first letters are the same."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _grams(rest: str) -> list[str]:
    padded = f"\0{rest}\0"
    return [padded[k : k + 2] for k in range(len(rest) + 1)]


def _merged(lists: list[list[int]], need: int) -> Iterator[int]:
    """The numbers that occur at least `need` times in sorted lists, by a heap over their heads."""
    if len(lists) < need:
        return
    before, run = -1, 0
    for v in heapq.merge(*lists):
        run = run + 1 if v == before else 1
        before = v
        if run == need:
            yield v


def pairs(rests: list[str], short: int, closed: bool) -> Iterator[tuple[int, int]]:
    """Numbers of rests that differ by one edit: of a length of `short` both, or the second of one letter more. An edit
    at the end of a rest that is closed belongs to the shard of what comes behind.

    With a mark at both ends a rest has one gram more than letters, of which one edit spoils two at most."""
    index: dict[tuple[int, str, int], list[int]] = defaultdict(list)
    grams = [_grams(r) for r in rests]
    for i, own in enumerate(grams):
        for at, gram in enumerate(own):
            index[len(rests[i]), gram, at].append(i)
    for i, rest in enumerate(rests):
        if len(rest) != short:
            continue
        same = [found for at, g in enumerate(grams[i]) if (found := index[short, g, at]) and found[-1] > i]
        tails = [found[bisect_right(found, i) :] for found in same]
        # A single letter, replaced, leaves no gram: then all are candidates, at most as many as there are letters.
        equal = _merged(tails, short - 1) if short > 1 else (j for j in range(i + 1, len(rests)) if len(rests[j]) == short)
        for j in equal:
            n = _common(rest, rests[j])
            if rest[n + 1 :] == rests[j][n + 1 :]:
                yield i, j
        longer = [found for at, g in enumerate(grams[i]) for place in (at, at + 1) if (found := index.get((short + 1, g, place)))]
        for j in _merged(longer, short) if short else (j for j, r in enumerate(rests) if len(r) == 1):
            n = _common(rest, rests[j])
            if rest[n:] == rests[j][n + 1 :] and not (closed and n == short):
                yield i, j


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)))

    out: list[tuple[str, str, int]] = []

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["word", "near", "near_n"])

    for _, shard in itertools.groupby(rows(), key=lambda r: r[:3]):
        _, _, _, closed, short, rests, own, n = zip(*shard)
        for i, j in pairs(list(rests), short[0], closed[0]):
            out += (own[i], own[j], n[j]), (own[j], own[i], n[i])
        if len(out) > 20_000:
            yield batch_of()
    yield batch_of()


def near(scratch: common.Scratch, counted: DataFrame) -> DataFrame:
    """word, near, near_n for each ordered pair of words that are one edit apart. A word has at most some hundred near
    words for each of its letters, as there are no more ways to change it."""
    ship(scratch.spark)
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.length("word")
    # A word is the shorter one of some pairs, or of the same length, and the longer one of others.
    rows = counted.select(F.explode(F.array(size, size - 1)).alias("fam"), F.lit("").alias("path"), F.lit("").alias("fixed"), F.lit(False).alias("closed"), "word", "n")
    rows = rows.select("fam", "path", "fixed", "closed", F.col("fam").alias("short"), F.col("word").alias("rest"), "word", "n")
    found, turn = [], 0
    while True:
        rows = _cut(rows)
        sizes = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        live = scratch.write(rows.join(sizes, _KEY), f"shards-{turn}")
        # What is cut down to one letter stays as it is: its shard has no more words than there are ways to write two.
        hot = (F.col("members") > MEMBERS) & (F.col("short") > 1)
        own = live.filter(~hot).select(*_KEY, "closed", "short", "rest", "word", "n").repartition(parts, *_KEY).sortWithinPartitions(*_KEY)
        found.append(scratch.write(own.mapInArrow(tk.resting(_search), _NEAR), f"near-{turn}"))
        rows = live.filter(hot).drop("members")
        if not rows.limit(1).count():
            break
        turn += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _best() -> Column:
    """The near word of largest n, of several the first in the order of code points."""
    return F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))


def _roots(scratch: common.Scratch, forms: DataFrame) -> DataFrame:
    """word, root: the last of the chain of forms. Counts grow by FACTOR along a chain, so it has few members, and each
    turn doubles the steps that are taken."""
    step = scratch.write(forms.select("word", F.col("form").alias("root")), "roots-0")
    turn = 0
    while True:
        turn += 1
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = scratch.write(step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{turn}")
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        step = new.select("word", "root")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word.

    Null texts have no words; a null id is hashed as the empty text; rows that repeat an id count each. A table without
    words gives no rows; other columns are not read. A form is a near word of at least `factor` times the occurrences."""
    scratch = common.Scratch(df.sparkSession)
    counted = scratch.write(words(df, id_col, text_col), "words")
    around = near(scratch, counted).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), _best().alias("best"))
    joined = counted.join(around, "word", "left")
    named = F.col("best.less") <= -factor * F.col("n")
    own = scratch.write(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(named, F.col("best.near")).alias("form"), F.when(named, -F.col("best.less")).alias("form_n")),
        "forms",
    )
    roots = _roots(scratch, own.filter("form is not null"))
    return own.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))
