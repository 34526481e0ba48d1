"""A compressed FM-index and the words that repeat between documents.

The Burrows-Wheeler transform of a shard is a wavelet matrix of packed bits with sampled counts, and so are the
documents in the order of the suffixes, which answers what the least document of an interval is. Backward search gives
the matching statistics of the streamed texts, all places at once; statistics of a whole window are reported.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import repeats


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` symbols at least, by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, k = len(text), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        behind = np.zeros(n, np.int64)
        behind[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        if rank[order[-1]] == n - 1:
            break
        k *= 2
    return order


class Bits:
    """Packed bits; rank(i) is the number of ones before i, from a count for each 512 bits, a small one for each 64 and
    the bits themselves."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 512 + 1) * 512, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).reshape(-1, 8).astype(np.int64)
        self.large = np.concatenate([[0], np.cumsum(ones.sum(axis=1))[:-1]])
        self.small = (np.cumsum(ones, axis=1) - ones).astype(np.uint16).ravel()
        self.zeros = n - int(ones.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        w, b = i >> 6, (i & 63).astype(np.uint64)
        return self.large[w >> 3] + self.small[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << b) - np.uint64(1)))


class WaveletMatrix:
    """A sequence of numbers as one row of bits for each binary digit."""

    def __init__(self, values: np.ndarray):
        self.digits = max(1, int(values.max(initial=0)).bit_length())
        self.bits: list[Bits] = []
        for digit in range(self.digits - 1, -1, -1):
            bit = (values >> digit) & 1
            self.bits.append(Bits(bit.astype(np.uint8)))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def down(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position i goes if the digits of value are followed to the last row."""
        for digit, bits in zip(range(self.digits - 1, -1, -1), self.bits):
            ones = bits.rank(i)
            i = np.where((value >> digit) & 1, bits.zeros + ones, i - ones)
        return i

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least number of each range that is not empty: a digit is 0 if any number of the range has it so."""
        out = np.zeros(len(lo), np.int64)
        for digit, bits in zip(range(self.digits - 1, -1, -1), self.bits):
            a, b = bits.rank(lo), bits.rank(hi)
            one = hi - lo == b - a
            out |= one.astype(np.int64) << digit
            lo, hi = np.where(one, bits.zeros + a, lo - a), np.where(one, bits.zeros + b, hi - b)
        return out


class FMIndex:
    """Wavelet matrices of the Burrows-Wheeler transform and of the documents in the order of suffixes; neither the
    text nor the suffix array stays."""

    def __init__(self, text: np.ndarray, doc: np.ndarray, depth: int):
        """text holds symbols from 0; 0 is the separator. doc is the document of each place."""
        sa = suffix_array(text, depth)
        self.size = len(text)
        self.bwt, self.docs = WaveletMatrix(text[sa - 1]), WaveletMatrix(doc[sa])
        symbols = np.arange(int(text.max()) + 2)
        self.first = np.searchsorted(np.sort(text), symbols)
        self.base = self.bwt.down(symbols[:-1], np.zeros(len(symbols) - 1, np.int64))

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with a symbol put in front of each."""
        shift = self.first[symbol] - self.base[symbol]
        both = self.bwt.down(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return both[: len(lo)] + shift, both[len(lo) :] + shift

    def statistics(self, text: np.ndarray, end: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a streamed text: how many symbols before each end the index has in a row, up to
        limit, and their interval. A search goes on while more than one place matches; a single place that is left is
        the streamed text's own, as the index has all texts that are streamed, and matches to the limit."""
        length, lo, hi = np.full(len(end), limit), np.zeros(len(end), np.int64), np.full(len(end), self.size)
        live = np.arange(len(end))
        for k in range(1, limit + 1):
            a, b = self.step(text[end[live] - k], lo[live], hi[live])
            some = b > a
            length[live[~some]] = k - 1
            live, a, b = live[some], a[some], b[some]
            lo[live], hi[live] = a, b
            live = live[b - a > 1]
        return length, lo, hi


def least_docs(contents: list[bytes], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For each content the least doc that has each of its windows: the contents are indexed once and streamed against
    the index, and an interval of a whole window is looked up in the documents' wavelet matrix."""
    words = [c.split() for c in contents]
    known: dict[bytes, int] = {}
    sizes = np.asarray([len(w) for w in words])
    text = np.zeros(int(sizes.sum()) + len(words), np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    for at, w in zip(begin.tolist(), words):
        text[at : at + len(w)] = [known.setdefault(x, len(known) + 1) for x in w]
    names, rank = np.unique(docs, return_inverse=True)
    index = FMIndex(text, np.repeat(rank, sizes + 1), window)
    many = np.maximum(sizes - window + 1, 0)
    cut = np.concatenate([[0], np.cumsum(many)])
    end = np.arange(cut[-1]) + np.repeat(begin - cut[:-1], many) + window
    length, lo, hi = index.statistics(text, end, window)
    out = np.full(len(end), repeats.LAST)
    whole = np.flatnonzero(length >= window)
    out[whole] = names[index.docs.least(lo[whole], hi[whole])]
    return [out[a:b] for a, b in zip(cut[:-1], cut[1:])]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row; for nulls and repeated rows see repeats.removed."""
    out = repeats.removed(df, True, least_docs, id_col, text_col)
    return out.selectExpr("doc_id", "units as n_words", "removed as n_removed", "sha as kept_sha256")


def op6_fm_index(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT rid, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS k FROM (SELECT *, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)
), bad AS (
  SELECT rid, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE least < coalesce(doc_id, 9223372036854775807)
), word AS (
  SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d
), gone AS (
  SELECT word.rid, i, x, max(CASE WHEN bad.s IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY word.rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS g
  FROM word LEFT JOIN bad ON bad.rid = word.rid AND bad.s = word.i
), sums AS (
  SELECT rid, sum(g) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (g = 0), '') AS kept FROM gone GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN sums USING (rid)
"""
