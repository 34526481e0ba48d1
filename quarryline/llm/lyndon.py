"""Suffix arrays by linear grouping, and the bytes that repeat between documents.

The first phase sorts suffixes into groups by their longest Lyndon prefix: groups are taken in descending order; each
member points to the nearest earlier suffix of a smaller group, and what is pointed to by a group is split from its own
group by the number of pointers. The second phase walks the array from its start and puts the suffixes in front of each
entry, along their pointers, at the head of what is left of their groups. No reduced text is built and none is sorted
again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import repeats


#: Groups from this size on are processed as arrays, smaller ones member by member.
BATCH = 48


class _Groups:
    """The first phase: the suffixes in groups by what is known of their Lyndon prefixes. group is where the suffix's
    group starts and tail where the group that starts there ends; before points to the nearest earlier suffix of a
    smaller group."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = np.argsort(text, kind="stable")
        first = text[order]
        heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        ends = np.append(heads[1:], n)
        self.sa = order.astype(np.int64)
        self.group, self.place, self.tail = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
        self.group[order] = np.repeat(heads, ends - heads)
        self.place[order] = np.arange(n)
        self.tail[heads] = ends
        self.before = np.full(n, -1, np.int64)
        self.moving = np.zeros(n, bool)

    def run(self, batch: int) -> None:
        # The views share the arrays' memory; reading one number from a view is cheap.
        sa, group, place, tail, before = map(memoryview, (self.sa, self.group, self.place, self.tail, self.before))
        top = len(self.sa)
        while top:
            head = group[sa[top - 1]]
            if top - head >= batch:
                self._many(head, top)
                top = head
                continue
            if top - head == 1:  # most groups have one member
                i = sa[head]
                j = i - 1
                while j >= 0 and group[j] >= head:
                    j = before[j]
                before[i] = j
                top = head
                if j >= 0:
                    g = group[j]
                    end = tail[g]
                    new = end - 1
                    if new != g:
                        p, other = place[j], sa[new]
                        sa[p], place[other] = other, p
                        sa[new], place[j] = j, new
                        tail[g], tail[new], group[j] = new, end, new
                continue
            pointers: dict[int, int] = {}
            for i in sorted(sa[head:top]):
                j = i - 1
                while j >= 0 and group[j] >= head:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    pointers[j] = pointers.get(j, 0) + 1
            # Pointed to most often goes last; the parts of a group with one number are a group each.
            for count in sorted(set(pointers.values()), reverse=True) if len(pointers) > 1 else pointers.values():
                parts: dict[int, list[int]] = {}
                for j, c in pointers.items():
                    if c == count:
                        parts.setdefault(group[j], []).append(j)
                for g, some in parts.items():
                    end = tail[g]
                    new = end - len(some)
                    if new == g:
                        continue  # the whole group moves behind itself
                    if len(some) == 1:
                        j, other = some[0], sa[new]
                        p = place[j]
                        sa[p], place[other] = other, p
                        sa[new], place[j] = j, new
                    else:
                        inside = set(some)
                        rest = [q for q in sa[new:end] if q not in inside]
                        for p, q in zip([place[j] for j in some if place[j] < new], rest):
                            sa[p], place[q] = q, p
                        for p, j in zip(range(new, end), some):
                            sa[p], place[j] = j, p
                    tail[g], tail[new] = new, end
                    for j in some:
                        group[j] = new
            top = head

    def _many(self, head: int, top: int) -> None:
        """One large group at once."""
        sa, group, place, tail, before = self.sa, self.group, self.place, self.tail, self.before
        members = np.sort(sa[head:top])
        j = members - 1
        live = np.flatnonzero(j >= 0)
        while len(live):
            live = live[group[j[live]] > head]
            j[live] = before[j[live]]
            live = live[j[live] >= 0]
        # Who meets an earlier member of the group has its pointer.
        own = np.flatnonzero((j >= 0) & (group[j] == head))
        if len(own):
            root = np.arange(len(members))
            root[own] = np.searchsorted(members, j[own])
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            j = j[root]
        before[members] = j
        # The pointers ascend as the members do: no member of the group lies between one and what it points to.
        j = j[np.searchsorted(j, 0) :]
        if not len(j):
            return
        runs = np.flatnonzero(np.concatenate([[True], j[1:] != j[:-1]]))
        target, count = j[runs], np.diff(np.append(runs, len(j)))
        g = group[target]
        order = np.argsort(g * (len(j) + 1) + count)  # below the square of the text's length
        target, count, g = target[order], count[order], g[order]
        new_g = np.concatenate([[True], g[1:] != g[:-1]])
        first = np.flatnonzero(new_g)
        sizes = np.diff(np.append(first, len(g)))
        start = tail[g[first]] - sizes
        to = np.arange(len(g)) + np.repeat(start - first, sizes)
        at = place[target]
        self.moving[target] = True
        there = sa[to]
        rest = there[~self.moving[there]]
        self.moving[target] = False
        free = at[at < np.repeat(start, sizes)]
        sa[free], place[rest] = rest, free
        sa[to], place[target] = target, to
        part = np.flatnonzero(new_g | np.concatenate([[True], count[1:] != count[:-1]]))
        long = np.diff(np.append(part, len(g)))
        group[target] = np.repeat(to[part], long)
        tail[to[part]] = to[part] + long
        shrunk = start > g[first]
        tail[g[first][shrunk]] = start[shrunk]

    def order(self, batch: int) -> np.ndarray:
        """The second phase: each suffix, in order, puts the one in front of it, and those along the pointers, at the
        head of what is left of their groups."""
        n = len(self.sa)
        out, free, placed = np.full(n, -1, np.int64), np.arange(n, dtype=np.int64), np.zeros(n, np.uint8)
        m_out, m_free, m_placed, group, before = map(memoryview, (out, free, placed, self.group, self.before))
        out[0], placed[n - 1], free[0] = n - 1, 1, 1
        k = 0
        while k < n:
            end = m_free[group[m_out[k]]]
            if end - k >= batch:
                self._put(out, free, placed, k, end)
                k = end
                continue
            for i in range(k, end):
                j = m_out[i] - 1
                while j >= 0 and not m_placed[j]:
                    g = group[j]
                    at = m_free[g]
                    m_out[at], m_free[g] = j, at + 1
                    m_placed[j] = 1
                    j = before[j]
            k = end
        return out

    def _put(self, out: np.ndarray, free: np.ndarray, placed: np.ndarray, k: int, end: int) -> None:
        node = out[k:end] - 1
        nth = np.arange(end - k)
        nodes, owners = [], []
        while True:
            on = np.flatnonzero(node >= 0)
            on = on[placed[node[on]] == 0]
            if not len(on):
                break
            node, nth = node[on], nth[on]
            nodes.append(node)
            owners.append(nth)
            node = self.before[node]
        if not nodes:
            return
        node, nth = np.concatenate(nodes), np.concatenate(owners)
        if len(nodes) > 1:  # who comes first has the node
            order = np.argsort(node * (end - k) + nth)
            node, nth = node[order], nth[order]
            once = np.concatenate([[True], node[1:] != node[:-1]])
            node, nth = node[once], nth[once]
        g = self.group[node]
        order = np.argsort(g * (end - k) + nth)
        node, g = node[order], g[order]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        sizes = np.diff(np.append(first, len(g)))
        to = np.arange(len(g)) + np.repeat(free[g[first]] - first, sizes)
        out[to] = node
        placed[node] = 1
        free[g[first]] += sizes.astype(np.int64)


def suffix_array(text: np.ndarray, batch: int = BATCH) -> np.ndarray:
    """The order of the suffixes; the last symbol has to be the only least one."""
    groups = _Groups(text)
    groups.run(batch)
    return groups.order(batch)


def _same(raw: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Whether the window at each place has the bytes of that at the place before, eight at a time; the last eight
    may overlap those before them."""
    wide = min(8, window)
    words = np.ndarray(len(raw) - wide + 1, f"V{wide}" if wide < 8 else np.uint64, raw, strides=(1,))
    steps = [*range(0, window - wide, wide), window - wide]
    same = np.zeros(len(at), bool)
    for lo in range(1, len(at), 1 << 14):
        some = at[lo - 1 : lo + (1 << 14)].astype(np.int64)
        alike = np.ones(len(some) - 1, bool)
        for step in steps:
            w = words[some + step]
            alike &= w[1:] == w[:-1]
        same[lo : lo + len(alike)] = alike
    return same


def least_docs(contents: list[bytes], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For each content the least doc that has each of its windows: neighbours in the suffix array that agree in a
    whole window are one run, and the run's least doc is that of all its windows."""
    sizes = np.asarray([len(c) for c in contents])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = np.ones(int(sizes.sum()) + len(contents) + 1, np.int16)  # 1 separates, 0 ends
    inside = np.ones(len(text), bool)
    inside[begin + sizes] = False
    inside[-1] = False
    text[inside] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int16) + 2
    text[-1] = 0
    sa = suffix_array(text)
    left = np.repeat(begin + sizes, sizes + 1) - np.arange(len(text) - 1)  # symbols before the separator
    sa = sa[sa < len(text) - 1]
    sa = sa[left[sa] >= window]
    least = np.full(len(text), repeats.LAST)
    if len(sa):
        heads = np.flatnonzero(~_same(np.frombuffer(b"\0".join(contents), np.uint8), sa, window))
        doc = np.repeat(docs, sizes + 1)[sa]
        least[sa] = np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.append(heads, len(sa))))
    return [least[b : b + max(0, n - window + 1)] for b, n in zip(begin, sizes)]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; for nulls and repeated rows see repeats.removed."""
    out = repeats.removed(df, False, least_docs, id_col, text_col)
    return out.selectExpr("doc_id", "units as n_bytes", "removed as n_removed", "spans as n_spans", "sha as kept_sha256")


def op10_lyndon_suffixes(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS t FROM documents
), byte AS (
  SELECT rid, doc_id, i, hex(t[i:i]) AS x, CASE WHEN i + 49 <= octet_length(t) THEN md5(t[i:i + 49]) END AS k
  FROM (SELECT *, unnest(range(1, octet_length(t) + 1)) AS i FROM d)
), shared AS (
  SELECT k, min(doc_id) AS least FROM byte WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1
), bad AS (
  SELECT rid, i, x, CASE WHEN least < coalesce(doc_id, 9223372036854775807) THEN 1 ELSE 0 END AS b FROM byte LEFT JOIN shared USING (k)
), gone AS (
  SELECT rid, i, x, max(b) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS g FROM bad
), runs AS (
  SELECT *, CASE WHEN g = 1 AND coalesce(lag(g) OVER (PARTITION BY rid ORDER BY i), 0) = 0 THEN 1 ELSE 0 END AS starts FROM gone
), sums AS (
  SELECT rid, sum(g) AS n_removed, sum(starts) AS n_spans, coalesce(string_agg(x, '' ORDER BY i) FILTER (g = 0), '') AS kept FROM runs GROUP BY rid
)
SELECT doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN sums USING (rid)
"""
