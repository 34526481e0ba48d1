import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarryline.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Root of each fingerprint by comparing all pairs."""
    prints = sorted(prints)
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= 3:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def truth(rows):
    prints = [plain_print(r.text) for r in rows]
    root = plain_components(set(prints))
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[root[p]] = min(least.get(root[p], r.doc_id), r.doc_id)
    return sorted(((r.doc_id, f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints)), key=str)


def test_against_brute_force(spark, odd, none, small):
    for docs in (odd, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")):
        assert sorted(map(tuple, simhash.annotate(docs).collect()), key=str) == truth(docs.collect())
    assert simhash.annotate(none).count() == 0


def test_hashes_are_those_of_spark(spark):
    text = "Über ALLE Maßen"
    low = "Über alle maßen".encode()
    want = spark.sql("SELECT 1").select(F.xxhash64(F.lit(low.decode()))).first()[0] % 2**64
    assert simhash.fingerprint(text.encode()) == want == plain_print(text)


def crowd(n, seed):
    """Fingerprints in chains and in balls around a few centres, and lone ones."""
    rng = random.Random(seed)
    out = set()
    for _ in range(8):
        centre = rng.getrandbits(64)
        for _ in range(n // 16):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
        for _ in range(n // 16):
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            out.add(centre)
    return sorted(out | {rng.getrandbits(64) for _ in range(n // 4)} | {0})


@pytest.mark.parametrize("tree, size, shard", [(4096, 1 << 25, 16), (5, 1 << 25, 16), (5, 0, 16), (4096, 1 << 25, 1)])
def test_links_keep_all_components(spark, monkeypatch, tree, size, shard):
    """Small shards, several trees a shard, broadcast or copied, and more blocks."""
    from quarryline.llm.common import Scratch

    monkeypatch.setattr(simhash, "TREE", tree)
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", size)
    if shard == 1:
        many = simhash.masks(1 << 32)
        assert len(many) == 20
        monkeypatch.setattr(simhash, "masks", lambda *_: many)
    prints = crowd(400, 3)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    edges = [(a % 2**64, b % 2**64) for a, b in simhash.links(Scratch(spark), df).collect()]
    assert all(a != b for a, b in edges)
    want, parent = plain_components(prints), {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        assert want[a] == want[b]
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in prints} == want


@pytest.mark.parametrize("n", [2, 10**6, 10**8, 10**11])
def test_masks_leave_one_choice_without_a_difference(n):
    rng = random.Random(n)
    masks = simhash.masks(n)
    assert n / 2 ** min(m.bit_count() for m in masks) <= 64 and len(masks) <= 35
    for _ in range(500):
        off = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not off & m for m in masks)


def test_trees_find_what_a_scan_finds():
    prints = np.array(crowd(600, 9), np.uint64)
    forest = simhash.Forest.build(prints, np.arange(len(prints)) % 3)
    for radius in (0, 3, 9):
        got = {(a, b) for who, node in forest.within(prints, forest.roots, radius) for a, b in zip(who.tolist(), node.tolist())}
        far = np.bitwise_count(prints[:, None] ^ prints[None, :])
        same = (np.arange(len(prints)) % 3)[:, None] == (np.arange(len(prints)) % 3)[None, :]
        assert got == set(zip(*(x.tolist() for x in np.nonzero((far <= radius) & same))))
    inner = np.flatnonzero(forest.parents >= 0)
    edges = [(int(forest.parents[i]), int(prints[i] ^ prints[forest.parents[i]]).bit_count()) for i in inner]
    assert len(edges) == len(set(edges)) and len(inner) == len(prints) - 3


def test_first_of_each_component_stays(odd):
    rows = {r.component_id for r in simhash.annotate(odd).collect()}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == rows
