import hashlib
import random
import re
from collections import Counter

import numpy as np

from quarryline.llm import bagminhash, components, exact_dedup
from quarryline.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def exact_truth(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r.text), []).append(r)
    out = Counter()
    for key, group in groups.items():
        best = min(group, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)).doc_id
        for r in group:
            out[(r.doc_id, best, len(group), r.doc_id == best, hashlib.sha256(key.encode()).hexdigest())] += 1
    return out


def test_exact_against_brute_force(odd):
    got = Counter(map(tuple, exact_dedup.annotate(odd).collect()))
    assert got == exact_truth(odd.collect())


def test_exact_keeps_whole_rows(odd, none):
    kept = exact_dedup.keep_first(odd).collect()
    assert sorted(WORD.sub(lambda m: m[0], re.sub(r"\s", "", r.text or "")) for r in kept) == sorted({re.sub(r"\s", "", r.text or "") for r in odd.collect()})
    assert kept[0].__fields__ == odd.columns
    assert exact_dedup.annotate(none).count() == 0 and exact_dedup.keep_first(none).count() == 0


def test_exact_plan_has_no_python(odd):
    plan = exact_dedup.annotate(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def near_truth(docs):
    """Class of each (id, text) by comparing all pairs."""
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = []
    for i, t in docs:
        w = WORD.findall(t or "")
        bags.append((i, tuple(w), Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))))
    for k, (i, w, s) in enumerate(bags):
        for j, v, u in bags[:k]:
            both = sum((s & u).values())
            if w and (w == v or both and both >= 0.8 * (sum(s.values()) + sum(u.values()) - both)):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in docs}


def family(seed, n, size, edits):
    """Copies of a text with a random number of single-word edits each, repeated words among them."""
    rng = random.Random(seed)
    base = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 40)) for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(size)] = f"new{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_near_classes_against_all_pairs(spark):
    texts = [t for k in range(6) for t in family(k, 40, 90, 4)] + family(7, 60, 100, 9) + ["a b c d e f g " * 20, "a b c d e f g " * 22, "a b c d e f g " * 40]
    docs = list(enumerate(texts, 100))
    got = {r.doc_id: r.class_id for r in bagminhash.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == near_truth(docs)


def test_many_tiles_and_ids_that_are_not_broadcast(spark, monkeypatch):
    texts = [t for k in range(3) for t in family(k, 30, 90, 4)] + family(7, 50, 100, 9)
    docs = list(enumerate(texts, 100))
    monkeypatch.setattr(bagminhash, "TILE", 7)
    monkeypatch.setattr(bagminhash, "BROADCAST_IDS", 0)
    got = {r.doc_id: r.class_id for r in bagminhash.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == near_truth(docs)


def test_tiles_link_texts_at_exactly_the_least_similarity():
    import pyarrow as pa

    for n, same in ((270, 120), (63, 28), (126, 56), (252, 112), (540, 240)):
        sizes = (n // 2, n - n // 2)
        prints = [np.arange(same), np.arange(same)]
        prints = [np.concatenate([p, 10_000 * (k + 1) + np.arange(m - same)]).astype(np.uint32).tobytes() for k, (p, m) in enumerate(zip(prints, sizes))]
        columns = {"group": [1, 1], "band": [0, 0], "doc": [1, 2], "n": list(sizes), "known": [same, same], "comp": [1, 2], "tile": [0, 0], "keys": [[5], [5]]}
        batch = pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), pa.array(prints, pa.binary())], names=[*columns, "prints"])
        found = [tuple(r.values()) for out in bagminhash._pairs_within(0.8)([batch]) for r in out.to_pylist()]
        assert found == [(1, 2, 0.8)]


def test_near_edge_cases(odd, none):
    rows = bagminhash.classes(odd).collect()
    assert len(rows) == odd.count() and bagminhash.classes(none).count() == 0
    of = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert of[1] == of[2] == of[3] == 1 and of[7] == of[8] == 7 and of[11] == of[12] == 11 and of[13] == 13
    assert [of[k] for k in (4, 5, 6)] == [4, 5, 6]
    kept = bagminhash.keep_first(odd)
    assert kept.columns == odd.columns


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    error = []
    for _ in range(30):
        h = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
        a, b = rng.integers(0, 9, len(h)), rng.integers(0, 9, len(h))
        d = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        s = bagminhash.signatures(d, np.concatenate([h[a > 0], h[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 1024)
        error.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(error)) < 0.012 and np.std(error) < 0.03


def test_components_on_a_chain(spark):
    n = 60
    labels = spark.range(n).selectExpr("id as doc", "id as comp")
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, n - 1) if i != 29], "a long, b long")
    got = {r.doc: r.comp for r in components.merge(Scratch(spark), labels, edges, "t").collect()}
    assert got == {i: 0 if i < 30 else 30 for i in range(n)}
