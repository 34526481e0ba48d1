import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import spelling
from quarryline.llm.common import Scratch


def plain_words(rows):
    out = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def truth(rows):
    n = plain_words(rows)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def variants_of(seed, n):
    """Texts with words of few letters and their misspellings, chains of frequent ones among them."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 12))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "abababab", "Équation", "x" * 300]
    rows = []
    for k in range(n):
        own = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.3)), len(base) - 1)]
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b", w[at] * 2]) + w[at + rng.randint(0, 1) :]
            own.append(w)
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("members", [2048, 3])
def test_against_brute_force(spark, odd, none, monkeypatch, members):
    """With shards as they are, and cut again and again."""
    monkeypatch.setattr(spelling, "MEMBERS", members)
    monkeypatch.setattr(spelling, "HELD", 50)
    made = spark.createDataFrame(variants_of(1, 60), "doc_id long, text string")
    rows = made.collect()
    got = sorted(map(tuple, spelling.variants(made).collect()), key=str)
    assert got == truth(rows) and any(r[1] and r[1] != r[2] for r in got) + any(r[1] for r in got)
    if members > 3:
        assert sorted(map(tuple, spelling.variants(odd).collect()), key=str) == truth(odd.collect())
        assert spelling.variants(none).count() == 0


def test_driver_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, spelling.variants(docs).collect()), key=str) == truth(docs.collect())


def test_forms_make_chains(spark):
    counted = spark.createDataFrame([("aaaaaaa", 1000), ("aaaaaab", 100), ("aaaaabb", 10), ("aaaabbb", 1)], "word string, n long")
    scratch = Scratch(spark)
    pairs = {(r.word, r.near) for r in spelling.near(scratch, counted).collect()}
    assert len(pairs) == 6
    forms = spark.createDataFrame([("aaaaaab", "aaaaaaa"), ("aaaaabb", "aaaaaab"), ("aaaabbb", "aaaaabb")], "word string, form string")
    assert {r.root for r in spelling._roots(scratch, forms).collect()} == {"aaaaaaa"}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=6), unique=True, max_size=25), st.integers(2, 5), st.booleans())
def test_pairs_of_a_shard(rests, short, closed):
    rests = sorted(r for r in rests if len(r) in (short, short + 1))
    got = list(spelling.pairs(rests, short, closed))
    assert len(got) == len(set(got))
    want = set()
    for i, a in enumerate(rests):
        for j, b in enumerate(rests):
            if len(a) == short and one_edit(a, b) and (len(b) > short or i < j):
                if not (closed and len(b) > short and b.startswith(a)):
                    want.add((i, j))
    assert set(got) == want
