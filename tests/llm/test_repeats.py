import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quarryline.llm import fmindex, lyndon, repeats

WINDOW = 50


def truth(rows, words):
    last = 2**63 - 1
    split = lambda t: (t or "").encode().split() if words else (t or "").encode()
    first = {}
    for r in rows:
        u, d = split(r.text), last if r.doc_id is None else r.doc_id
        for k in range(len(u) - WINDOW + 1):
            key = tuple(u[k : k + WINDOW])
            first[key] = min(first.get(key, last), d)
    out = Counter()
    for r in rows:
        u, d = split(r.text), last if r.doc_id is None else r.doc_id
        gone = np.zeros(len(u), bool)
        for k in range(len(u) - WINDOW + 1):
            if first[tuple(u[k : k + WINDOW])] < d:
                gone[k : k + WINDOW] = True
        left = [x for x, g in zip(u, gone) if not g]
        left = b" ".join(left) if words else bytes(left)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[(r.doc_id, len(u), int(gone.sum()), *([] if words else [runs]), hashlib.sha256(left).hexdigest())] += 1
    return out


def mixed(spark):
    """Passages shared by many documents amid different words, near copies, and periodic texts."""
    rng = random.Random(2)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 60)}" for _ in range(n))
    passages = [text(n) for n in (50, 55, 90)]
    rows = []
    for k in range(60):
        parts = [text(rng.randint(0, 80)), rng.choice(passages), text(rng.randint(0, 20)), rng.choice([passages[0], text(5), "x " * 70, "é" * 90])]
        rows.append((k * 3 % 61, " ".join(parts)))
    for k in range(12):
        w = passages[2].split() * 2
        w[rng.randrange(len(w))] = f"edit{k}"
        rows.append((100 + k, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(params=[1 << 20, 3000])
def blocks(request, monkeypatch):
    """One block, or many small ones."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", request.param)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", request.param)


def test_words_against_brute_force(spark, blocks):
    df = mixed(spark)
    got = Counter(map(tuple, fmindex.remove_repeats(df).collect()))
    assert got == truth(df.collect(), True) and sum(r[2] * n for r, n in got.items())


def test_bytes_against_brute_force(spark, blocks):
    df = mixed(spark)
    assert Counter(map(tuple, lyndon.remove_repeats(df).collect())) == truth(df.collect(), False)


def test_nothing_goes_without_the_engine(spark):
    df, last = mixed(spark), repeats.LAST
    nothing = lambda contents, docs, window: [np.full(len(c), last) for c in contents]
    for words in (True, False):
        assert {r.removed for r in repeats.removed(df, words, nothing).collect()} == {0}


def test_hot_rows_and_ids(spark):
    """A third of the rows repeat one row, a third have no id."""
    rows = mixed(spark).collect()
    many = [(7, rows[3].text)] * 40 + [(None, rows[k].text) for k in range(40)] + [tuple(r) for r in rows[:40]]
    df = spark.createDataFrame(many, "doc_id long, text string")
    assert Counter(map(tuple, fmindex.remove_repeats(df).collect())) == truth(df.collect(), True)


def test_least_documents_of_an_index():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 37, 700)
    matrix = fmindex.WaveletMatrix(values)
    lo = rng.integers(0, 690, 200)
    hi = np.minimum(700, lo + rng.integers(1, 60, 200))
    assert matrix.least(lo, hi).tolist() == [values[i:j].min() for i, j in zip(lo, hi)]


def test_edge_cases(odd, none):
    rows = odd.collect()
    assert Counter(map(tuple, fmindex.remove_repeats(odd).collect())) == truth(rows, True)
    assert Counter(map(tuple, lyndon.remove_repeats(odd).collect())) == truth(rows, False)
    assert fmindex.remove_repeats(none).count() == 0 and lyndon.remove_repeats(none).count() == 0


def test_suffix_array_by_grouping():
    rng = random.Random(0)
    for _ in range(800):
        s = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 50))] + [0]
        assert lyndon.suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda k: s[k:])


def test_index_counts_patterns():
    rng = np.random.default_rng(0)
    text = np.append(rng.integers(1, 5, 300), 0)
    index = fmindex.FMIndex(text, np.zeros(len(text), np.int64), len(text))
    for n in (1, 2, 3, 5):
        for at in range(0, 280, 17):
            lo, hi = np.zeros(1, np.int64), np.array([len(text)])
            for c in text[at : at + n][::-1]:
                lo, hi = index.step(np.array([c]), lo, hi)
            assert hi[0] - lo[0] == sum((text[k : k + n] == text[at : at + n]).all() for k in range(len(text) - n + 1))


def test_short_texts_are_hashed_together(monkeypatch):
    """The hashes of a text are those it has alone, in far fewer calls than there are texts."""
    rng = random.Random(3)
    texts = [b"", b"x" * 49, b"x" * 50, b"y " * 60, b"", b"q" * 40000, b"z" * 7]
    texts += [bytes(rng.choice(b"ab \n") for _ in range(rng.randint(0, 300))) for _ in range(400)]
    least, calls = repeats.tk.sliding_min, []
    monkeypatch.setattr(repeats.tk, "sliding_min", lambda x, width: calls.append(width) or least(x, width))
    for words in (False, True):
        calls.clear()
        together = list(repeats.anchors(texts, words))
        assert len(together) == len(texts) and len(calls) <= 10
        for text, got in zip(texts, together):
            [alone] = repeats.anchors([text], words)
            assert all(a.tolist() == b.tolist() for a, b in zip(alone, got))
            # Equal runs have equal hashes, and runs cover all windows.
            units = len(text.split()) if words else len(text)
            assert len(got[0]) == (units - repeats.PIECE + 1 if units >= WINDOW else 0)
            assert got[1][:1].tolist() == [0] * (units >= WINDOW) and (np.diff(got[1]) > 0).all()


def test_neighbours_that_agree_in_a_window():
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 99, 3000).astype(np.uint8)
    for window in (1, 3, 8, 9, 13):
        at = rng.integers(0, len(raw) - window + 1, 20000)
        views = np.lib.stride_tricks.sliding_window_view(raw, window)
        want = np.append(False, (views[at[1:]] == views[at[:-1]]).all(axis=1))
        assert (lyndon._same(raw, at, window) == want).all()
