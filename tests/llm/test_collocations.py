import random
import re
from collections import Counter

import pytest

from quarryline.llm import collocations


def truth(rows, least=100, top=2000):
    counts, total = {}, Counter()
    for r in rows:
        lang = r.lang if r.lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for size in range(1, 6):
                for k in range(len(w) - size + 1):
                    own = counts.setdefault(lang, Counter())
                    own[tuple(w[k : k + size])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    most[p[k : k + size]] = max(most[p[k : k + size]], a)
        scored = []
        for p, a in found.items():
            if 100 * most[p] >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def texts(seed, n):
    """Words with overlaps of themselves, marks, other white space, prefixes of each other and letters beyond A to Z."""
    rng = random.Random(seed)
    words = ["a", "aa", "a", "the", "The", "THE", "Élan", "élan", "new", "york", "new", "city", "b c", "x-y", "aé"]
    rows = []
    for k in range(n):
        own = []
        for _ in range(rng.randint(0, 40)):
            own.append("New york city hall of fame" if rng.random() < 0.06 else "a a a a" if rng.random() < 0.05 else rng.choice(words))
            own.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", " ; "]))
        rows.append((k, "".join(own), rng.choice(["en", "fr", None, "und"]), "s"))
    return rows


@pytest.mark.parametrize("shard, automaton, width, passing", [(4 << 20, 50_000, 3, 1 << 26), (200, 3, 3, 1 << 26), (900, 50_000, -60, 1 << 26), (200, 50_000, 3, -1)])
def test_against_brute_force(spark, monkeypatch, shard, automaton, width, passing):
    """As it is; with many small shards and automata; with a sketch in which nearly all cells are shared; with cells that
    are joined, as too many pass for a bitmap."""
    monkeypatch.setattr(collocations, "PASSING", passing)
    monkeypatch.setattr(collocations, "SHARD", shard)
    monkeypatch.setattr(collocations, "HELD", 4 * shard)
    monkeypatch.setattr(collocations, "AUTOMATON", automaton)
    monkeypatch.setattr(collocations, "WIDTH", width)
    docs = spark.createDataFrame(texts(4, 250), "doc_id long, text string, lang string, phrase string")
    rows = docs.collect()
    got = sorted(map(tuple, collocations.collocations(docs, least=4).collect()))
    assert got == truth(rows, least=4) and len(got) > 30
    assert sorted(map(tuple, collocations.collocations(docs, least=4, top=7).collect())) == truth(rows, least=4, top=7)


def test_odd_rows(spark, odd, none):
    assert sorted(map(tuple, collocations.collocations(odd, least=2).collect())) == truth(odd.collect(), least=2)
    assert collocations.collocations(none).count() == 0


def test_pieces():
    assert collocations.pieces("Ab\tC  d, É.\x0bF g!!".encode()) == ["ab c d".encode(), "É".encode(), "f g".encode()]
    assert collocations.pieces(None) == []


def test_query_equals_its_sql(spark):
    import duckdb

    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    df = collocations.op11_collocations(spark, path)
    sql = con.sql(collocations.SQL)
    assert sql.columns == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(sql.fetchall())


def test_rows_of_shards_are_bounded(monkeypatch):
    """A shard's cells leave in rows of CELLS, and its phrases are strings AUTOMATON at a time, whatever passes."""
    import numpy as np
    import pyarrow as pa

    class All:
        def among(self, cells, passed):
            return np.ones(len(cells), bool)

    monkeypatch.setattr(collocations, "CELLS", 5)
    monkeypatch.setattr(collocations, "AUTOMATON", 7)
    rng = random.Random(3)
    text = "\n".join(" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(9))
    shard = pa.RecordBatch.from_pydict({"shard": [4], "lang": ["en"], "text": [text.encode()], "words": [list("abcdefgh")]})
    pairs = list(collocations._pairs(20, All())([shard]))
    assert max(len(b.column("cells")[0]) for b in pairs) == 5 and sum(b.column("ids").null_count == 0 for b in pairs) == 1
    assert sum(sum(b.column("counts")[0].as_py()) for b in pairs) == 9 * 29
    longer = list(collocations._longer(20, All(), 5)(pairs[:1]))
    assert max(len(b.column("cells")[0]) for b in longer) == 5 and len(longer) > 100
    found = list(collocations._count(20, All(), 5)(longer[:1]))
    assert max(b.num_rows for b in found) == 7
    want = Counter(" ".join(line.split()[k : k + n]) for line in text.split("\n") for n in range(2, 6) for k in range(31 - n))
    assert {(r["size"], r["phrase"]): r["n"] for b in found for r in b.to_pylist()} == {(len(p.split()), p): n for p, n in want.items()}
