import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import mixing, packing, tokenfiles, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def levels(sizes):
    """Targets by filling up: sources in code point order, null last, weights 5, 2, 1, none above three sizes."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in open_))
        new = {s for s in open_ if weight[s] * level >= 3 * sizes[s]}
        if not new or not open_:
            return {s: 3 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= new


def test_mix_meets_its_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = mixing.copies(docs).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    sizes, took = defaultdict(int), defaultdict(int)
    for r in rows:
        d = texts[r.doc_id]
        assert r.size == len(WORD.findall(d.text or "")) and r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        sizes[d.source] += r.size
        took[d.source] += r.taken
    want = levels(sizes)
    for r in rows:
        s = texts[r.doc_id].source
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * want[s] + 1e-6
    assert all(abs(took[s] - want[s]) <= 0.05 * want[s] + 5 for s in sizes)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.copies(docs).collect()))


def test_mix_without_broadcast_equals_the_small_route(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = sorted(map(tuple, mixing.copies(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, mixing.copies(docs).collect())) == want


def test_rates_are_exponential_in_the_size(spark):
    """Against a plain solver of the dual for one source, before rounding."""
    from quarryline.llm.common import Scratch

    sizes = [(f"{'ab'[k % 2]}", 1 + k * k % 37) for k in range(300)]
    df = spark.createDataFrame(sizes, "source string, size long")
    scratch = Scratch(spark)
    solved = {r.source: r for r in mixing.solve(scratch, df, mixing.targets(scratch, df)).collect()}
    for s, r in solved.items():
        x = np.array([v for t, v in sizes if t == s], float)
        lo, hi = -50.0, 50.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (x * np.minimum(3, np.exp(mid * x / r["mean"]))).sum() < r.target else (lo, mid)
        assert abs(lo - r.lam) < 1e-3


@pytest.mark.parametrize("share", [0.3, 0.5, 0.91, 2.0, 2.63, 2.9])
def test_rates_meet_the_target_with_a_few_very_long_texts(spark, share):
    from quarryline.llm.common import Scratch

    sizes = spark.range(40_000).selectExpr("'a' as source", "100 + id % 301 as size").unionByName(spark.range(10).selectExpr("'a' as source", "1000000L as size"))
    scratch = Scratch(spark)
    sources = mixing.targets(scratch, sizes).withColumn("target", F.col("source_size") * share)
    r = mixing.solve(scratch, sizes, sources).first()
    x = np.array([100 + i % 301 for i in range(40_000)] + [1_000_000] * 10, float)
    took = (x * np.minimum(3, np.exp(np.minimum(2, r.lam * x / r["mean"])))).sum()
    assert abs(took - r.target) <= 1e-5 * r.target


def test_mix_edge_cases(odd, none, spark):
    rows = mixing.copies(odd).collect()
    assert len(rows) == odd.count() and mixing.copies(none).count() == 0
    assert all(r.taken == 0 for r in rows if r.size == 0)
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert sum(len(WORD.findall(r.text or "")) for r in out.collect()) == sum(r.taken for r in rows)
    assert mixing.copies(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).count() == 2


def test_patterns_hold_the_histogram():
    rng = random.Random(1)
    for _ in range(300):
        h = {rng.randint(1, 64): rng.randint(1, 60) for _ in range(rng.randint(1, 30))}
        seen = defaultdict(int)
        for n, parts in packing.patterns(h, 64):
            assert n > 0 and sum(size * k for size, k in parts) <= 64
            for size, k in parts:
                seen[size] += n * k
        assert seen == h


def check_pack(rows, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0, *[r.length for r in s]])[:-1].tolist() and sum(r.length for r in s) <= 4096
    wanted = []
    for i, text in texts:
        ids = np.asarray([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        wanted += [(i, a, min(4096, len(ids) - a), zlib.crc32(ids[a : a + 4096].tobytes()), len(ids)) for a in range(0, len(ids), 4096)]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows), key=key) == sorted(wanted, key=key)
    return seqs


def test_packing_against_the_tokenizer(spark, small, odd, none):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seqs = check_pack(packing.pack_documents(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    used = sum(r.length for s in seqs.values() for r in s)
    assert used >= 0.97 * 4096 * len(seqs)
    check_pack(packing.pack_documents(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("text", ["", " \n", "don't I'LL STRASSE Straße", "<|endoftext|> a<|startoftext|>b <|END", "Σας ﬁ ǅ İstanbul", "áb 12ab3 ..'s", "日本語 \x1c 　x नमस्ते", "x" * 3000])
def test_word_cache_equals_the_tokenizer(text):
    enc = tokens.encoder(packing.tokenizer_path())
    assert enc.by_word
    assert np.frombuffer(enc.encode(text.encode()), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_encode_whole_texts():
    enc = tokens.encoder(packing.tokenizer_path("byte_bpe_50k.json"))
    assert not enc.by_word and np.frombuffer(enc.encode(b" a  b"), "<u4").tolist() == enc.tokenizer.encode(" a  b", add_special_tokens=False).ids


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        assert sorted(tokenfiles.permute(np.arange(n), n).tolist()) == list(range(n))
    assert (tokenfiles.permute(np.arange(1000), 1000, key=1) != tokenfiles.permute(np.arange(1000), 1000, key=2)).mean() > 0.9


def stream_of(rows):
    """The ids of all rows in the order of the files before the permutation."""
    enc = tokens.encoder(packing.tokenizer_path())
    each = [(r.doc_id is None, r.doc_id or 0, np.append(np.frombuffer(enc.encode((r.text or "").encode()), "<u4"), np.uint32(2))) for r in rows]
    each.sort(key=lambda x: (x[0], x[1], zlib.crc32(x[2].astype("<u4").tobytes()), len(x[2])))
    return np.concatenate([x[2] for x in each])


def test_token_files_round_trip(odd, none):
    out, root = tokenfiles.materialise(odd, length=64, per_shard=16)
    rows = sorted(out.collect(), key=lambda r: r.slot)
    seqs = list(tokenfiles.read(root))
    assert [r.slot for r in rows] == list(range(len(seqs)))
    assert tokenfiles.permute(np.asarray([r.sequence for r in rows]), len(rows)).tolist() == [r.slot for r in rows]
    for r, s in zip(rows, seqs):
        assert zlib.crc32(s.tobytes()) == r.crc32 and (s[r.used :] == tokenfiles.PAD_ID).all() and sum(p.length for p in r.parts) == r.used
        assert r.used == 64 or r.sequence == len(rows) - 1
    # All sequences in their order are the stream of all documents, long ones and nulls too.
    back = np.concatenate([s[: r.used] for r, s in sorted(zip(rows, seqs), key=lambda x: x[0].sequence)])
    assert back.tolist() == stream_of(odd.collect()).tolist()
    got = defaultdict(list)
    for r, s in zip(rows, seqs):
        for p in r.parts:
            got[p.doc_id].append((p.start, tuple(s[p.offset : p.offset + p.length].tolist())))
    enc = tokens.encoder(packing.tokenizer_path())
    for d in odd.filter(F.col("doc_id").isin(1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, -14)).collect():
        ids = [x for _, part in sorted(got[d.doc_id]) for x in part]
        assert ids == [*np.frombuffer(enc.encode((d.text or "").encode()), "<u4").tolist(), 2]
    assert all((a == b).all() for a, b in zip(tokenfiles.read(root, 20), seqs[20:]))
    empty, root = tokenfiles.materialise(none)
    assert empty.count() == 0 and list(tokenfiles.read(root)) == []


def test_token_files_do_not_depend_on_partitions(odd):
    first, one = tokenfiles.materialise(odd.repartition(7, "text"), length=64, per_shard=16)
    second, two = tokenfiles.materialise(odd.coalesce(1), one, length=64, per_shard=16)  # the same place: shards are replaced
    assert one == two and sorted(map(str, first.select("slot", "crc32", "used").collect())) == sorted(map(str, second.select("slot", "crc32", "used").collect()))
    third, three = tokenfiles.materialise(odd, length=64, per_shard=16)
    assert all((a == b).all() for a, b in zip(tokenfiles.read(one), tokenfiles.read(three)))
