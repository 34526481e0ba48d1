import threading
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest

from pyspark.sql import functions as F

from quarryline.llm import ann, quality, sharding


def test_quality_on_held_out_rows(spark, small):
    sf = small.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in quality.op9_quality_classifier(spark, sf).collect()}
    marks = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in rows.items())
    held = [(rows[m.doc_id].predicted, m.quality) for m in marks if rows[m.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_scores_do_not_depend_on_neighbours(odd, spark):
    table = np.random.default_rng(0).normal(size=1 << quality.BITS)
    rows = quality.score(odd, table, keep=["doc_id"]).collect()
    assert len(rows) == odd.count()
    for d, r in zip(odd.collect(), rows):
        alone = 1 / (1 + np.exp(-quality.logits([(d.text or "").encode()], table)[0]))
        assert abs(alone - r.score) < 1e-9
    bag = {k: v for k, v in zip(*quality.bags([b"ab ab cd"])[0])}
    assert abs(sum(bag.values()) - 1) < 1e-6


def test_training_without_labels(none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert (quality.fit(none, labels) == 0).all()
    assert quality.judged(none, labels, ["doc_id"]).count() == 0


def truth(vectors, k, divisor):
    ok = {i: np.asarray(v, float) for i, v in vectors if v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in ok:
        if q % divisor == 0:
            s = [(-float((ok[q] * v).sum() / (np.sqrt((ok[q] ** 2).sum()) * np.sqrt((v * v).sum()))), i) for i, v in ok.items() if i != q]
            out[q] = [(i, round(-s_, 9)) for s_, i in sorted((round(a, 12), b) for a, b in s)[:k]]
    return out


def test_search_on_a_small_table_is_exact(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(40)] + [(2000, None), (2050, [0.0] * 8), (2100, [float("nan")] * 8), (2150, [None] * 8), (2200, [1.0, 2.0]), (2250, [1e150] * 8), (50, vectors[50][1])]
    got = {}
    for r in ann.search(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = truth(vectors, 5, 50)
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 5 * len(want)
    assert all([n for n, _, _ in sorted(g)] == [1, 2, 3, 4, 5] for g in got.values())
    assert [v for _, v, _ in sorted(got[1000])] == [7, 1001, 1002, 1003, 1004]


def test_search_among_thousands_of_near_copies(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=64)
    near = (centre * (1 + 0.001 * rng.normal(size=(3000, 64)))).astype(np.float32)
    m = np.concatenate([near, rng.normal(size=(300, 64)).astype(np.float32)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, divisor=100).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    share = []
    for q in range(0, 3000, 100):
        s = u @ u[q]
        s[q] = -2
        share.append(len(got[q] & set(np.argsort(-s)[:5].tolist())) / 5)
    assert np.mean(share) >= 0.95


@pytest.mark.parametrize("n", [0, 1, 2])
def test_search_on_tiny_tables(spark, n):
    df = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<double>")
    assert ann.search(df).count() == n * (n - 1)


def test_compaction_keeps_every_row_and_shrinks(spark, odd, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/s", target=1 << 20)
    for _ in range(5):
        store.append(odd.repartition(2))
    before = store.shards()
    store.compact()
    after = store.shards()
    assert len(after) < len(before) and store.read().count() == 5 * odd.count()
    assert store.read().exceptAll(store.read(5)).count() == 0 and store.read(2).count() == 2 * odd.count()
    store.vacuum()
    assert store.read().count() == 5 * odd.count()
    with pytest.raises(LookupError):
        store.read(2)
    with pytest.raises(sharding.CommitConflict):
        store._commit(store.version() - 1, None, [])


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    """All that start from one version meet at its link: one commits, the others conflict, and what they list is whole."""
    store = sharding.Store(spark, f"file://{tmp_path}/s")
    monkeypatch.setattr(sharding.Store, "version", lambda _: 0)  # as if all had looked before any of them was done
    for base in range(8):
        together = threading.Barrier(4)

        def commit(k, base=base, together=together):
            together.wait()
            try:
                return store._commit(base, str(k), [])
            except sharding.CommitConflict:
                return None

        with ThreadPoolExecutor(4) as pool:
            done = list(pool.map(commit, range(4)))
        assert sorted(done, key=str) == sorted([base + 1, None, None, None], key=str)
        assert store._manifest(base + 1)["schema"] == str(done.index(base + 1))
    monkeypatch.undo()
    assert store.version() == 8 and len(list((tmp_path / "s" / "manifest").iterdir())) == 8


def test_an_old_writer_fails_after_vacuum(spark, odd, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/s")
    for _ in range(3):
        store.append(odd.limit(3))
    store.vacuum()
    with pytest.raises(sharding.CommitConflict):
        store._commit(0, None, [])
    assert store.version() == 3


def test_tiers_merge_similar_sizes_only(spark, tmp_path):
    store = sharding.Store(spark, f"file://{tmp_path}/s", target=1000)
    shard = lambda n, size: sharding.Shard(f"p{n}", size, 0, n)
    runs = store.plan([shard(k, 5) for k in range(4)] + [shard(10 + k, 300) for k in range(3)] + [shard(20, 900)])
    assert [sorted(s.bytes for s in r) for r in runs] == [[5] * 4]


def test_empty_store(spark, none, tmp_path):
    store = sharding.compacted(none, f"file://{tmp_path}/s")
    assert store.read().count() == 0 and store.read().columns == none.columns


def test_contents_stay_whole(spark, odd, tmp_path):
    """Nulls, ties, repeated rows, long texts and clashing names come back as they went in."""
    rows = odd.withColumn("_metadata", F.lit("m")).withColumn("path", F.col("doc_id"))
    store = sharding.compacted(rows.repartition(5), f"file://{tmp_path}/s", target=1 << 16)
    back = store.read()
    assert back.columns == rows.columns and sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_recall_among_12000_vectors(spark):
    """Many more vectors than a beam holds, in clusters of unlike density."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(60, 24)) * 2
    m = np.concatenate([c + rng.normal(size=(200, 24)) * rng.uniform(0.2, 1.5) for c in centres])
    schema = "vec_id long, embedding array<double>, query_id string, score string, node map<string,int>"
    df = spark.createDataFrame([(i, v.tolist(), "q", "s", {"a": 1}) for i, v in enumerate(m)], schema)
    got = {}
    for r in ann.search(df, divisor=100).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    share = []
    for q in range(0, len(m), 100):
        s = u @ u[q]
        s[q] = -2
        share.append(len({v for _, v in got[q]} & set(np.argsort(-s)[:5].tolist())) / 5)
    assert len(share) == 120 and np.mean(share) >= 0.95


def test_training_against_plain_loops():
    """The same steps of gradient descent written out for each feature."""
    rng = np.random.default_rng(2)
    sample = [(int(k % 3 > 0), rng.choice(500, 6, replace=False).astype(np.int32), np.full(6, 1 / 6, np.float32)) for k in range(12)]
    got = quality.train(sample, epochs=2, seed=5)
    rng = np.random.default_rng(5)
    vectors = rng.uniform(-1 / quality.DIM, 1 / quality.DIM, (1 << quality.BITS, quality.DIM)).astype(np.float32).tolist()
    rows = [[0.0] * quality.DIM for _ in range(2)]
    small, large = [k for k, x in enumerate(sample) if x[0] == 0], [k for k, x in enumerate(sample) if x[0] == 1]
    turn = np.asarray([small[k % len(small)] for k in range(len(large))] + large)
    epochs = max(2, -(-quality.STEPS // len(turn)))
    done = 0
    for _ in range(epochs):
        for k in rng.permutation(turn).tolist():
            label, bucket, share = sample[k]
            hidden = [sum(float(w) * vectors[b][d] for b, w in zip(bucket, share)) for d in range(quality.DIM)]
            z = [sum(r[d] * hidden[d] for d in range(quality.DIM)) for r in rows]
            e = [np.exp(x - max(z)) for x in z]
            error = [x / sum(e) - (c == label) for c, x in enumerate(e)]
            step = quality.RATE * (1 - done / (epochs * len(turn)))
            back = [sum(error[c] * rows[c][d] for c in range(2)) for d in range(quality.DIM)]
            for c in range(2):
                rows[c] = [rows[c][d] - step * error[c] * hidden[d] for d in range(quality.DIM)]
            for b, w in zip(bucket, share):
                vectors[b] = [vectors[b][d] - step * float(w) * back[d] for d in range(quality.DIM)]
            done += 1
    want = np.asarray(vectors) @ (np.asarray(rows[1]) - np.asarray(rows[0]))
    assert np.abs(want - got).max() < 0.02 * np.abs(want).max()


def test_quality_stage_with_clashing_columns(spark, odd):
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(1, 14)], "doc_id long, quality int, toxic int")
    rows = odd.withColumn("score", F.lit(7)).withColumn("predicted", F.lit("p")).withColumn("_text", F.lit(None).cast("string")).withColumn("_score", F.lit(1.5)).withColumn("label", F.lit("l"))
    kept = quality.keep_good(rows, labels)
    assert kept.columns == rows.columns and kept.dtypes == rows.dtypes
    assert set(map(str, kept.collect())) <= set(map(str, rows.collect()))
