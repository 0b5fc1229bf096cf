"""Operator 5: blocks of vectors against brute force, and what they cost in disk."""

import os

import numpy as np
import pyarrow as pa
import pytest

from schemelens.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>"


def clustered(rng, n, d):
    """Unit vectors; some near the threshold of another one, some far inside, one crowded neighbourhood, copies by a factor."""
    v = rng.normal(size=(n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for at, width in ((slice(n // 4, n // 2), 0.33), (slice(n // 2, 5 * n // 8), 0.1)):
        near = v[rng.integers(0, n // 8, at.stop - at.start)]
        v[at] = near + width / np.sqrt(d) * rng.normal(size=near.shape)
    v[5 * n // 8:6 * n // 8] = v[0] + 0.15 / np.sqrt(d) * rng.normal(size=(6 * n // 8 - 5 * n // 8, d))
    v = v.astype("<f4")
    v[-n // 16:] = v[n // 4:n // 4 + len(v[-n // 16:])] * np.float32(4)
    return v[rng.permutation(n)]


def brute(v, t=embedding_dedup.THRESHOLD):
    """(links, smallest index in reach) of each vector."""
    x = v.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = x @ x.T >= t
    np.fill_diagonal(m, False)
    low = np.arange(len(v))
    while True:
        new = np.minimum(low, np.where(m, low[None, :], len(v)).min(1))
        if (new == low).all():
            return m.sum(1), low
        low = new


@pytest.mark.parametrize("d", [5, 12, 40])
def test_blocks_find_all_links(spark, monkeypatch, d):
    """Several pivots and blocks, a last block that is larger than the others."""
    monkeypatch.setattr(embedding_dedup, "TILE", 70)
    monkeypatch.setattr(embedding_dedup, "CELL", 9)
    v = clustered(np.random.default_rng(d), 640, d)
    links, low = brute(v)
    df = spark.createDataFrame([(1000 + i, e.tolist()) for i, e in enumerate(v)], SCHEMA)
    got = {r.vec_id - 1000: (r.n_links, r.component_id - 1000, r.kept)
           for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {i: (links[i], low[i], low[i] == i) for i in range(len(v))}
    assert links.max() >= 80


@pytest.mark.parametrize("t", [0.95, 0.6, -0.2])
@pytest.mark.parametrize("kind", ["<f4", "<f8"])
def test_a_pair_of_blocks(monkeypatch, t, kind):
    """Pivots of any kind, far from all vectors too, change no result."""
    monkeypatch.setattr(embedding_dedup, "GROUP", 5)
    monkeypatch.setattr(embedding_dedup, "PRODUCTS", 500)
    rng = np.random.default_rng(1)
    v = clustered(rng, 320, 20).astype(kind) * (1e200 if kind == "<f8" else 1)
    weight = rng.integers(1, 4, len(v))
    axes = np.linalg.qr(rng.normal(size=(20, 20)))[0][:, :embedding_dedup.LEAD]
    links, low = brute(v / np.abs(v).max(1, keepdims=True), t)
    u = embedding_dedup.exact(v)
    m = u @ u.T >= t
    np.fill_diagonal(m, False)
    for pivots in (u[:1], u[::20], -u[::40]):
        s = embedding_dedup.rough(u) @ pivots.astype("<f4").T
        cell, cosine = s.argmax(1).astype("<i4"), s.max(1)
        where = rng.permutation(len(v))
        blocks = []
        for k, at in enumerate(np.split(where, [130])):
            at = at[np.lexsort((cosine[at], cell[at]))]
            raw = (cell[at], cosine[at].astype("<f4"), at.astype("<i8"), weight[at].astype("<i8"), v[at])
            blocks.append(embedding_dedup.Block([k, *(x.tobytes() for x in raw)], 20, kind, axes))
        a, b = blocks
        out = [embedding_dedup.linked(x, y, pivots.astype("<f4"), t) for x, y in ((a, a), (a, b), (b, b))]
        reps, n, lows = (np.concatenate(x) for x in zip(*out))
        total = np.zeros(len(v), int)
        np.add.at(total, reps, n)
        assert (total == (m * weight[None, :]).sum(1)).all()
        parent = np.arange(len(v))
        embedding_dedup._unite(parent, reps, lows)
        assert (embedding_dedup._root(parent, np.arange(len(v))) == low).all()


def test_odd_vectors_are_stored_apart(spark):
    """Null, empty, zero and non-finite vectors have no numbers; directions that are equal have one digest."""
    rows = [(1, [1.0, -0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [None, 1.0]),
            (7, [float("inf"), 1.0]), (8, [3.0, 0.0, 0.0]), (9, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "_key long, vector array<float>").selectExpr("_key", "_key as i", "vector")
    got = {r.i: r for r in embedding_dedup.stored_rows(df, "i", "<f4").collect()}
    assert {i: r.d for i, r in got.items()} == {1: 2, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 3, 9: 2}
    assert got[1].digest == got[2].digest and len({got[i].digest for i in (1, 8, 9)}) == 3
    assert np.frombuffer(got[2].vec, "<f4").tolist() == [2.0, 0.0]


def disk(spark):
    """Bytes in the folders where Spark keeps shuffles."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(os.path.getsize(f"{d}/{f}") for top in found for d, _, names in os.walk(top.getPath()) for f in names)


def test_pairs_of_blocks_are_not_shuffled(spark, monkeypatch):
    """60 blocks: 1,800 pairs of them, whose vectors would be 60 times the input."""
    monkeypatch.setattr(embedding_dedup, "TILE", 50)
    v = np.random.default_rng(9).normal(size=(3000, 64)).astype("<f4")
    table = pa.table({"vec_id": pa.array(range(len(v))), "embedding": pa.array(list(v), pa.list_(pa.float32()))})
    df = spark.createDataFrame(table)
    kept, held = [], embedding_dedup.Scratch.keep

    def keep(self, frame):
        out = held(self, frame)
        kept.append(disk(spark))
        return out

    monkeypatch.setattr(embedding_dedup.Scratch, "keep", keep)
    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), disk(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are larger than it
    try:
        assert embedding_dedup.near_duplicates(df).where("n_links = 0 and kept").count() == len(v)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert max(kept) - before < 4 * v.nbytes
