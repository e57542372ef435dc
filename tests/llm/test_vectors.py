"""Embedding near-dedup and nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import embed_dedup, nearest
from marketlens.llm.components import connected_components

NAN, INF = float("nan"), float("inf")
ODD = [
    (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], None), (5, None, 0),
    (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 0.0], 0), (8, [1.0, NAN, 0.0], 0), (9, [INF, 0.0, 0.0], 0), (10, [], 0),
    (11, [1.0, 0.0], 0), (12, [1e30, 1e28, 0.0], 0), (None, [1.0, 0.0, 0.0], 0), (13, [1.0, 0.0, 0.0], 0), (13, [1.0, 0.0, 0.0], 0),
    (20, [-1.0, 0.5, 0.0], 0),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rows = [(*r, "rank", "score") for r in ODD]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string, id string")


def clusters(seed, n=400, dim=24):
    """Clusters of near copies, pairs close to the threshold on either side, and strangers."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * rng.choice([0.01, 0.15, 0.25, 0.3, 2.0], n)[:, None]
    x[: n // 10] = x[n // 2 : n // 2 + n // 10]  # exact copies
    return x.astype(np.float32), rng.integers(0, 3, n)


@pytest.mark.parametrize("part", [32, 2_048])
def test_links_are_those_of_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(embed_dedup, "PART", part)
    x, label = clusters(part)
    frame = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embed_dedup.link_vectors(frame, 0.93).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(root, np.where(near, root[None], len(x)).min(axis=1))
        if (new == root).all():
            break
        root = new
    assert near.any() and len(got) == len(x)
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), root[i], root[i] == i)


def test_odd_vectors_link_with_nothing(odd_vectors):
    rows = embed_dedup.link_vectors(odd_vectors, 0.93).collect()
    assert len(rows) == len(ODD)
    links = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows}
    # 1, 2, 12 and both rows of 13 lie in one direction
    assert {(i, 4, 1, i == 1) for i in (1, 2, 12, 13)} <= links
    assert {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 20)} | {(None, 0, None, True)} <= links
    assert embed_dedup.link_vectors(odd_vectors.limit(0)).count() == 0


def test_nearest_recall_and_order(spark):
    x, _ = clusters(5, n=1_500, dim=64)
    x *= np.random.default_rng(6).uniform(0.5, 2, (len(x), 1)).astype(np.float32)  # lengths differ
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = nearest.search(frame, F.col("vec_id") % 20 == 0, k=20).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 1_500, 20))
    hit, y = 0, x.astype(float)
    for q, own in found.items():
        own.sort()
        assert [k for k, _, _ in own] == list(range(1, 21)) and q not in [v for _, v, _ in own]
        score = y @ y[q]
        assert all(math.isclose(s, score[v], rel_tol=1e-12) for _, v, s in own)
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
        score[q] = -np.inf
        hit += len({v for _, v, _ in own} & set(np.argsort(-score)[:20].tolist()))
    assert hit / (20 * len(found)) >= 0.9


def test_nearest_in_small_blocks(spark, monkeypatch):
    x, _ = clusters(9, n=300, dim=16)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    query = F.col("vec_id") % 20 == 0
    whole = sorted(nearest.search(frame, query, k=5).collect())
    monkeypatch.setattr(nearest, "CANDIDATES", 40)
    monkeypatch.setattr(nearest, "QUERIES", 4)
    parts = sorted(nearest.search(frame, query, k=5).collect())
    same = len({(r[0], r[2]) for r in whole} & {(r[0], r[2]) for r in parts})
    assert same >= 0.9 * len(whole) and len(parts) == len(whole)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    v, q = rng.normal(size=(2_000, 64)), rng.normal(size=(20, 64))
    low, high = nearest.Codes(v).bounds(q)
    inside = (low <= q @ v.T) & (q @ v.T <= high)
    assert inside.mean() > 0.99


def test_odd_vectors_take_no_part(odd_vectors):
    rows = nearest.search(odd_vectors, F.col("vec_id") % 20 == 0, k=20).collect()
    assert {r["query_id"] for r in rows} == {20}
    assert sorted(r["vec_id"] for r in rows) == [1, 2, 3, 4, 12, 13, 13]  # of its length, without itself
    ties = [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["score"] == -1.0]
    assert ties == [1, 3, 4, 13, 13]
    assert nearest.search(odd_vectors.limit(0), F.lit(True)).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 5), (9, 7)] + [(100 + i, 101 + i) for i in range(60)] + [(300, 300 + i) for i in range(1, 50)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in rows}
    assert {k: got[k] for k in (1, 2, 3, 5, 7, 9)} == {1: 1, 2: 1, 3: 1, 5: 5, 7: 7, 9: 7}
    assert all(got[100 + i] == 100 for i in range(61)) and all(got[300 + i] == 300 for i in range(50))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
