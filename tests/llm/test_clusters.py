import hashlib
import math
import random
from collections import Counter

import numpy as np

from siltlake.llm import clusters
from siltlake.llm.vectors import LARGEST

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def usable(v, dims):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < LARGEST for x in v)


def brute(rows, k, rounds, dims, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if usable(v, dims)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in start[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        own = [[] for _ in centers]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(o) for x in zip(*o)] if o else c for c, o in zip(centers, own)]
    return Counter((i, *nearest(v)[::-1]) for i, v in kept), centers


def rows_of(seed, n, dims, spread=0.3):
    rng = random.Random(seed)
    middles = [[rng.uniform(-3, 3) for _ in range(dims)] for _ in range(4)]
    out = [(k, [x + rng.gauss(0, spread) for x in rng.choice(middles)], "x", 1) for k in range(n)]
    out += [(2, middles[0], None, None)] * 6 + [(None, middles[1], None, None)] * 2
    return out + [(900, None, "x", 1), (901, [float("nan")] * dims, "x", 1), (902, [None] * dims, "x", 1), (903, [float("-inf")] * dims, "x", 1), (904, [0.0] * (dims + 1), "x", 1), (905, [], "x", 1), (906, [-1e20] * dims, "x", 1)]


def test_equals_the_definition(spark):
    for seed, spread in ((1, 0.3), (2, 2.0)):
        rows = rows_of(seed, 120, 6, spread)
        state, centers = clusters.sort_means(spark.createDataFrame(rows, SCHEMA), k=5, rounds=4, dims=6)
        expected, means = brute(rows, 5, 4, 6)
        assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in state.collect()) == expected
        assert centers == means


def test_scan_equals_all_comparisons_and_skips_many():
    rng = np.random.default_rng(3)
    middles = rng.integers(-5000, 5000, (30, 8))
    x = (middles[rng.integers(0, 30, 3000)] + rng.integers(-40, 40, (3000, 8))).astype(np.int64)
    far = ((x[:, None] - middles[None]) ** 2).sum(2)
    best, near, looked = clusters.scan(x, far.argmin(1), middles)
    assert (best == far.argmin(1)).all() and (near == far.min(1)).all() and looked < 0.2 * far.size
    for was in (np.zeros(len(x), np.int64), rng.integers(0, 30, len(x))):
        best, near, _ = clusters.scan(x, was, middles)
        assert (best == far.argmin(1)).all() and (near == far.min(1)).all()


def test_ties_go_to_the_smaller_number_even_at_just_twice_the_distance():
    centers = np.array([[0, 0], [4, 0], [2, 2], [4, 0]], np.int64)
    x = np.array([[2, 0], [4, 0], [3, 0]], np.int64)
    for was in range(4):
        best, near, _ = clusters.scan(x, np.full(3, was), centers)
        assert best.tolist() == [0, 1, 1] and near.tolist() == [4, 0, 1]


def test_empty_clusters_keep_their_centroids(spark):
    rows = [(k, [1.0, 1.0]) for k in range(10)]
    state, centers = clusters.sort_means(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3, rounds=3, dims=2)
    assert {(r["cluster"], r["distance"]) for r in state.collect()} == {(0, 0)} and centers == [[1024, 1024]] * 3


def test_fewer_vectors_than_clusters_and_none(spark, tmp_path):
    state, centers = clusters.sort_means(spark.createDataFrame([(1, [0.5, -0.001])], "vec_id long, embedding array<double>"), dims=2)
    assert [tuple(r) for r in state.collect()] == [(1, [512, -2], 0, 0)] and centers == [[512, -2]]
    spark.createDataFrame([(1, [0.5]), (2, None)], "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = clusters.op12_sort_means(spark, str(tmp_path))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and found.collect() == []


def test_the_query_on_edge_rows(spark, tmp_path):
    rows = rows_of(7, 60, 64)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = clusters.op12_sort_means(spark, str(tmp_path)).collect()
    expected, centers = brute(rows, 8, 10, 64)
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in found) == expected
    for r in found:
        own = [d * n for (_, c, d), n in expected.items() if c == r["cluster"]]
        assert r["cluster_inertia"] == sum(own) and r["inertia"] == sum(d * n for (_, _, d), n in expected.items())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest()
