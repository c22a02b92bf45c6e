"""Centroid clusters: the threshold algorithm against all distances, the rounds against plain loops."""

import hashlib
import math

import numpy as np
import pytest

from shelfspark.llm import centroids as ce

SCHEMA = "vec_id long, embedding array<float>, label int"


def all_distances(vectors, centers):
    far = ((vectors[:, None, :] - centers[None]) ** 2).sum(axis=2)
    return far.argmin(axis=1), far.min(axis=1)


@pytest.mark.parametrize("dims, k, n, spread", [(64, 40, 300, 300), (2, 40, 500, 6), (1, 7, 200, 4), (8, 1, 50, 9), (3, 200, 400, 1000), (64, 5, 100, 1 << 26)])
def test_nearest_equals_all_distances(dims, k, n, spread):
    rng = np.random.default_rng(dims * k)
    vectors, centers = rng.integers(-spread, spread, (n, dims)), rng.integers(-spread, spread, (k, dims))
    centers[k // 2] = centers[0]  # equal centroids: the smaller number wins
    who, far, seen = ce.nearest(vectors, centers)
    want, least = all_distances(vectors, centers)
    assert (who == want).all() and (far == least).all()
    assert (seen >= 1).all() and (seen <= k).all()


def test_the_walk_stops_before_all_centroids():
    rng = np.random.default_rng(5)
    centers = rng.integers(-10_000, 10_000, (200, 2))
    vectors = centers[rng.integers(0, 200, 500)] + rng.integers(-20, 20, (500, 2))
    who, far, seen = ce.nearest(vectors, centers)
    assert (far == all_distances(vectors, centers)[1]).all() and seen.mean() < 20


def test_an_equal_frontier_does_not_stop_the_walk():
    # centroid 1 comes up first at distance 9; the unseen centroid 0 is as near
    who, far, _ = ce.nearest(np.array([[0]]), np.array([[3], [-3]]))
    assert (who[0], far[0]) == (0, 9)
    who, far, _ = ce.nearest(np.array([[0]]), np.array([[-3], [3]]))
    assert (who[0], far[0]) == (0, 9)


def by_hand(rows, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centers = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centers = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(centers)]
    out = [(i, near(v)) for i, v in kept]
    inertia = {}
    for _, (d, c) in out:
        inertia[c] = inertia.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()), digest[c]) for i, (d, c) in out)


def result(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_rounds_against_plain_loops(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 64) + (i % 5)]) for i in range(160)]
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [rows[7], rows[7]]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert result(ce.centroid_clusters(df)) == by_hand(rows)


def test_odd_vectors(spark):
    v = [0.5] * 64
    rows = [
        (1, v), (2, None), (3, []), (4, v[:-1]), (5, v + [1.0]), (6, [None] + v[1:]), (7, [math.nan] + v[1:]), (8, [math.inf] + v[1:]),
        (9, [-math.inf] + v[1:]), (None, v), (None, [-0.5] * 64), (1, v), (10, [-0.001] * 64), (11, [1000.0] * 64),
    ]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], SCHEMA)
    clash = df.selectExpr("*", "'x' AS v", "'x' AS cluster", "'x' AS distance", "'x' AS n", "'x' AS s0", "'x' AS inertia", "'x' AS _name")
    got = result(ce.centroid_clusters(clash))
    assert got == by_hand(rows) and len(got) == 6
    assert ce.centroid_clusters(df.limit(0)).collect() == []
    assert ce.centroid_clusters(df.filter("vec_id = 2")).collect() == []


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, 0)], SCHEMA)
    with pytest.raises(Exception, match="too large for exact distances"):
        ce.centroid_clusters(df).collect()
