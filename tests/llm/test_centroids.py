"""Clustering against plain integer arithmetic."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercaflow.llm import centroids as module
from mercaflow.llm.centroids import cluster_vectors, with_inertia

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance long"


def order():
    return F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)


def brute_force(rows, k, rounds, dims, scale):
    usable = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: (i is None, "" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centers = [v for _, v in sorted(usable, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = {}
        for _, v in usable:
            members.setdefault(nearest(v)[1], []).append(v)
        centers = [
            [sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centers)
        ]
    return sorted(((i, *nearest(v)[::-1]) for i, v in usable), key=str), centers


def vectors(dims, n=600, seed=3):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [m + rng.gauss(0, 0.2) for m in middles[rng.randrange(6)]]) for i in range(n)]
    hot = rows[5][1]
    rows += [(n + i, hot) for i in range(n // 2)]  # a third of all rows is one vector
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[7][1]), (None, rows[8][1])]
    odd = [None, [], hot[:-1], [*hot, 0.0], [None, *hot[1:]], [math.nan, *hot[1:]], [math.inf, *hot[1:]]]
    return rows + [(10_000 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("dims, k, shard", [(4, 7, 64), (5, 40, 1 << 14)])
def test_clusters(spark, monkeypatch, dims, k, shard):
    monkeypatch.setattr(module, "SHARD", shard)
    rows = vectors(dims)
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA).repartition(3)
    got, centers = cluster_vectors(df, order(), k=k, rounds=3, dims=dims)
    expected, expected_centers = brute_force(rows, k, 3, dims, 256)
    assert centers.tolist() == expected_centers
    assert sorted(map(tuple, got.collect()), key=str) == expected
    total = with_inertia(got, centers).collect()
    assert len(total) == len(expected) and {r.inertia for r in total} == {sum(d for *_, d in expected)}
    for r in total:
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, expected_centers[r.cluster])).encode()).hexdigest()


def test_fewer_vectors_than_centroids_and_none(spark):
    few = spark.createDataFrame([(1, [0.5, 0.0], "", 0), (2, [0.5, 0.0], "", 0), (3, [-1.0, 2.0], "", 0)], SCHEMA)
    got, centers = cluster_vectors(few, order(), k=5, dims=2)
    assert len(centers) == 3 and {r.vec_id: r.distance for r in got.collect()} == {1: 0, 2: 0, 3: 0}
    assert len({r.cluster for r in got.collect() if r.vec_id < 3}) == 1  # the smaller of equal centroids
    got, centers = cluster_vectors(few.filter("false"), order(), dims=2)
    assert got.columns == ["vec_id", "cluster", "distance"] and with_inertia(got, centers).count() == 0


def test_components_that_do_not_fit(spark):
    large = spark.createDataFrame([(1, [1e12, 0.0], "", 0)], SCHEMA)
    with pytest.raises(Exception, match="does not fit"):
        cluster_vectors(large, order(), dims=2)
