import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tickwatch.llm import clustering
from tickwatch.llm.clustering import Centroids, spread


def nearest(vector, centroids):
    return min((sum((x - y) ** 2 for x, y in zip(vector, c)), number) for number, c in enumerate(centroids))


def brute(rows, clusters, rounds, size, scale=256, seed="2"):
    """Cluster and distance by vec_id, and the final centroids, in plain whole numbers."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(scale * x) for x in v], v) for i, v in usable]
    named = [row for row in whole if row[0] is not None]
    named.sort(key=lambda row: (hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[2]))
    centroids = [v for _, v, _ in named[:clusters]]
    for _ in range(rounds if centroids else 0):
        members = {}
        for _, v, _ in whole:
            members.setdefault(nearest(v, centroids)[1], []).append(v)
        centroids = [
            [sum(column) // len(members[number]) for column in zip(*members[number])] if number in members else c
            for number, c in enumerate(centroids)
        ]
    if not centroids:
        return [], []
    return sorted(((i, *reversed(nearest(v, centroids))) for i, v, _ in whole), key=repr), centroids


def check(spark, rows, clusters=5, rounds=3, size=4, **how):
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(3)
    got, centroids = clustering.cluster(df, clusters, rounds, size, **how)
    expected, final = brute(rows, clusters, rounds, size)
    assert centroids == final
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=repr) == [
        (i, c, d if d < 1 << 63 else None) for i, c, d in expected
    ]
    return got, centroids


def vectors(count, size, seed, spread_by=1.0):
    source = random.Random(seed)
    return [(i, [round(source.gauss(source.randrange(3), spread_by), 3) for _ in range(size)]) for i in range(count)]


@pytest.mark.parametrize("low, high", [(-3, 3), (-1000, 1000), (-5_000_000, 5_000_000)])
def test_search_equals_all_centroids(low, high):
    source = np.random.default_rng(abs(low))
    block = source.integers(low, high, (3000, 64), endpoint=True)
    # Equal centroids, centroids of equal mean, and a vector that is one.
    centroids = source.integers(low, high, (30, 64), endpoint=True)
    centroids[7] = centroids[3]
    centroids[9] = np.roll(centroids[4], 5)
    block[11] = centroids[7]
    made = Centroids(centroids.tolist())
    assert made.ordinary
    number, best = made.nearest(block.astype(float))
    away = ((block[:, None, :].astype(object) - centroids[None]) ** 2).sum(axis=2) if high > 1000 else (
        (block[:, None, :] - centroids[None]) ** 2
    ).sum(axis=2)
    assert number.tolist() == [int(np.argmin(row.astype(float))) for row in away]
    assert best.tolist() == [float(min(row)) for row in away]
    for at in range(50):
        assert made.nearest_exact(block[at].tolist()) == (number[at], best[at])


def test_centroids_are_rejected_without_a_distance():
    source = np.random.default_rng(1)
    centroids = (source.normal(size=(40, 64)) * 3 + np.arange(40)[:, None] * 50).astype(int)
    made, asked = Centroids(centroids.tolist()), 0
    block = (centroids[source.integers(0, 40, 1000)] + source.integers(-3, 4, (1000, 64))).astype(float)

    class Counted(np.ndarray):
        def __getitem__(self, key):
            nonlocal asked
            asked += len(key)
            return np.asarray(self)[key]

    made.matrix = made.matrix.view(Counted)
    made.nearest(block)
    assert asked <= 3 * len(block)


def test_spread():
    assert spread([1, 2, 6], 9) == 3 * (1 + 4 + 36) - 81


def test_clusters_equal_brute_force(spark):
    check(spark, vectors(400, 4, 1))
    check(spark, vectors(300, 4, 2, 0.01), clusters=40, rounds=5)
    check(spark, vectors(200, 64, 3), clusters=12, size=64)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, []), (3, [1.0, 2.0, 3.0]), (4, [1.0, None, 2.0, 3.0]), (5, [float("nan"), 1.0, 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0, float("-inf")]), (8, [0.0] * 4), (9, [-0.0] * 4),
        (10, [0.001] * 4), (10, [0.5] * 4), (10, [0.5] * 4), (None, [0.5, 0.5, 0.5, 0.4]), (11, [1e30] * 4), (12, [-7e12, 1.0, 2.0, 3.0]),
        (13, [1e30, 1e30, 1e30, 1e15]), (14, [1.0, 2.0, 3.0, 4.0, 5.0]),
    ]
    check(spark, rows, clusters=4)
    check(spark, rows, clusters=40)
    check(spark, [(i, [float(i % 3)] * 4) for i in range(50)], clusters=10)


def test_products_beyond_a_double_are_exact():
    assert clustering.whole(1.5e308, 256) == int(1.5e308) * 256 and clustering.whole(-0.001, 256) == -1


def test_empty_tables_and_rows_without_ids(spark):
    assert clustering.with_inertia(*check(spark, [])).count() == 0
    check(spark, [(None, [1.0] * 4)])
    check(spark, [(1, None)])


def test_inertia_and_digests(spark):
    rows, centroids = check(spark, vectors(90, 4, 5))
    judged = clustering.with_inertia(rows, centroids).collect()
    total, sums = sum(r.distance for r in judged), {}
    for row in judged:
        sums[row.cluster] = sums.get(row.cluster, 0) + row.distance
    for row in judged:
        text = ",".join(map(str, centroids[row.cluster]))
        assert (row.inertia, row.cluster_inertia) == (total, sums[row.cluster])
        assert row.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_clashing_columns_give_way(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x", "y")], "vec_id BIGINT, embedding ARRAY<FLOAT>, Cluster STRING, found STRING")
    rows, _ = clustering.cluster(df, 3, 1, 2)
    assert rows.columns == ["vec_id", "embedding", "found", "cluster", "distance"]
    assert tuple(rows.first()) == (1, [1.0, 2.0], "y", 0, 0)


def test_whole_vectors_of_a_slice():
    array = pa.array([[0.1, 0.2], [0.3, -0.4], [1e20, 1.0]], pa.list_(pa.float32())).slice(1)
    block, large = clustering.whole_vectors(array, 2, 256)
    assert block.tolist() == [[76, -103], [0, 0]] and large == {1: [math.floor(256 * float(np.float32(1e20))), 256]}
