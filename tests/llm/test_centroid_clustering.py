import hashlib
import math

import numpy as np
import pytest

from squadweave.llm import centroid_clustering as C

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, dimensions, k, rounds, scale=64):
    """Sorted rows of id, cluster, distance, and the centroids, in Python integers."""
    kept = [
        (key, [math.floor(scale * float(np.float32(x))) for x in vector])
        for key, vector in rows
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector)
    ]
    order = lambda row: (hashlib.sha256(f"1:{row[0]}".encode()).hexdigest(), row[1])
    centroids = [vector for _, vector in sorted((row for row in kept if row[0] is not None), key=order)[:k]]
    if not centroids:
        return [], []

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        numbers = [n for _, n in assign()]
        for n in range(len(centroids)):
            own = [v for (_, v), at in zip(kept, numbers, strict=True) if at == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return [(key, n, d) for (key, _), (d, n) in zip(kept, assign(), strict=True)], centroids


def found(spark, rows, dimensions, k, rounds):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clusters, centroids = C.cluster(df, dimensions=dimensions, k=k, rounds=rounds)
    return sorted(map(repr, map(tuple, clusters.collect()))), centroids.tolist()


@pytest.mark.parametrize(("dimensions", "k", "rounds", "spread"), [(3, 5, 3, 9), (2, 16, 4, 3), (8, 40, 2, 2000), (1, 3, 1, 50), (4, 1, 2, 5)])
def test_agrees_with_brute_force(spark, dimensions, k, rounds, spread):
    """Small spreads make many ties and equal centroids."""
    draw = np.random.RandomState(k)
    rows = [(n, (draw.randint(-spread, spread, dimensions) / 64 + 0.001).tolist()) for n in range(250)]
    expected, centroids = brute(rows, dimensions, k, rounds)
    assert found(spark, rows, dimensions, k, rounds) == (sorted(map(repr, expected)), centroids)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 4, 7, 16, 100])
def test_tree_finds_the_nearest(k):
    draw = np.random.RandomState(k)
    for spread in (2, 5, 1000):
        centroids, vectors = draw.randint(-spread, spread, (k, 3)), draw.randint(-spread, spread, (500, 3))
        if not k:
            assert C.VantageTree(centroids).members == []
            continue
        distance = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        number, best = C.VantageTree(centroids).nearest(vectors)
        assert number.tolist() == distance.argmin(axis=1).tolist()
        assert best.tolist() == distance.min(axis=1).tolist()


def test_tree_leaves_nodes_closed(monkeypatch):
    """Far groups of centroids are never opened."""
    opened = []
    inner = C.VantageTree._open
    monkeypatch.setattr(C.VantageTree, "_open", lambda self, node, *rest: (opened.append(len(rest[0])), inner(self, node, *rest)))
    centroids = np.array([[x + 100_000 * group, 0] for group in range(32) for x in range(0, 40, 10)])
    tree = C.VantageTree(centroids)
    number, _ = tree.nearest(centroids)
    assert number.tolist() == list(range(len(centroids)))
    assert sum(opened) < len(centroids) * len(tree.members) / 4


def test_large_components_are_exact():
    a, b = C.LARGEST, -C.LARGEST
    centroids = np.array([[a, a], [b, b], [b, b + 1]])
    number, best = C.VantageTree(centroids).nearest(np.array([[b, b + 1], [a - 1, a], [b, b]]))
    assert number.tolist() == [2, 0, 1] and best.tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        C.scaled(np.array([1e30]), 64)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.25]),
        (1, [0.5, 0.25]),
        (1, [0.125, 0.5]),
        (2, None),
        (3, []),
        (4, [1.0]),
        (5, [1.0, None]),
        (6, [nan, 1.0]),
        (7, [1.0, -inf]),
        (None, [0.5, 0.5]),
        (None, None),
        (8, [-0.001, 0.001]),
        (9, [1.0, 2.0, 3.0]),
    ]
    expected, centroids = brute(rows, 2, 16, 3)
    assert len(centroids) == 4 and len(expected) == 5
    assert found(spark, rows, 2, 16, 3) == (sorted(map(repr, expected)), centroids)

    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("kept").alias(c) for c in ("id", "vector", "cluster", "distance", "n", "total", "at")])
    report = C.report(*C.cluster(df, dimensions=2))
    assert sorted(repr((r.vec_id, r.cluster, r.distance)) for r in report.collect()) == sorted(map(repr, expected))
    assert C.report(*C.cluster(df.limit(0), dimensions=2)).collect() == []
    (one,) = {(r.inertia, sum({x.cluster: x.cluster_inertia for x in report.collect()}.values())) for r in report.collect()}
    assert one[0] == one[1] == sum(d for _, _, d in expected)
