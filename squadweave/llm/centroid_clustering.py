"""Centroid clustering by branch and bound on a vantage-point tree.

Vectors are turned into integers, so all distances, sums and means are exact.
Every round a vantage-point tree over the centroids is rebuilt and broadcast,
``k`` centroids and no more. In a task each vector descends best first: of its
open nodes the one with the least bound comes next, until that bound lies
beyond the best distance found. A node whose bound equals it is still opened,
as it may hold a centroid of the same distance and a smaller number. Vectors of
a batch go side by side, those at the same node together.

Sums leave a task as one row per centroid, whatever the size of a cluster, and
``k`` sums reach the driver.

A vector that is null, has another number of components, or a component that is
null or not finite is left out. A null id is clustered like others, but never
starts a centroid. Repeated rows count each time; where an id that starts a
centroid repeats, each of its rows may start one, in the order of components.
With fewer vectors than ``k`` there are as many centroids as vectors; no
vectors give no rows. Other columns are left out. Components beyond 2 ** 27
after scaling have no exact 64-bit distance and raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from squadweave.llm.common import broadcast_state, with_state, written

LARGEST = 1 << 27
# Centroids in a leaf of the tree.
LEAF = 2
# Open nodes, all vectors of a batch together, that are held at once.
OPEN_NODES = 1 << 20
# Distances up to 2 ** 31 have about 52 bits behind the leading one.
SLACK = 1e-12


class VantageTree:
    """Centroids by their distance from vantage points, one of them in every inner node."""

    def __init__(self, centroids: np.ndarray):
        """``centroids`` are rows of integers; a centroid's number is its row."""
        self.centroids = centroids
        self.members: list[list[int]] = []  # of a leaf all its centroids, of an inner node the vantage point
        self.children: list[list[tuple[int, float, float]]] = []  # node, least and greatest distance from the vantage point
        if len(centroids):
            self.build(list(range(len(centroids))))

    def build(self, some: list[int]) -> int:
        node = len(self.members)
        self.members.append(some if len(some) <= LEAF else some[:1])
        self.children.append([])
        if len(some) > LEAF:
            point, rest = some[0], np.array(some[1:])
            distance = np.sqrt(squared(self.centroids[rest], self.centroids[point]).astype(float))
            order = np.argsort(distance, kind="stable")
            for half in np.array_split(order, 2):
                if len(half):
                    child = self.build(rest[half].tolist())
                    self.children[node].append((child, distance[half[0]], distance[half[-1]]))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each vector's nearest centroid, the smallest on ties, and the squared distance."""
        number, best = np.zeros(len(vectors), np.int64), np.full(len(vectors), np.iinfo(np.int64).max)
        step = max(1, OPEN_NODES // max(1, len(self.members)))
        for low in range(0, len(vectors), step):
            self._descend(vectors[low : low + step], number[low : low + step], best[low : low + step])
        return number, best

    def _descend(self, vectors: np.ndarray, number: np.ndarray, best: np.ndarray) -> None:
        bound = np.full((len(vectors), len(self.members)), np.inf)
        bound[:, 0] = 0.0
        going = np.arange(len(vectors))
        while len(going):
            node = bound[going].argmin(axis=1)
            least = bound[going, node]
            promising = np.isfinite(least) & (least <= np.sqrt(best[going].astype(float)) * (1 + SLACK))
            going, node, least = going[promising], node[promising], least[promising]
            bound[going, node] = np.inf
            order = np.argsort(node, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(node[order], prepend=-1)), len(order))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                at = going[order[low:high]]
                self._open(int(node[order[low]]), vectors[at], at, least[order[low:high]], number, best, bound)

    def _open(self, node: int, vectors, at, least, number, best, bound) -> None:
        """Measure the centroids of a node, and bound what its children can hold."""
        for centroid in self.members[node]:
            distance = squared(vectors, self.centroids[centroid])
            nearer = (distance < best[at]) | ((distance == best[at]) & (centroid < number[at]))
            number[at[nearer]], best[at[nearer]] = centroid, distance[nearer]
        from_point = np.sqrt(distance.astype(float))
        for child, nearest, farthest in self.children[node]:
            gap = np.maximum(from_point - farthest, nearest - from_point)
            bound[at, child] = np.maximum(least, gap - SLACK * (from_point + farthest))


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return (apart * apart).sum(axis=1)


def kept(vectors: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    some = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return some.filter((F.size("vector") == dimensions) & F.forall("vector", finite))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    numbers = np.floor(scale * values)
    if np.any(np.abs(numbers) > LARGEST):
        raise ValueError(f"a component beyond {LARGEST} after scaling has no exact distance")
    return numbers.astype(np.int64)


def matrix(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    return scaled(column.flatten().to_numpy().reshape(-1, dimensions), scale)


def starting(some: DataFrame, k: int, salt: str, scale: int) -> np.ndarray:
    """The vectors whose salted ids have the smallest hashes, in that order."""
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = some.filter(F.col("id").isNotNull()).orderBy(order, "vector").limit(k).select("vector").collect()
    return scaled(np.array([row["vector"] for row in first]), scale) if first else np.zeros((0, 0), np.int64)


def moved(some: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The floored mean of each centroid's vectors; one without any stays."""
    dimensions = centroids.shape[1]
    tree = broadcast_state(some.sparkSession, VantageTree(centroids))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = with_state(VantageTree, tree)
        total, n = np.zeros(held.centroids.shape, np.int64), np.zeros(len(held.centroids), np.int64)
        for batch in batches:
            vectors = matrix(batch["vector"], dimensions, scale)
            number, _ = held.nearest(vectors)
            order = np.argsort(number, kind="stable")
            edges = np.flatnonzero(np.diff(number[order], prepend=-1))
            if len(edges):
                total[number[order[edges]]] += np.add.reduceat(vectors[order], edges, axis=0)
            n += np.bincount(number, minlength=len(n))
        some = np.flatnonzero(n)
        columns = [pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    added = some.select("vector").mapInArrow(sums, "cluster long, n long, total array<long>")
    exact = lambda column: F.sum(column.cast("decimal(38,0)"))
    totals = (
        added.select("cluster", "n", F.posexplode("total").alias("at", "value"))
        .groupBy("cluster", "at")
        .agg(exact(F.col("n")).alias("n"), exact(F.col("value")).alias("total"))
    )
    means = centroids.copy()
    for row in totals.collect():
        means[row["cluster"], row["at"]] = int(row["total"]) // int(row["n"])
    return means


def assigned(some: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """``id``, ``cluster``, ``distance`` of every vector."""
    dimensions = centroids.shape[1]
    tree = broadcast_state(some.sparkSession, VantageTree(centroids))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = with_state(VantageTree, tree)
        for batch in batches:
            number, distance = held.nearest(matrix(batch["vector"], dimensions, scale))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(number), pa.array(distance)], ["id", "cluster", "distance"])

    kind = some.schema["id"].dataType.simpleString()
    return some.mapInArrow(nearest, f"id {kind}, cluster long, distance long")


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    salt: str = "1:",
) -> tuple[DataFrame, np.ndarray]:
    """Every vector's cluster and squared distance as ``key``, ``cluster``, ``distance``, and the final centroids.

    Components are ``floor(scale * x)``. Centroids start as the ``k`` vectors
    with the smallest SHA-256 of ``salt`` and id, move ``rounds`` times, and
    take every vector once more.
    """
    some = kept(vectors, key, vector, dimensions)
    centroids = starting(some, k, salt, scale).reshape(-1, dimensions)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(some, centroids, scale)
        found = assigned(some, centroids, scale)
    else:
        found = some.limit(0).select("id", F.lit(0).cast("long").alias("cluster"), F.lit(0).cast("long").alias("distance"))
    return found.withColumnsRenamed({"id": key}), centroids


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with the inertia of its cluster and of all, and the SHA-256 of its centroid's components."""
    spark = found.sparkSession
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    named = spark.createDataFrame(list(enumerate(digests)), "cluster long, centroid_sha256 string")
    found = written(found)
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = F.sum("cluster_inertia").over(Window.partitionBy())
    # One row per centroid.
    known = inertia.join(named, "cluster").withColumn("inertia", whole)
    return found.join(F.broadcast(known), "cluster").select(
        *found.columns, "cluster_inertia", "inertia", "centroid_sha256"
    )
