"""Centroid clustering of integer vectors: vantage-point tree over the centroids, exact distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rideframe.llm.support import reach_workers
from rideframe.session import stage

#: Centroids of a leaf, whose distances are all taken.
LEAF = 4
#: Components up to here leave squared distances of any usual length within 64 bits.
LARGEST = 1 << 24
#: Square roots are rounded; a bound that is closer than this share is not trusted to exclude.
SLACK = 1e-9
BATCH = 2048


@dataclass(frozen=True)
class VantageTree:
    """Centroids by their distances from vantage points.

    Node ``i`` has a vantage centroid and two children, or the centroids of a leaf. ``shells``
    has for each child the least and the greatest distance of its centroids from the vantage
    point. Node 0 is the root; a child always has a larger number than its parent.
    """

    centroids: np.ndarray
    vantage: np.ndarray
    children: np.ndarray
    shells: np.ndarray
    leaves: tuple[np.ndarray, ...]


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of 64-bit integers, row by row of both, with broadcasting."""
    apart = vectors - centroids
    return np.einsum("...i,...i->...", apart, apart)


def build_tree(centroids: np.ndarray, leaf: int = LEAF) -> VantageTree:
    """The centroid farthest from the mean of its node is the vantage point; the others are halved by distance."""
    vantage, children, shells, leaves = [], [], [], []

    def add(members: np.ndarray) -> int:
        node = len(vantage)
        vantage.append(-1)
        children.append((-1, -1))
        shells.append(((0.0, 0.0), (0.0, 0.0)))
        leaves.append(members if len(members) <= leaf else members[:0])
        if len(members) <= leaf:
            return node
        own = centroids[members]
        point = members[int(np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1)))]
        rest = members[members != point]
        distance = np.sqrt(squared_distances(centroids[rest], centroids[point]).astype(float))
        order = np.argsort(distance, kind="stable")
        halves = np.array_split(order, 2)
        vantage[node] = int(point)
        shells[node] = tuple((float(distance[h].min()), float(distance[h].max())) for h in halves)
        children[node] = tuple(add(np.sort(rest[h])) for h in halves)
        return node

    add(np.arange(len(centroids)))
    return VantageTree(centroids, np.array(vantage), np.array(children).reshape(-1, 2), np.array(shells).reshape(-1, 2, 2), tuple(leaves))


def nearest(vectors: np.ndarray, tree: VantageTree) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, the smaller number of equal ones.

    Every vector has its own queue of nodes with the least distance that their centroids can
    have, and takes the node with the smallest bound next, until no bound is within its best
    distance. A bound equal to the best distance is still followed, as the centroid there may
    have a smaller number. All vectors of a batch take their steps together. The third value
    counts the distances taken.
    """
    n, n_nodes = len(vectors), len(tree.vantage)
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, len(tree.centroids), np.int64)
    bounds = np.full((n, n_nodes), np.inf)
    bounds[:, 0] = 0.0
    taken = 0
    active = np.arange(n)

    def offer(rows: np.ndarray, centroid: int) -> np.ndarray:
        found = squared_distances(vectors[rows], tree.centroids[centroid])
        closer = (found < best[rows]) | ((found == best[rows]) & (centroid < number[rows]))
        best[rows[closer]], number[rows[closer]] = found[closer], centroid
        return found

    while len(active):
        node = bounds[active].argmin(axis=1)
        bound = bounds[active, node]
        within = bound <= np.sqrt(best[active].astype(float)) * (1 + SLACK) + SLACK
        within &= np.isfinite(bound)
        active, node, bound = active[within], node[within], bound[within]
        bounds[active, node] = np.inf
        for here in np.unique(node).tolist():
            rows = active[node == here]
            if len(tree.leaves[here]):
                for centroid in tree.leaves[here].tolist():
                    offer(rows, centroid)
                taken += len(rows) * len(tree.leaves[here])
                continue
            point = int(tree.vantage[here])
            distance = np.sqrt(offer(rows, point).astype(float))
            taken += len(rows)
            inherited = bound[node == here]
            for child, (least, most) in zip(tree.children[here].tolist(), tree.shells[here].tolist()):
                gap = np.maximum(least - distance, distance - most) - SLACK * (distance + most)
                bounds[rows, child] = np.maximum(inherited, np.maximum(gap, 0.0))
    return number, best, taken


def integer_vectors(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """vec_id and components ``floor(scale * x)`` of the vectors that can be clustered."""
    source = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < LARGEST / scale, F.lit(False)))
    kept = source.filter(F.coalesce((F.size("embedding") == dimensions) & usable, F.lit(False)))
    return kept.select("vec_id", F.transform("embedding", lambda x: F.floor(x * float(scale)).cast("int")).alias("point"))


def start_order(vec_id: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def _matrix(points: pa.Array) -> np.ndarray:
    return points.flatten().to_numpy(zero_copy_only=False).reshape(len(points), -1).astype(np.int64)


def _moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. Each task sends one row per cluster and component."""
    tree = points.sparkSession.sparkContext.broadcast(build_tree(centroids))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = tree.value.centroids.shape
        counts, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH):
                vectors = _matrix(batch.column("point").slice(first, BATCH))
                number = nearest(vectors, tree.value)[0]
                counts += np.bincount(number, minlength=k)
                np.add.at(total, number, vectors)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": np.repeat(used, d),
                "component": np.tile(np.arange(d), len(used)),
                "n": np.repeat(counts[used], d),
                "total": total[used].ravel(),
            }
        )

    found = points.select("point").mapInArrow(sums, "cluster long, component long, n long, total long")
    # A row per cluster and component, however many vectors there are.
    merged = found.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    moved = centroids.copy()
    for row in merged.collect():
        moved[row.cluster, row.component] = int(row.total) // row.n
    tree.unpersist()
    return moved


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dimensions: int = 64, scale: int = 256) -> DataFrame:
    """Lloyd's rounds over integer vectors, exact to the last digit.

    Keeps the rows whose embedding has exactly ``dimensions`` components, none null or
    non-finite, and works on ``floor(scale * x)``. The ``k`` vectors with the smallest SHA-256
    of ``<seed>:<vec_id>`` are the first centroids, in that order (equal ids by components; a
    null id counts as an empty one); with fewer vectors there are fewer. A round assigns every
    vector to the nearest centroid, the smaller number of equal ones, and moves each centroid
    that has vectors to their mean, rounded down. Returns vec_id, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256 for every kept row, after one more assignment.

    Each round builds a vantage-point tree over the centroids on the driver and broadcasts it:
    ``k`` vectors, whatever the table holds. Every vector searches the tree best first. Tasks
    send sums per cluster, so a cluster of any size is summed where its vectors lie; sums and
    counts are integers, so neither the order of rows nor a repeated task changes a digit.

    Rows with a component of 2^24 or more after scaling are left out like those that are not
    finite, as their squared distances need not fit 64 bits. Repeated rows are kept, each on
    its own; further columns are ignored; a table without a usable vector gives no rows.
    """
    if k < 1 or not 1 <= dimensions <= 4096:
        raise ValueError("at least one centroid, and 1 to 4096 dimensions")
    reach_workers(vectors.sparkSession)
    points = stage(integer_vectors(vectors, dimensions, scale), "points")
    starts = points.orderBy(start_order(F.col("vec_id"), seed), "point").limit(k).select("point").collect()
    centroids = np.array([row.point for row in starts], np.int64).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        moved = _moved(points, centroids)
        if np.array_equal(moved, centroids):
            break  # further rounds would change nothing
        centroids = moved
    tree = points.sparkSession.sparkContext.broadcast(build_tree(centroids)) if len(centroids) else None
    digests = pa.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()], pa.string())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH):
                part = batch.slice(first, BATCH)
                number, distance, _ = nearest(_matrix(part.column("point")), tree.value)
                columns = {"vec_id": part.column("vec_id"), "cluster": number.astype(np.int32), "distance": distance, "centroid_sha256": digests.take(pa.array(number))}
                yield pa.RecordBatch.from_pydict(columns)

    assigned = stage(points.mapInArrow(assign, "vec_id long, cluster int, distance long, centroid_sha256 string"), "assigned")
    clusters = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # One row per centroid that has vectors, here and in the broadcast.
    whole = Window.orderBy("cluster").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = clusters.withColumn("inertia", F.sum("cluster_inertia").over(whole))
    return assigned.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
