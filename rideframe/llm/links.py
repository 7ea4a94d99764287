"""Links between items: groups of sorted rows, spanning edges, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rideframe.session import stage

MAX_ROUNDS = 60
LINK_SCHEMA = "node long, links long, root long"


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with the same key, of batches whose equal keys stand together."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if held and keys[first] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[first]
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def common_values(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """How many values each pair of ``n`` rows has in common, from distinct (row, value) pairs.

    Only values that two rows hold count; they are taken some thousand at a time.
    """
    common = np.zeros((n, n), np.float32)
    _, number, counts = np.unique(value, return_inverse=True, return_counts=True)
    row, number = row[counts[number] > 1], number[counts[number] > 1]
    if not len(row):
        return common
    number = np.unique(number, return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    for first in range(0, int(number[-1]) + 1, 4096):
        a, b = np.searchsorted(number, [first, first + 4096])
        held = np.zeros((n, min(4096, int(number[-1]) + 1 - first)), np.float32)
        held[row[a:b], number[a:b] - first] = 1
        common += held @ held.T
    return common


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` positions reaches over the given pairs."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def link_rows(nodes: np.ndarray, weights: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For linked positions: node, weight of its partners, and the node that stands for all it reaches.

    A row per node, however many pairs there are.
    """
    links = np.bincount(left, weights=weights[right], minlength=len(nodes)) + np.bincount(right, weights=weights[left], minlength=len(nodes))
    root = roots(len(nodes), left, right)
    touched = np.zeros(len(nodes), bool)
    touched[left] = touched[right] = True
    at = np.flatnonzero(touched)
    return [(nodes[at], links[at].astype(np.int64), nodes[root[at]])] if len(at) else []


def link_batch(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate([r[i] for r in rows]), pa.int64()) for i in range(3)]
    return pa.RecordBatch.from_arrays(columns, ["node", "links", "root"])


def _seen(edges: DataFrame) -> tuple:
    """The number of edges and the sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node reaches: node, component, for nodes with an edge.

    ``edges`` has columns a and b (long) and is read twice; a pair may come several times. Alternates the two
    star operations until every node points at one that points at none, or nothing changes:
    every larger neighbour of a node is pointed at the node's smallest neighbour,
    then every node's smaller neighbours are. Each half round is written to the shared folder,
    the minima first, so that the join with them can be split at a node with many neighbours.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "minima")
        larger = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(larger.distinct(), "edges")
        low = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")
        seen = _seen(edges)
        if low.count() < seen[0]:
            smaller = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            edges = stage(smaller.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
            seen = _seen(edges)
        # Else every node has one smaller neighbour: the second star changes nothing, and if none of
        # these neighbours has one, neither does any further round.
        elif low.join(low.select(F.col("m").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def summarise(found: DataFrame) -> DataFrame:
    """Links and component of every linked node, from rows of node, links and root."""
    found = stage(found, "links")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return stage(totals.join(parts, "node"), "linked")
