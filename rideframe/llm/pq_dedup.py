"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rideframe.llm.links import LINK_SCHEMA, groups, link_batch, link_rows, summarise
from rideframe.llm.support import reach_workers
from rideframe.session import stage

#: Bound of the sample that the index is fitted on.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 128 << 20
TILE = 1024
SLACK = 1e-6
#: How far, in standard deviations, a neighbour may lie in the direction of another list.
DEVIATIONS = 4.0
MAX_LISTS = 4096


@dataclass(frozen=True)
class Index:
    """Coarse centres and, for each part of the residual, its code words."""

    centres: np.ndarray
    parts: tuple[slice, ...]
    words: tuple[np.ndarray, ...]

    def lists(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to all centres and the nearest one of each row."""
        distance = np.maximum(0, 2 - 2 * unit @ self.centres.T + (self.centres**2).sum(axis=1) - 1)
        return distance, distance.argmin(axis=1)

    def encode(self, unit: np.ndarray, nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the length of what the codes miss."""
        residual = unit - self.centres[nearest]
        codes = np.zeros((len(unit), len(self.parts)), np.uint8)
        missed = np.zeros(len(unit))
        for k, (part, words) in enumerate(zip(self.parts, self.words)):
            distance = _squared(residual[:, part], words)
            codes[:, k] = distance.argmin(axis=1)
            missed += ((residual[:, part] - words[codes[:, k]]) ** 2).sum(axis=1)
        return codes, np.sqrt(missed)

    def tables(self, unit: np.ndarray, centre: int) -> list[np.ndarray]:
        """Squared distances from each row's residual to all code words, part by part."""
        residual = unit - self.centres[centre]
        return [_squared(residual[:, part], words) for part, words in zip(self.parts, self.words)]

    def probes(self, distance: np.ndarray, nearest: np.ndarray, reach: float) -> np.ndarray:
        """Lists behind whose plane a vector within ``reach`` may lie: row by list.

        A vector of list j is nearer to centre j than to any other, so it lies beyond the
        plane halfway between j and the query's own centre; the query's distance to that
        plane is compared with the reach.
        """
        own = distance[np.arange(len(nearest)), nearest]
        apart = np.sqrt(_squared(self.centres, self.centres))[nearest]
        with np.errstate(divide="ignore", invalid="ignore"):
            to_plane = (distance - own[:, None]) / (2 * apart)
        return ~(to_plane > reach + SLACK)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T)


def _centres(points: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means; a centre that loses all points keeps its place."""
    centres = points[rng.choice(len(points), min(count, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _squared(points, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.stack([np.bincount(nearest, weights=points[:, d], minlength=len(centres)) for d in range(points.shape[1])], axis=1)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], centres)
    return centres


def fit_index(sample: np.ndarray, n_lists: int, n_parts: int, n_words: int = 64, seed: int = 3) -> Index:
    rng = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centres = _centres(unit, n_lists, rng)
    residual = unit - centres[_squared(unit, centres).argmin(axis=1)]
    edges = np.linspace(0, sample.shape[1], min(n_parts, sample.shape[1]) + 1).astype(int)
    parts = tuple(slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()))
    return Index(centres, parts, tuple(_centres(residual[:, p], n_words, rng) for p in parts))


def lists_for(n: int) -> int:
    """Lists for so many vectors: about half the square root, a power of two."""
    return int(np.clip(2 ** round(np.log2(max(1.0, np.sqrt(n) / 2))), 8, MAX_LISTS))


def reach_for(radius: float, length: int, deviations: float | None) -> float:
    """How far behind a plane a vector within ``radius`` is looked for.

    Of a difference in any direction alike, the part along one given direction has a standard
    deviation of radius / sqrt(length). Without ``deviations`` it is the whole radius, and no list is lost.
    """
    return radius if deviations is None else min(radius, deviations * radius / np.sqrt(length))


def _matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(float)


def _normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.98, n_lists: int | None = None, n_parts: int = 16, deviations: float | None = DEVIATIONS) -> DataFrame:
    """Links between vectors of equal label and length with a cosine of ``threshold`` or more.

    ``vectors`` has vec_id, embedding and label. Returns vec_id, n_links, component_id (the smallest
    id reachable), kept (vec_id = component_id) for every row. A row without id or label, or whose vector is
    null, empty, zero or has a null or non-finite component, links with nothing. Rows that
    repeat an id and a vector are counted as copies; an id with several vectors has a row for each, which are linked on
    their own.

    Copies of a vector become one row with their number. Every length has an index of its own, fitted on at most
    20,000 vectors and 128 MB, and holding all; ``n_lists`` follows from the number of vectors, about half its square root. A vector is compared with
    its own list and with the lists of larger number that a neighbour may lie in: those whose plane is within
    ``deviations`` standard deviations of a link's length in a direction drawn alike from all, which four leave
    one pair in 30,000 beyond; in 16 dimensions and fewer, or with None, that is the whole
    length and no pair is lost. The distance to a code, less what that code misses, is
    a lower bound, so none is lost to the codes; what remains is decided by the exact cosine.
    Lists are compared in tiles of about 1024 by 1024 vectors, and a tile gives one row per linked
    vector, not per pair, so a list or a copy group of any size is spread over many tasks.
    """
    spark = vectors.sparkSession
    reach_workers(spark)
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats are moved as they are
    source = vectors.select(F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    digest = F.sha2(F.concat_ws(",", F.col("embedding").cast("array<double>").cast("array<string>")), 256)
    # A row that cannot link has no digest; the label is part of it.
    keyed = source.withColumn("key", F.when(usable, F.concat_ws("/", F.col("label").cast("string"), digest)))
    classes = keyed.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("label").cast("string").alias("label"), F.first("embedding").alias("embedding")
    )
    # A vector has a number of its own: one id may stand for several vectors.
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("length", F.size("embedding")), "vector-classes")
    lengths = classes.groupBy("length").count().filter("count > 1").orderBy("length").collect()
    found = spark.createDataFrame([], LINK_SCHEMA)
    for row in lengths:
        lists = n_lists or lists_for(row["count"])
        found = found.unionAll(_links(classes.filter(F.col("length") == row.length), row.length, kind, threshold, lists, n_parts, deviations))
    linked = summarise(found).join(classes.select("node", "vec_id"), "node")
    firsts = linked.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = linked.join(firsts, "component").select("node", "links", "component_id")
    known = classes.select("key", "node", "copies", "vec_id").join(linked, "node", "left")
    known = stage(known.select("key", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component_id", "vec_id").alias("component_id")), "vector-links")
    rows = keyed.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _links(classes: DataFrame, length: int, kind: str, threshold: float, n_lists: int, n_parts: int, deviations: float | None) -> DataFrame:
    """Links among distinct vectors of one length: rows of node, links, root."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    reach = reach_for(radius, length, deviations)
    sampled = max(n_lists, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * length)))
    sample = classes.select("node", "embedding").orderBy(F.xxhash64("node"), "node").limit(sampled).select("embedding").toArrow()
    index = fit_index(_normalised(_matrix(sample.column(0))), n_lists, n_parts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _normalised(_matrix(batch.column("embedding")))
            distance, nearest = index.lists(unit)
            codes, missed = index.encode(unit, nearest)
            # Of two lists the one of larger number is asked; the own one always is.
            probe = index.probes(distance, nearest, reach) & (np.arange(distance.shape[1])[None, :] >= nearest[:, None])
            columns = {name: batch.column(name) for name in ("node", "copies", "label", "embedding")}
            columns["list"] = pa.array(nearest.astype(np.int32))
            columns["codes"] = pa.array([c.tobytes() for c in codes], pa.binary())
            columns["missed"] = pa.array(missed)
            columns["probes"] = pa.array([np.flatnonzero(p).astype(np.int32) for p in probe], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"node long, copies long, label string, embedding {kind}, list int, codes binary, missed double, probes array<int>"
    placed = stage(classes.select("node", "copies", "label", "embedding").mapInArrow(place, schema), "vector-index")
    asked = placed.select("node", "copies", "label", F.explode("probes").alias("list"))
    # How many tiles each side of a list takes: one row per label and list.
    stored_in = placed.groupBy("label", "list").agg(F.count("*").alias("n_stored"))
    asked_in = asked.groupBy("label", "list").agg(F.count("*").alias("n_asked"))
    sizes = stored_in.join(asked_in, ["label", "list"])
    sizes = stage(sizes.select("label", "list", F.ceil(F.col("n_stored") / TILE).cast("int").alias("across"), F.ceil(F.col("n_asked") / TILE).cast("int").alias("down")), "vector-tiles")

    def tiled(rows: DataFrame, own: str, other: str, asking: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
        rows = rows.join(sizes, ["label", "list"]).withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        column, line = ("theirs", "mine") if asking else ("mine", "theirs")
        return rows.select(F.concat_ws("/", column, line, "list", "label").alias("tile"), F.lit(asking).alias("asking"), "node", "copies", "list", "home", "codes", "missed", "embedding")

    stored = tiled(placed.withColumn("home", F.col("list")), "across", "down", False)
    queries = placed.withColumn("home", F.col("list")).withColumn("list", F.explode("probes")).withColumn("codes", F.lit(None).cast("binary")).withColumn("missed", F.lit(None).cast("double"))
    queries = tiled(queries, "down", "across", True)
    rows = stored.unionAll(queries).repartition("tile").sortWithinPartitions("tile", "asking", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, "tile"):
            out = compare_tile(tile, index, threshold, radius)
            if out:
                yield link_batch(out)

    return rows.mapInArrow(compare, LINK_SCHEMA)


def compare_tile(tile: pa.Table, index: Index, threshold: float, radius: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links between the asking vectors of one tile and its stored ones, each pair once."""
    asking = tile.column("asking").to_numpy()
    nodes = tile.column("node").to_numpy()
    unit = _normalised(_matrix(tile.column("embedding")))
    stored, asked = np.flatnonzero(~asking), np.flatnonzero(asking)
    if not len(stored) or not len(asked):
        return []
    kept = tile.filter(pa.array(~asking))
    codes = np.frombuffer(b"".join(kept.column("codes").to_pylist()), np.uint8).reshape(len(stored), -1)
    here = tile.column("list")[0].as_py()
    tables = index.tables(unit[asked], here)
    estimate = np.zeros((len(asked), len(stored)))
    for k, table in enumerate(tables):
        estimate += table[:, codes[:, k]]
    near = np.sqrt(estimate) - kept.column("missed").to_numpy()[None, :] <= radius + SLACK
    # Two vectors of this list ask for each other.
    once = (nodes[asked][:, None] < nodes[stored][None, :]) | (tile.column("home").to_numpy()[asked] != here)[:, None]
    a, b = np.nonzero(near & once)
    a, b = asked[a], stored[b]
    linked = np.concatenate([np.einsum("ij,ij->i", unit[a[i : i + 65536]], unit[b[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)]) >= threshold
    # The same vector may ask and be stored here: one position for both.
    names, first, place = np.unique(nodes, return_index=True, return_inverse=True)
    return link_rows(names, tile.column("copies").to_numpy()[first], place[a[linked]], place[b[linked]])
