"""N-gram Jaccard join by chosen paths: split sets on sampled shared tokens, compare small buckets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rideframe.llm.links import LINK_SCHEMA, common_values, groups, link_batch, link_rows, summarise
from rideframe.llm.pivot_rings import differences, pivots_of, proven_links, ring_links
from rideframe.llm.support import filled, reach_workers, split_words, text_slices
from rideframe.session import stage, stage_sized

WORDS = 5
COORDINATES = 64
BUCKET = 512
DEPTH = 4
#: Pivots that a dense bucket is tried with, one after another.
PIVOT_ROUNDS = 3
#: Members of dense buckets whose texts are found by a broadcast of their ids: so many bytes as written.
FEW_BYTES = 16 << 20
#: A pair is looked at exactly if at least this share of the sampled tokens agrees: at a
#: similarity of 0.8 the share lies four standard deviations higher.
SKETCH_SHARE = 0.6
STRIDE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
LARGEST = (1 << 63) - 1


def survival(similarity: float, depth: int) -> float:
    """Chance that a pair still shares a node of one tree after ``depth`` levels.

    A node has one child, and a second one with chance 1 / similarity - 1, and the pair keeps
    each with chance ``similarity``.
    """
    second = 1 / similarity - 1
    lost = 0.0
    for _ in range(depth):
        single = 1 - similarity + similarity * lost
        lost = single * (1 - second + second * single)
    return 1 - lost


def runs_for(recall: float, similarity: float, depth: int = DEPTH) -> int:
    """Trees that find a pair of this similarity with the given chance, at full depth.

    The trees take their orders from the same 64, so they are not quite independent: half of
    the pairs that may be missed are allowed for that.
    """
    return math.ceil(math.log((1 - recall) / 2) / math.log(1 - survival(similarity, depth)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(32))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets and hashes of all five-word shingles, and row offsets and hashes of the words.

    Words are runs of anything but ASCII white space, in lower case. A text of one to four
    words has one shingle of all its words; a text without a word has none.
    """
    offsets, codes, words = split_words(pc.utf8_lower(texts))
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    word = of_word[codes]
    n_words = np.diff(offsets)
    rows = np.repeat(np.arange(len(texts)), n_words)
    place = np.arange(len(word))
    value = np.zeros(len(word), np.uint64)
    padded = np.concatenate([word, np.zeros(WORDS, np.uint64)])
    for k in range(WORDS):
        inside = place + k < offsets[1:][rows]
        value = np.where(inside, _mixed(value * STRIDE + padded[k : k + len(word)] + np.uint64(k + 1)), value)
    starts = (place + WORDS <= offsets[1:][rows]) | (place == offsets[:-1][rows])
    ends = np.concatenate([[0], np.cumsum(starts)])
    return ends[offsets], value[starts], offsets, word


def word_keys(offsets: np.ndarray, words: np.ndarray) -> pa.Array:
    """A digest of the words of each row; null for a row without a word."""
    return pa.array([xxhash.xxh3_128_digest(words[a:b].tobytes()) if b > a else None for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())


def sketches(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each row with shingles and each of 64 orders of all tokens, the row's first token."""
    out = np.zeros((len(offsets) - 1, COORDINATES), np.int32)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    salts = _mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * STRIDE)
    for k, salt in enumerate(salts):
        order = (hashes ^ salt) * MIX
        order ^= order >> np.uint64(29)
        order *= STRIDE
        low = np.minimum.reduceat(order, offsets[:-1][full])
        out[full, k] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _children(path: Column, sketch: Column, similarity: float) -> Column:
    """The child nodes that a set goes to: its first token in an order sampled for the node.

    The path decides which orders are used, so all sets at a node use the same ones.
    """

    def child(tag: str) -> Column:
        order = F.pmod(F.xxhash64(path, F.lit(tag)), F.lit(COORDINATES)).cast("int")
        return F.xxhash64(path, order, F.element_at(sketch, order + 1))

    second = F.pmod(F.xxhash64(path, F.lit("second?")), F.lit(10_000)) < int(10_000 * (1 / similarity - 1))
    # The two may take the same order and so be one child.
    return F.when(second, F.array_distinct(F.array(child("first"), child("second")))).otherwise(F.array(child("first")))


def _leaves(classes: DataFrame, similarity: float, runs: int) -> tuple[DataFrame, DataFrame | None]:
    """The buckets to compare, and those above the limit at the last level, if any: path, node, size.

    Buckets above the limit are split on, level by level. A set that is alone in its bucket is done.
    """
    start = F.explode(F.array(*[F.xxhash64(F.lit(f"run {r}")) for r in range(runs)]))
    level = classes.select("node", "sketch", start.alias("path"))
    leaves = None
    for depth in range(1, DEPTH + 1):
        # Children of different paths differ, and those of one path are told apart: no row comes twice.
        members = level.select("node", F.explode(_children(F.col("path"), F.col("sketch"), similarity)).alias("path"))
        if depth > 1:  # written once, as the join for it is not to be made for the sizes and again for the members
            members = stage(members, "path-children")
        members = _sized(members, "path-members")
        done = members.filter(F.col("size") <= BUCKET)
        leaves = done if leaves is None else leaves.unionAll(done)
        large = members.filter(F.col("size") > BUCKET)
        if large.isEmpty():
            return leaves, None
        if depth < DEPTH:
            level = large.select("path", "node").join(classes.select("node", "sketch"), "node")
    return leaves, large


def _sized(members: DataFrame, name: str) -> DataFrame:
    """Members of buckets of two or more, with the size."""
    sizes = members.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
    return stage(members.join(stage(sizes, "path-sizes"), "path"), name)


def _dense_groups(dense: DataFrame, classes: DataFrame, sets_of, similarity: float) -> tuple[DataFrame, list[DataFrame]]:
    """Near copies of dense buckets as members of groups, and the buckets of what is not near.

    Each round a bucket has one pivot, and buckets with the same pivot become one group. A group
    decides all pairs of its members, those within three times the distance that a link may have. What lies
    beyond two times that distance stays in the bucket, as it may be linked with another such
    set, but not, by the triangle inequality, with one that has left. A bucket that is small by then is
    compared as any other, a large one gets the next pivot.
    """
    members, rest = [], []
    # Later rounds have some of the same sets, so texts are looked up once.
    sets = stage(sets_of(dense.select("node").distinct()), "dense-sets")
    for turn in range(PIVOT_ROUNDS):
        chosen = stage(pivots_of(dense, classes.select("node", "sketch")), "pivots")
        held = stage(dense.select("path", "node").join(chosen, "path"), "pivot-paths")
        pairs = stage(held.select("pivot", "node").distinct().join(classes.select("node", "copies"), "node"), "pivot-pairs")
        found = stage(differences(pairs, sets, similarity), "differences")
        # Keys of groups are negative, so they come before those of all buckets.
        key = F.xxhash64(F.lit(turn), F.col("pivot")).bitwiseOR(F.lit(-LARGEST - 1))
        members.append(found.filter(F.col("diff").isNotNull()).select(key.alias("key"), "node", "copies", "cost", "diff"))
        left = held.join(found.filter("far").select("pivot", "node"), ["pivot", "node"]).select("path", "node")
        left = _sized(left, "far-members")
        rest.append(left.filter(F.col("size") <= BUCKET))
        dense = left.filter(F.col("size") > BUCKET)
        if dense.isEmpty():
            return _all(members), rest
    return _all(members), [*rest, dense]


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _tiles(members: DataFrame) -> DataFrame:
    """Deal buckets out: one tile for a small bucket, one per pair of blocks for a larger one."""
    blocks = F.ceil(F.col("size") / BUCKET).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tile = F.xxhash64("path", low, high)
    return placed.withColumn("tile", tile).withColumn("cross", low != high).drop("blocks", "other", "size")


def _answered(tile: pa.Table) -> np.ndarray:
    """Which pairs of rows, first below second, a tile answers for.

    Those whose smallest common bucket it is; across two blocks, those of one row of each.
    """
    path = tile.column("path")[0].as_py()
    paths = tile.column("paths").combine_chunks()
    row = np.repeat(np.arange(len(paths)), pc.list_value_length(paths).to_numpy())
    value = paths.flatten().to_numpy()
    earlier = value < path
    answered = np.triu(common_values(row[earlier], value[earlier], len(paths)) == 0, 1)
    if tile.column("cross")[0].as_py():
        block = tile.column("block").to_numpy()
        answered &= block[:, None] != block[None, :]
    return answered


def sketch_pairs(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a tile whose sketches agree often enough, and that it answers for."""
    sketch = tile.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    same = np.zeros((len(sketch), len(sketch)), np.int16)
    for k in range(COORDINATES):
        same += sketch[:, k, None] == sketch[None, :, k]
    near = same >= SKETCH_SHARE * COORDINATES
    if np.count_nonzero(near) == len(near):  # each with itself alone
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.nonzero(near & _answered(tile))


def similar_pairs(tile: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with a Jaccard similarity of at least ``similarity`` that a tile answers for."""
    sets = tile.column("tokens").combine_chunks()
    lengths = pc.list_value_length(sets).to_numpy()
    common = common_values(np.repeat(np.arange(len(sets)), lengths), sets.flatten().to_numpy(), len(sets))
    union = lengths[:, None] + lengths[None, :] - common
    return np.nonzero((common >= similarity * union - 1e-6) & _answered(tile))


def similar_documents(docs: DataFrame, similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """Documents whose sets of five-word shingles have a Jaccard similarity of at least ``similarity``.

    Returns one row per row of ``docs``: doc_id, class_id (the smallest id with the same words),
    n_links (other documents linked directly, copies of this one among them), group_id (the
    smallest id reachable by links), kept (doc_id = group_id) and text_key (a hash of the text).

    Documents with the same words become one set. Each of several trees sends a set, at every
    node, to the child of the token that comes first in an order sampled for the node; buckets
    of up to 512 sets are compared, larger ones are split further, down to level 4. ``recall`` is
    the chance to find a pair of just ``similarity`` that has to go down all levels; the number of
    trees follows from it. What is still large at level 4 holds near copies: there links follow
    from the differences to a pivot (``pivot_rings``), and what is not near one of three pivots is
    compared in tiles of blocks. A pair that meets in several places counts in the first of them.
    Sketches of 64 tokens choose which sets are fetched; links are decided by the whole sets,
    exactly. A bucket gives one row per linked set, never one per pair.

    Null and empty texts link with nothing, nor do rows with a null id, which stay as they
    are. An id with several texts has a row for each, which are linked on their own: what one of them
    is like is not thereby linked with the others. Repeated rows are copies. Further columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    text = F.col("text").cast("string")
    source = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_key"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            offsets, hashes, word_offsets, words = shingles(filled(part.column("text")))
            found = pa.FixedSizeListArray.from_arrays(pa.array(sketches(offsets, hashes).ravel()), COORDINATES).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), word_keys(word_offsets, words), found], ["doc_id", "text_key", "key", "sketch"])

    keyed = stage(source.mapInArrow(sketch, "doc_id long, text_key long, key binary, sketch array<int>"), "sketches")
    usable = keyed.filter(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    classes = usable.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    # A set has a number of its own: one id may stand for several sets.
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "sets")

    def token_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            offsets, hashes, word_offsets, words = shingles(filled(part.column("text")))
            signed = hashes.view(np.int64)
            sets = [np.unique(signed[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([word_keys(word_offsets, words), pa.array(sets, pa.list_(pa.int64()))], ["key", "tokens"])

    def sets_of(nodes: DataFrame, few: int = 0) -> DataFrame:
        """node and tokens of distinct nodes. Joined by shuffle: each text moves once, by document. Up to
        ``few`` bytes of wanted nodes are broadcast instead, and only their own texts are looked at further."""
        wanted, size = stage_sized(classes.select("node", "key", "doc_id").join(nodes, "node", "left_semi"), "wanted-sets")
        how = "broadcast" if size <= few else "merge"
        texts = source.join(wanted.select("doc_id").distinct().hint(how), "doc_id", "left_semi").select("text")
        # Repeated rows, and other texts of the id that are wanted too, give the same set again.
        found = texts.mapInArrow(token_sets, "key binary, tokens array<long>").dropDuplicates(["key"])
        return found.join(wanted.select("node", "key").hint("merge"), "key").select("node", "tokens")

    leaves, dense = _leaves(classes, similarity, runs_for(recall, similarity))
    leaves = leaves.select(F.col("path").bitwiseAND(F.lit(LARGEST)).alias("path"), "node", "size")
    keys = leaves.select("path", "node")
    near = None
    if dense is not None:
        near, rest = _dense_groups(dense, classes, lambda nodes: sets_of(nodes, FEW_BYTES), similarity)
        for part in rest:
            # Another key than in the tree: here a bucket lacks the sets that are near its pivot.
            leaves = leaves.unionAll(part.select(F.xxhash64("path").bitwiseAND(F.lit(LARGEST)).alias("path"), "node", "size"))
        keys = leaves.select("path", "node").unionAll(near.select(F.col("key").alias("path"), "node"))
    leaves = stage(leaves, "buckets")
    paths = stage(keys.groupBy("node").agg(F.sort_array(F.collect_set("path")).alias("paths")), "set-paths")
    members = _tiles(leaves).join(classes.select("node", "copies", "sketch").join(paths, "node"), "node")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, "tile"):
            left, right = sketch_pairs(tile)
            if len(left):
                rows = pa.array(np.union1d(left, right))
                yield from tile.select(["tile", "path", "cross", "block", "node", "copies", "paths"]).take(rows).combine_chunks().to_batches()

    columns = "tile long, path long, cross boolean, block int, node long, copies long, paths array<long>"
    dealt = members.select("tile", "path", "cross", "block", "node", "copies", "paths", "sketch").repartition("tile").sortWithinPartitions("tile", "node")
    needed = stage(dealt.mapInArrow(choose, columns), "needed-sets")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, "tile"):
            left, right = similar_pairs(tile, similarity)
            if len(left):
                yield link_batch(link_rows(tile.column("node").to_numpy(), tile.column("copies").to_numpy(), left, right))

    fetched = needed.join(sets_of(needed.select("node").distinct()), "node").repartition("tile").sortWithinPartitions("tile", "node")
    found = fetched.mapInArrow(verify, LINK_SCHEMA)
    if near is not None:
        earlier = F.filter("paths", lambda p: p < F.col("key"))
        placed = near.join(paths, "node").withColumn("earlier", earlier).withColumn("kind", F.xxhash64("earlier")).drop("paths")
        placed = stage(placed, "group-members")
        found = found.unionAll(proven_links(placed)).unionAll(ring_links(placed, similarity))
    linked = summarise(found).join(classes.select("node", "doc_id"), "node")
    firsts = linked.groupBy("component").agg(F.min("doc_id").alias("group_id"))
    linked = linked.join(firsts, "component").select("node", "links", "group_id")
    known = classes.select("key", "node", "copies", "doc_id").join(linked, "node", "left")
    known = stage(known.select("key", "copies", F.col("doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group_id", "doc_id").alias("group_id")), "set-links")
    rows = keyed.select("doc_id", "text_key", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")).join(known, "key", "left")
    group = F.coalesce("group_id", "doc_id")
    return rows.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        group.alias("group_id"),
        F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"),
        "text_key",
    )


def drop_near_copies(docs: DataFrame, similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """One document of each group of similar documents: the one with the smallest id.

    All columns stay as they are, whatever their names. Rows with a null id and texts without a word
    stay. Of an id with several texts only those go that are like a text of a smaller
    id; rows that repeat id and text stay or go together, as they are one document.
    """
    judged = similar_documents(docs, similarity, recall)
    dropped = stage(judged.filter(~F.col("kept")).select("doc_id", "text_key").distinct(), "dropped").hint("merge")
    same_id = docs["doc_id"].cast("long") == dropped["doc_id"]
    return docs.join(dropped, same_id & (F.xxhash64(docs["text"].cast("string")) == dropped["text_key"]), "left_anti")
