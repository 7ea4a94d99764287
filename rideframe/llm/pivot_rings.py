"""Dense buckets of near copies: links proven by their differences from a pivot, and rings of undecided pairs.

With a pivot P, a set x lacks ``removed`` tokens of P and has ``added`` ones more: its difference. Two sets
of a bucket have |P| - removed(a) - removed(b) + o tokens in common, o being the tokens that their differences
share, so with the similarity s and the cost

    cost(x) = removed + s * added - (1 - s) * |P| / 2

they are similar if and only if cost(a) + cost(b) <= (1 + s) * o. A sum of 0 or less proves a link and one above
(1 + s) times the smaller difference excludes it, from two numbers; what lies between is compared by differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rideframe.llm.links import LINK_SCHEMA, common_values, groups, link_batch, link_rows
from rideframe.session import stage

#: Coordinates of the sketch that vote for the pivot.
VOTES = 16
#: Members whose differences are found, or that are compared, together.
BLOCK = 1024
#: Weight of a block of a ring, in tokens of differences; a member weighs a BLOCK-th at least.
RING_TOKENS = 1 << 18
#: Costs are counted in millionths; one of them is allowed for rounding.
UNIT = 1_000_000
TOLERANCE = 1


def _each_shared(similarity: float) -> int:
    """What a token that two differences share allows the sum of their costs."""
    return round(UNIT * (1 + similarity))


def pivots_of(dense: DataFrame, sketches: DataFrame) -> DataFrame:
    """For each path a member that its others are near: path, pivot.

    Every bucket names the member whose sketch has the most tokens that are the commonest ones
    there, and takes of its members the one that most buckets have named. So the buckets that
    several trees have of the same near copies mostly share a pivot.
    """
    held = stage(dense.select("path", "node").join(sketches, "node").select("path", "node", F.slice("sketch", 1, VOTES).alias("votes")), "votes")
    cast = held.select("path", F.posexplode("votes").alias("place", "token")).groupBy("path", "place", "token").agg(F.count("*").alias("n"))
    common = cast.groupBy("path", "place").agg(F.max_by("token", F.struct("n", "token")).alias("token"))
    common = common.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "token"))), lambda c: c["token"]).alias("common"))
    agree = F.size(F.filter(F.zip_with("votes", "common", lambda a, b: a == b), lambda same: same))
    scored = held.join(common, "path").select("path", "node", agree.alias("agree"))
    named = scored.groupBy("path").agg(F.max_by("node", F.struct("agree", F.xxhash64("node"))).alias("node"))
    named = stage(named.groupBy("node").agg(F.count("*").alias("names")), "named-pivots")
    return dense.join(named, "node").groupBy("path").agg(F.max_by("node", F.struct("names", F.xxhash64("node"))).alias("pivot"))


def difference(pivot: np.ndarray, own: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Removed and added tokens of a sorted set against a sorted pivot: their numbers, and all of them."""
    place = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
    same = pivot[place] == own
    lacking = np.ones(len(pivot), bool)
    lacking[place[same]] = False
    removed, added = pivot[lacking], own[~same]
    return len(removed), len(added), np.concatenate([removed, added])


def differences(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """pivot, node, copies, cost, diff and far of distinct pairs of a pivot and a node.

    ``sets`` has node and tokens (sorted). The metric is the Jaccard distance: a member within
    three times the distance that a link may have gets its difference, all others none; ``far``
    are those beyond two times that distance. Members stream past their pivot, which is sent once to each
    block of them.
    """
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    members = pairs.join(sizes, "pivot").select("pivot", block.alias("block"), F.lit(1).alias("turn"), "node", "copies").join(sets, "node")
    first = sizes.select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("turn"), F.col("pivot").alias("node"), F.lit(0).cast("long").alias("copies"))
    columns = ("pivot", "block", "turn", "node", "copies", "tokens")
    rows = members.select(*columns).unionAll(first.join(sets, "node").select(*columns))
    rows = rows.repartition("pivot", "block").sortWithinPartitions("pivot", "block", "turn", "node")
    link, step = similarity, 1 - similarity

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.zeros(0, np.int64)
        for batch in batches:
            turns = batch.column("turn").to_numpy()
            offsets = batch.column("tokens").offsets.to_numpy()
            values = batch.column("tokens").values.to_numpy()
            kept, costs, diffs, far = [], [], [], []
            for row, turn in enumerate(turns.tolist()):
                own = values[offsets[row] : offsets[row + 1]]
                if not turn:
                    pivot = own
                    continue
                removed, added, diff = difference(pivot, own)
                alike = (len(pivot) - removed) / (len(pivot) + added)
                kept.append(row)
                costs.append(round(UNIT * (removed + link * added - step * len(pivot) / 2)))
                diffs.append(diff if alike >= 1 - 3 * step - 1e-9 else None)
                far.append(alike < 1 - 2 * step - 1e-9)
            if kept:
                out = batch.select(["pivot", "node", "copies"]).take(pa.array(kept))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(costs, pa.int64()), pa.array(diffs, pa.list_(pa.int64())), pa.array(far)], ["pivot", "node", "copies", "cost", "diff", "far"])

    return rows.mapInArrow(compare, "pivot long, node long, copies long, cost long, diff array<long>, far boolean")


def _disjoint(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    return not set(a) & set(b)


def prove(cells: pa.Table) -> pa.RecordBatch:
    """Copies that each cell of one group is linked with by cost alone, and nodes that stand for them.

    A cell is a cost and the groups (``earlier``) in which its members have been answered for; two
    members that share one of these are not asked for again. The cheapest node of each kind of cell
    stands for it: linked cells are linked with it, and these nodes with one another.
    """
    earlier = [tuple(e) for e in cells.column("earlier").to_pylist()]
    cost, n, node = (cells.column(c).to_numpy() for c in ("cost", "n", "node"))
    links = np.zeros(len(cost), np.int64)
    roots: list[list[int]] = [[] for _ in cost]
    kinds: dict[tuple[int, ...], np.ndarray] = {}
    for kind in dict.fromkeys(earlier):
        rows = np.array([i for i, e in enumerate(earlier) if e == kind])
        kinds[kind] = rows[np.lexsort((node[rows], cost[rows]))]
    for own, rows in kinds.items():
        for other, others in kinds.items():
            if not _disjoint(own, other):
                continue
            upto = np.searchsorted(cost[others], TOLERANCE - cost[rows], side="right")
            links[rows] += np.concatenate([[0], np.cumsum(n[others])])[upto]
            for row in rows[upto > 0].tolist():
                roots[row].append(int(node[others[0]]))
    columns = [*(cells.column(c).combine_chunks() for c in ("key", "kind", "cost")), pa.array(links), pa.array(roots, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["key", "kind", "cost", "proven", "roots"])


def proven_links(members: DataFrame) -> DataFrame:
    """Links that the costs prove: rows of node, links, root.

    ``members`` has key (of the group), node, copies, cost, earlier and kind (a hash of earlier). They are counted by
    cost and kind; one task sees these counts for a group, whose number the length of the
    pivot bounds and not the number of members, and each member looks its cell up.
    """
    cells = members.groupBy("key", "kind", "cost").agg(F.first("earlier").alias("earlier"), F.sum("copies").alias("n"), F.min("node").alias("node"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "key"):
            yield prove(group)

    dealt = cells.repartition("key").sortWithinPartitions("key")
    answers = dealt.mapInArrow(answer, "key long, kind long, cost long, proven long, roots array<long>").filter(F.size("roots") > 0)
    itself = (F.size("earlier") == 0) & (2 * F.col("cost") <= TOLERANCE)
    found = members.join(answers, ["key", "kind", "cost"]).withColumn("links", F.col("proven") - F.when(itself, F.col("copies")).otherwise(0))
    rows = found.filter("links > 0").select("node", "links", F.posexplode("roots").alias("place", "root"))
    return rows.select("node", F.when(F.col("place") == 0, F.col("links")).otherwise(0).cast("long").alias("links"), "root")


def _ring_blocks(members: DataFrame, similarity: float) -> DataFrame:
    """Members that may have a partner neither proven nor excluded, in blocks of similar cost: one row a block."""
    weight = F.greatest(F.size("diff"), F.lit(RING_TOKENS // BLOCK))
    cells = members.groupBy("key", "cost").agg(F.sum(weight).alias("weight"), F.max(F.size("diff")).alias("widest"))
    whole = Window.partitionBy("key")
    cells = cells.withColumn("high", F.max("cost").over(whole)).withColumn("low", F.min("cost").over(whole))
    reach = F.col("widest").cast("long") * _each_shared(similarity) + TOLERANCE
    cells = cells.filter((F.col("cost") + F.col("high") > TOLERANCE) & (F.col("cost") + F.col("low") <= reach))
    before = F.coalesce(F.sum("weight").over(whole.orderBy("cost").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = F.ceil(F.col("weight") / RING_TOKENS)
    cells = cells.select("key", "cost", F.floor(before / RING_TOKENS).alias("place"), parts.alias("parts"))
    # A cell that is larger than a block is a run of blocks of its own.
    own = F.when(F.col("parts") > 1, F.struct("cost", F.pmod(F.xxhash64("node"), "parts").alias("part")))
    placed = members.join(cells, ["key", "cost"]).withColumn("block", F.xxhash64("place", own))
    rows = F.struct("node", "copies", "cost", "diff", "earlier")
    return placed.groupBy("key", "block").agg(
        F.collect_list(rows).alias("members"), F.min("cost").alias("low"), F.max("cost").alias("high"), F.max(F.size("diff")).alias("widest")
    )


def undecided_pairs(tile: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of a tile that the costs do not prove, by the tokens that their differences share."""
    cost = tile.column("cost").to_numpy()
    total = cost[:, None] + cost[None, :]
    lists = tile.column("diff").combine_chunks()
    shared = common_values(_rows(lists), lists.flatten().to_numpy(), len(cost)).astype(np.int64)
    linked = np.triu((total > TOLERANCE) & (total <= shared * _each_shared(similarity) + TOLERANCE), 1)
    if tile.column("cross")[0].as_py():
        block = tile.column("block").to_numpy()
        linked &= block[:, None] != block[None, :]
    if linked.any():
        earlier = tile.column("earlier").combine_chunks()
        linked &= common_values(_rows(earlier), earlier.flatten().to_numpy(), len(cost)) == 0
    return np.nonzero(linked)


def _rows(lists: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())


def ring_links(members: DataFrame, similarity: float) -> DataFrame:
    """Links between members whose costs leave them undecided: rows of node, links, root.

    Blocks of about 1024 members hold similar costs, so most pairs of blocks are proven or
    excluded as a whole; only the others meet. A block travels as one row.
    """
    blocks = stage(_ring_blocks(members, similarity), "ring-blocks")
    heads = blocks.select("key", "block", "low", "high", "widest")
    others = heads.select("key", *[F.col(c).alias(f"other_{c}") for c in ("block", "low", "high", "widest")])
    open_pairs = (F.col("block") <= F.col("other_block")) & (F.col("high") + F.col("other_high") > TOLERANCE)
    reach = F.least("widest", "other_widest").cast("long") * _each_shared(similarity) + TOLERANCE
    met = heads.join(others, "key").filter(open_pairs & (F.col("low") + F.col("other_low") <= reach))
    sides = met.select(
        "key", F.xxhash64("key", "block", "other_block").alias("tile"), (F.col("block") != F.col("other_block")).alias("cross"),
        F.explode(F.array_distinct(F.array("block", "other_block"))).alias("block"),
    )
    dealt = sides.join(blocks.select("key", "block", "members"), ["key", "block"]).repartition("tile").sortWithinPartitions("tile", "block")
    rows = dealt.select("tile", "cross", "block", F.inline("members"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, "tile"):
            left, right = undecided_pairs(tile, similarity)
            if len(left):
                yield link_batch(link_rows(tile.column("node").to_numpy(), tile.column("copies").to_numpy(), left, right))

    return rows.mapInArrow(compare, LINK_SCHEMA)
