"""Token ids in Simple-8b words: a table format with per-block offsets, its writer and its reader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rideframe.llm.encoding import append_id, encoder
from rideframe.llm.support import binary_array, reach_workers, text_slices

#: Fixed values of the format: how many values of how many bits a word holds, by selector.
#: The selector is in the top four bits, the first value in the lowest. Selector 0 is the
#: escape: the next word is one value of more than 60 bits.
SELECTORS = ((1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([c for c, _ in SELECTORS])
BLOCK = 1024
#: The most values of some bits that a word holds.
ROOM = 60
#: Pieces of text that a worker remembers with their ids.
KEPT_PIECES = 1_000_000

FILE_SCHEMA = "shard int, first_id long, n_ids long, words binary, block_words binary, doc_ids array<long>, doc_tokens array<long>"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    bits = np.frexp(values.astype(np.float64))[1].astype(np.int16)
    large = np.flatnonzero(bits > 52)  # a double may round these up
    if len(large):
        bits[large] = [v.bit_length() for v in values[large].tolist()]
    return bits


def encode_blocks(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of consecutive blocks of ``block`` values, and the word at which each block begins.

    Every block starts on a word of its own and takes, word by word, the selector that
    holds most values; the last word may have room left. All blocks advance together.
    """
    n = len(values)
    n_blocks = -(-n // block)
    if not n_blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    grid = np.zeros(n_blocks * block, np.uint64)
    grid[:n] = values
    # widest[b, i]: most bits of the next ``count`` values from value i of block b on; none past its end
    widest = _bits(grid).astype(np.uint8).reshape(n_blocks, block)
    fill = np.full(n_blocks, block, np.int64)
    fill[-1] = n - (n_blocks - 1) * block
    # choice[b, i]: the selector of a word that begins at value i of block b
    choice = np.zeros((n_blocks, block), np.int8)
    reached = 1
    for selector in range(15, 0, -1):
        count, width = SELECTORS[selector]
        if count > reached:  # two overlapping runs make a longer one, of twice the length at most
            longer = widest.copy()
            step = count - reached
            if step < block:
                np.maximum(widest[:, :-step], widest[:, step:], out=longer[:, :-step])
            widest, reached = longer, count
        np.putmask(choice, widest <= width, np.int8(selector))
    position = np.zeros(n_blocks, np.int64)
    active = np.arange(n_blocks)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(active):
        at = position[active]
        steps.append((active, at))
        position[active] = at + COUNTS[choice[active, at]]
        active = active[position[active] < fill[active]]
    begins = np.zeros((n_blocks, block), bool)
    for row, at in steps:
        begins[row, at] = True
    rows, starts = np.nonzero(begins)
    selectors = choice[begins].astype(np.int64)
    sizes = 1 + (selectors == 0)
    places = np.cumsum(sizes) - sizes
    words = np.zeros(int(sizes.sum()), np.uint64)
    # Each block is followed by room for the values that its last word does not have.
    padded = np.zeros((n_blocks, block + ROOM), np.uint64)
    padded[:, :block] = grid.reshape(n_blocks, block)
    padded = padded.ravel()
    flat = rows * (block + ROOM) + starts
    for selector in range(16):
        here = np.flatnonzero(selectors == selector)
        count, width = SELECTORS[selector]
        at = flat[here]
        if selector == 0:
            words[places[here] + 1] = padded[at]
            continue
        word = np.full(len(here), selector << 60, np.uint64)
        for k in range(count if width else 0):
            word |= padded[at + k] << np.uint64(k * width)
        words[places[here]] = word
    per_block = np.bincount(rows, weights=sizes, minlength=n_blocks).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)])


def decode_blocks(words: np.ndarray, block_words: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of words written by ``encode_blocks``; all words of a selector at once."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    # The word after an escape is a value and has no selector, whatever its top bits say.
    is_value = np.zeros(len(words) + 1, bool)
    for i in np.flatnonzero(selectors == 0).tolist():
        if not is_value[i]:
            is_value[i + 1] = True
    is_value = is_value[:-1]
    real = np.flatnonzero(~is_value)
    chosen = selectors[real]
    counts = COUNTS[chosen]
    block_of = np.searchsorted(block_words, real, side="right") - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    first_word = np.searchsorted(real, block_words[:-1])
    starts = total[:-1] - total[first_word][block_of] + block_of * (block + ROOM)
    out = np.zeros((len(block_words) - 1, block + ROOM), np.uint64)
    flat = out.ravel()  # what the last word of a block has beyond its end falls into the room after it
    for selector in range(16):
        here = np.flatnonzero(chosen == selector)
        count, width = SELECTORS[selector]
        if selector == 0:
            flat[starts[here]] = words[real[here] + 1]
            continue
        mask = np.uint64((1 << width) - 1)
        word, at = words[real[here]], starts[here]
        for k in range(count if width else 0):
            flat[at + k] = (word >> np.uint64(k * width)) & mask
    return out[:, :block].ravel()[:n]


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1) -> None:
    """Write the ids of all documents, each with ``end_id`` after it, in ascending doc_id order.

    The files are a Parquet table that Spark commits task by task, so a lost executor or a
    second attempt leaves no partial file. A row is a chunk of whole documents: shard (the
    range of ids it belongs to), first_id (ids of the shard before it), n_ids, words (little-endian 64-bit
    Simple-8b words), block_words (little-endian 64-bit: the word at which each block of 1024
    ids begins, and the end), doc_ids and doc_tokens. Null ids come first, equal ids are
    ordered by text, null texts are their end id alone, an empty table gives an empty file.
    """
    reach_workers(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer_path, KEPT_PIECES)
        shard = TaskContext.get().partitionId()
        before = 0
        for part in text_slices(batches, "text"):
            ids, ends = append_id(*encode_texts.encode(part.column("text")), end_id)
            words, block_words = encode_blocks(ids)
            columns = [
                pa.array([shard], pa.int32()),
                pa.array([before], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.array([words.astype("<u8").tobytes()], pa.binary()),
                pa.array([block_words.astype("<i8").tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("doc_id")),
                pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.array(np.diff(ends), pa.int64())),
            ]
            before += len(ids)
            yield pa.RecordBatch.from_arrays(columns, ["shard", "first_id", "n_ids", "words", "block_words", "doc_ids", "doc_tokens"])

    source = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, FILE_SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of written files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    ``start`` counts the ids of all documents before. The ids of each shard are summed from
    one column; the sums, one row per shard and so at most as many as there were shuffle
    partitions, are broadcast, and no ids are shuffled.
    """
    reach_workers(spark)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first_id, n_ids, words, block_words, doc_ids, doc_tokens = (batch.column(i)[row] for i in range(7))
                counts = doc_tokens.values.to_numpy(zero_copy_only=False)
                ids = decode_blocks(np.frombuffer(words.as_py(), "<u8"), np.frombuffer(block_words.as_py(), "<i8"), n_ids.as_py())
                ends = np.concatenate([[0], np.cumsum(counts)])
                shards = pa.array(np.full(len(counts), shard.as_py()), pa.int32())
                columns = [shards, doc_ids.values, pa.array(ends[:-1] + first_id.as_py(), pa.int64()), pa.array(counts, pa.int64()), binary_array(ids.astype("<u4"), ends * 4)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "inside", "n_tokens", "ids"])

    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    docs = files.mapInArrow(decode, "shard int, doc_id long, inside long, n_tokens long, ids binary")
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("shard_start"))
    return docs.join(F.broadcast(shards), "shard").select("doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), "n_tokens", "ids")
