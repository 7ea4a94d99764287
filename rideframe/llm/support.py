"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import rideframe

SLICE_BYTES = 8 << 20


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever they start.

    On a cluster the package is installed or sent with ``--py-files``; the path is then
    simply not found there.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(rideframe.__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each part holds at most ``limit`` bytes of text, or one row.

    After the last part the memory that Arrow holds unused goes back, as a worker lives on.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()


def filled(texts: pa.Array) -> pa.Array:
    """The texts with null as empty, as a plain string array."""
    return pc.fill_null(texts.cast(pa.string()), "")


def strings(texts: pa.Array) -> list[str]:
    """The texts of an array without nulls, some times faster than one scalar after another."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... for each pair of a start and a length, one after another."""
    lengths = lengths.astype(np.int64, copy=False)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts.astype(np.int64, copy=False) - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def split_lists(lists: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Row offsets and the dictionary-coded values of a list array without nulls."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return offsets - offsets[0], values.dictionary_encode()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, runs of anything but ASCII white space.

    Gives row offsets, the number of each word in the list of distinct words, and that list.
    """
    offsets, coded = split_lists(pc.ascii_split_whitespace(texts))
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary
    empty = pc.index(words, pa.scalar("")).as_py()
    if empty >= 0:
        kept = codes != empty
        before = np.concatenate([[0], np.cumsum(kept)])
        offsets, codes = before[offsets], codes[kept]
    return offsets, codes, words


def binary_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array of consecutive parts of ``data``; ``ends`` are byte positions, with the first 0."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
