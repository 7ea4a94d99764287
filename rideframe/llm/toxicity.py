"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rideframe.llm.support import filled, ragged_positions, reach_workers, split_words, text_slices
from rideframe.session import stage

#: Bound of the training sample: at most so many labelled documents of each class.
ROWS_PER_CLASS = 4000
#: Bound of what the sample takes on the driver; documents beyond it, in the order of the sample, are left out.
SAMPLE_BYTES = 256 << 20
#: N-grams take many times the memory of their text.
SLICE_BYTES = 4 << 20


#: Holds bucket numbers of up to 16 bits.
BUCKET_TYPE = "<u2"


@dataclass(frozen=True)
class Settings:
    bucket_bits: int = 16
    dimension: int = 4
    shortest: int = 3
    longest: int = 5
    epochs: int = 10
    least_steps: int = 400
    batch: int = 64
    rate: float = 0.3
    decay: float = 1e-5
    shrinkage: float = 2.0
    gain: float = 60.0
    seed: int = 7

    def __post_init__(self):
        if not 1 <= self.bucket_bits <= 16:
            raise ValueError("bucket_bits must be 1 to 16")


@dataclass(frozen=True)
class ToxicityModel:
    """Embeddings of hashed character n-grams and the two-class output layer."""

    settings: Settings
    embeddings: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def gram_weights(self) -> np.ndarray:
        """What each bucket adds to the log-odds of class 1, per unit of its share in a document."""
        return (self.embeddings @ (self.output[:, 1] - self.output[:, 0]) * self.settings.gain).astype(np.float32)


def word_grams(words: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of lower-cased words between ``<`` and ``>``: word number and bucket of each."""
    marked = pc.binary_join_element_wise("<", pc.utf8_lower(words), ">", "")
    lengths = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.repeat(np.cumsum(lengths), lengths)
    word = np.repeat(np.arange(len(lengths)), lengths)
    found_words, found = [], []
    value = np.zeros(len(points), np.uint64)
    for n in range(1, settings.longest + 1):
        if len(points) < n:
            break
        value = value[: len(points) - n + 1] * np.uint64(1_000_003) + points[n - 1 :]
        if n < settings.shortest:
            continue
        inside = np.flatnonzero(np.arange(len(value)) + n <= ends[: len(value)])
        mixed = (value[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        found_words.append(word[inside])
        found.append((mixed >> np.uint64(64 - settings.bucket_bits)).astype(np.int64))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_words), np.concatenate(found)


def document_features(texts: pa.Array, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their shares in each document; the shares of a document with a word sum to 1."""
    offsets, codes, words = split_words(texts)
    gram_word, bucket = word_grams(words, settings)
    order = np.argsort(gram_word, kind="stable")
    bucket = bucket[order]
    counts = np.bincount(gram_word, minlength=len(words))
    starts = np.cumsum(counts) - counts
    out = []
    for row in range(len(texts)):
        own, uses = np.unique(codes[offsets[row] : offsets[row + 1]], return_counts=True)
        share = uses / max(1, int(uses.sum())) / np.maximum(1, counts[own])
        total = np.bincount(bucket[ragged_positions(starts[own], counts[own])], weights=np.repeat(share, counts[own]), minlength=1)
        kept = np.flatnonzero(total)
        out.append((kept.astype(np.int32), total[kept].astype(np.float32)))
    return out


def fit(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings = Settings()) -> ToxicityModel:
    """Train embeddings and output layer together by minibatch Adagrad on the cross-entropy.

    Rows weigh so that both classes count the same. Without both the model scores every text by the share of class 1.
    """
    rng = np.random.default_rng(settings.seed)
    size, dim = 1 << settings.bucket_bits, settings.dimension
    embeddings = rng.normal(0, 0.1, (size, dim))
    output = rng.normal(0, 0.5, (dim, 2))
    bias = np.zeros(2)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return ToxicityModel(settings, np.zeros((size, dim), np.float32), output.astype(np.float32), np.array([0.0, 30.0 * (2 * share - 1)]))
    seen_e, seen_o, seen_b = np.full((size, dim), 1e-6), np.full((dim, 2), 1e-6), np.full(2, 1e-6)
    onehot = np.eye(2)[labels]
    # Both classes weigh the same at every size, as they do where both reach the bound of the sample.
    class_weight = len(labels) / (2 * np.bincount(labels, minlength=2))
    # An n-gram counts by n / (n + shrinkage), n being the sampled documents that hold it, so rare
    # ones are learnt more slowly, but none is left out at any size of the sample.
    held = np.zeros(size)
    for buckets, _ in features:
        held[buckets] += 1
    trust = held / (held + settings.shrinkage)
    # A small sample is gone through more often, or its few steps would leave the model as it began.
    epochs = max(settings.epochs, -(-settings.least_steps // -(-len(labels) // settings.batch)))
    for epoch in range(epochs):
        rate = settings.rate * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for first in range(0, len(order), settings.batch):
            rows = order[first : first + settings.batch]
            lengths = np.array([len(features[r][0]) for r in rows])
            buckets = np.concatenate([features[r][0] for r in rows])
            shares = np.concatenate([features[r][1] for r in rows]).astype(np.float64) * settings.gain * trust[buckets]
            row = np.repeat(np.arange(len(rows)), lengths)
            weighted = embeddings[buckets] * shares[:, None]
            hidden = np.stack([np.bincount(row, weights=weighted[:, d], minlength=len(rows)) for d in range(dim)], axis=1)
            logits = hidden @ output + bias
            logits -= logits.max(axis=1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - onehot[rows]) * class_weight[labels[rows], None] / len(rows)
            back = error @ output.T
            step_o, step_b = hidden.T @ error, error.sum(axis=0)
            used, inverse = np.unique(buckets, return_inverse=True)
            pushed = back[row] * shares[:, None]
            step_e = np.stack([np.bincount(inverse, weights=pushed[:, d], minlength=len(used)) for d in range(dim)], axis=1)
            step_e += settings.decay * embeddings[used]
            seen_e[used] += step_e**2
            embeddings[used] -= rate * step_e / np.sqrt(seen_e[used])
            seen_o += step_o**2
            output -= rate * step_o / np.sqrt(seen_o)
            seen_b += step_b**2
            bias -= rate * step_b / np.sqrt(seen_b)
    return ToxicityModel(settings, (embeddings * trust[:, None]).astype(np.float32), output.astype(np.float32), bias)


def score_texts(texts: pa.Array, gram_weights: np.ndarray, bias: float, settings: Settings) -> np.ndarray:
    """Probability of class 1 for each whole text; a text without a word has the bias alone."""
    offsets, codes, words = split_words(texts)
    gram_word, bucket = word_grams(words, settings)
    counts = np.bincount(gram_word, minlength=len(words))
    word_score = np.bincount(gram_word, weights=gram_weights[bucket], minlength=len(words)) / np.maximum(1, counts)
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)
    total = np.bincount(row, weights=word_score[codes], minlength=len(lengths)) / np.maximum(1, lengths)
    return 1 / (1 + np.exp(-np.clip(total + bias, -60, 60)))


def is_held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), rows_per_class: int = ROWS_PER_CLASS, sample_bytes: int = SAMPLE_BYTES) -> ToxicityModel:
    """Fit the model on labelled documents that are not held out.

    The sample is bounded: of each class the ``rows_per_class`` documents with the smallest
    hash of their id, and of both together, in that order, as many as take ``sample_bytes``. Only their
    n-gram shares come to the driver. Labels other than 0 and 1 are ignored, and ids
    without a document; an id with several labels has the largest, one with several texts the first of
    them in the order of their bytes; a null text is empty.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    hashed = F.xxhash64(F.col("doc_id"))
    parts = [usable.filter(F.col("toxic") == kind).orderBy(hashed, "doc_id").limit(rows_per_class) for kind in (0, 1)]
    sample = F.broadcast(parts[0].unionAll(parts[1]))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(sample, "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            found = document_features(filled(part.column("text")), settings)
            columns = [
                part.column("doc_id"),
                part.column("toxic"),
                pa.array([b.astype(BUCKET_TYPE).tobytes() for b, _ in found], pa.binary()),
                pa.array([w.astype("<f4").tobytes() for _, w in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "buckets", "shares"])

    found = stage(texts.mapInArrow(features, "doc_id long, toxic int, buckets binary, shares binary"), "toxicity-sample")
    # Some thousand rows, so one task may order them.
    upto = F.sum(F.length("buckets") + F.length("shares")).over(Window.orderBy(hashed, "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = found.withColumn("upto", upto).filter(F.col("upto") <= sample_bytes).drop("upto").toArrow()
    held = [pair for batch in rows.to_batches() for pair in zip(_views(batch.column("buckets"), BUCKET_TYPE), _views(batch.column("shares"), "<f4"))]
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    return fit([held[i] for i in order.tolist()], rows.column("toxic").to_numpy()[order].astype(np.int64), settings)


def _views(values: pa.Array, kind: str) -> list[np.ndarray]:
    """The numbers in each value of a binary array, without a copy."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int32, len(values) + 1, 4 * values.offset).tolist()
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return [raw[a:b].view(kind) for a, b in zip(ends[:-1], ends[1:])]


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (probability of class 1) of every row, from its whole text alone.

    A null text is empty and has the score of the bias; null and repeated ids stay; further
    columns are ignored; an empty table gives no rows.
    """
    reach_workers(docs.sparkSession)
    weights, bias, settings = model.gram_weights(), float(model.bias[1] - model.bias[0]), model.settings

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            scores = score_texts(filled(part.column("text")), weights, bias, settings)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns as they are and whatever their names, whose score is below ``threshold``.

    Null and empty texts have the score of the bias, so they all stay or all go; repeated rows
    stay or go together; an empty table stays empty.
    """
    reach_workers(docs.sparkSession)
    weights, bias, settings = model.gram_weights(), float(model.bias[1] - model.bias[0]), model.settings

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            scores = score_texts(filled(part.column("text")), weights, bias, settings)
            yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(keep, docs.schema)
