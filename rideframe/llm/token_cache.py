"""Token counts behind a digest cache."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rideframe.llm.encoding import encoder
from rideframe.llm.support import reach_workers, text_slices
from rideframe.session import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CACHE_SCHEMA = "digest binary, n_tokens long"


def unchanged(text: Column) -> Column:
    return text


def folded(text: Column) -> Column:
    """For tokenizers that lower-case texts and drop white space: ASCII case and white space runs.

    A text that may hold a special token, all of which begin with ``<|``, keeps its case,
    since such tokens are matched before lower-casing.
    """
    spaced = F.trim(F.regexp_replace(text, r"[ \t\n\r]+", " "))
    return F.when(F.contains(text, F.lit("<|")), spaced).otherwise(F.translate(spaced, UPPER, UPPER.lower()))


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    digest = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Stored counts of one tokenizer version; none if nothing was stored yet."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(CACHE_SCHEMA).parquet(folder)
    return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_folder: str, limit: int = 2048, normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """Tokens of every whole text, encoding only contents that the cache does not hold.

    Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit, one row per row of ``docs``.
    Contents are known by the SHA-256 digest of their normalised text, kept in a folder per
    tokenizer version; ``normalise`` must not change counts. Each distinct miss is encoded
    once, by the first document that holds it, and appended to the cache. Only the texts of
    misses move between machines, spread by document and not by content, so a content that
    a third of all rows share is no hot key. A null text counts as empty; null or repeated ids
    are kept; further columns are ignored; an empty table gives no rows. Two writers at a time
    may store a content twice, which readers allow for.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    folder = f"{cache_folder.rstrip('/')}/{tokenizer_version(tokenizer_path)}"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select("doc_id", text.alias("text"))
    digest = F.unhex(F.sha2(normalise(F.col("text")), 256))
    keyed = stage(source.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "token-digests")
    contents = keyed.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    known = read_cache(spark, folder).select("digest").distinct()
    misses = stage(contents.join(known, "digest", "left_anti"), "token-misses")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(tokenizer_path)
        for part in text_slices(batches, "text"):
            counts = counter.count(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    texts = source.withColumn("digest", digest)
    texts = texts.join(misses.withColumnRenamed("digest", "missed"), texts.doc_id.eqNullSafe(F.col("first_id")) & (texts.digest == F.col("missed")), "left_semi")
    texts.select("digest", "text").mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(folder)
    stored = read_cache(spark, folder).join(contents.select("digest"), "digest", "left_semi")
    counts = stage(stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "token-counts")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
