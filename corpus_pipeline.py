"""The corpus pipeline: stages over ``documents``, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rideframe.llm.chosen_path import drop_near_copies
from rideframe.llm.fertility import drop_low_quality
from rideframe.llm.packing import pack_documents
from rideframe.llm.support import table
from rideframe.llm.toxicity import drop_toxic, train_toxicity
from rideframe.session import stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, train_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, public_tokenizers.path("piece_bpe_32k.model"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, similarity=0.8, recall=0.99)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("quality rules", of_quality),
    ("n-gram Jaccard join", without_copies),
    ("packing", pack),
]

#: The trained toxicity model cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
