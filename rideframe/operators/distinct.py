"""Distinct rows of a large table in which copies are few, without a shuffle of whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.operators.weather import BROADCAST_BYTES
from rideframe.session import stage, stage_sized

DIGEST = "__digest"


def distinct_by_digest(df: DataFrame, name: str = "distinct", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The distinct rows of ``df``, the same as ``dropDuplicates`` gives, as written tables.

    The rows are written once, each with a hash of 64 bits, and only the hashes are shuffled
    and counted. Rows whose hash stands alone have no copy and stay where they are. The
    others, copies and the few rows whose hashes meet by chance, are compared in full, so
    the result is exact. Equal rows have equal hashes: nulls, NaN and the two zeros too.

    The hashes that occur twice or more are broadcast if their table takes ``broadcast_bytes``
    at most, as measured; beyond that too many rows have copies for this to pay, and the
    written rows are made distinct by one shuffle of them all. Partial counts take care of a
    row with any number of copies in either way. An empty table stays empty; columns keep
    their order and types, and none may be called ``__digest``. Columns of maps are refused
    by Spark, as by ``dropDuplicates``.
    """
    columns = df.columns
    if DIGEST in {c.lower() for c in columns}:
        raise ValueError(f"a column is called {DIGEST}")
    rows = stage(df.withColumn(DIGEST, F.xxhash64(*columns)), name)
    counts = rows.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("n"))
    repeated, size = stage_sized(counts.filter("n > 1").select(DIGEST), f"{name}-digests")
    if size > broadcast_bytes:
        return stage(rows.select(*columns).dropDuplicates(), f"{name}-rows")
    few = F.broadcast(repeated)
    copies = rows.join(few, DIGEST, "left_semi").select(*columns).dropDuplicates()
    alone = rows.join(few, DIGEST, "left_anti").select(*columns)
    return alone.unionByName(stage(copies, f"{name}-copies"))
