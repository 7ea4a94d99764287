"""Writing and reading report tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def conform(df: DataFrame, schema: Iterable[tuple[str, str]]) -> DataFrame:
    """Columns in the order, with the names and types, of a result schema."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in schema])


def write_report(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    replace: str = "table",
) -> None:
    """Write the Parquet table at ``path``.

    ``replace`` says what the rows take the place of: the whole ``table``, the ``partitions``
    of ``partition_by`` that they belong to, or ``nothing``, which adds them. Partitions
    without a new row stay as they are.

    ``single_file`` is for a finished, small report: the shuffle before it keeps its
    own parallelism, only the last step runs as one task.
    """
    if replace not in ("table", "partitions", "nothing"):
        raise ValueError(f"unknown part to replace: {replace!r}")
    if replace == "partitions" and not partition_by:
        raise ValueError("only a table with partition columns has partitions to replace")
    if single_file:
        df = df.repartition(1)
    writer = df.write.mode("append" if replace == "nothing" else "overwrite")
    # Said here for every write, so that no setting of the session changes what is replaced.
    writer = writer.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
