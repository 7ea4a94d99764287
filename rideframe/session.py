"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 50_000


def shuffle_partitions_for(input_bytes: int, cores: int, most: int = MAX_SHUFFLE_PARTITIONS) -> int:
    """Shuffle partitions for an input of this size: near 128 MB each, one per core at least.

    The count is bounded by ``most``, since every map task reports a size for each partition. The
    largest shuffle here, of distinct trips, carries a part of the columns and the rows
    that passed the filters; at 100 TB of input a partition then holds some 500 MB, which
    an aggregation spills to disk where it must.
    """
    wanted = math.ceil(input_bytes / TARGET_PARTITION_BYTES)
    return max(cores, min(wanted, most))


def build_session(
    app_name: str = "rideframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on; AQE merges surplus shuffle partitions.

    Start from a high partition count (``shuffle_partitions_for``) on a large input:
    AQE can merge partitions and split skewed join partitions, but it cannot split a
    partition of an aggregation that is too large for its executor.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(TARGET_PARTITION_BYTES))
        # Recording the Python line of every column expression costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rideframe-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/rideframe/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def written_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or of all files in a folder."""
    place, files = _file_system(spark, path)
    return files.getContentSummary(place).getLength()


def drop_stages(spark: SparkSession) -> None:
    """Remove all tables that this application has staged; results not yet written need them."""
    place, files = _file_system(spark, _own_folder(spark))
    files.delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the result of a full shuffle. The table survives the
    loss of any executor and reads back column by column. It stays until ``drop_stages``.
    """
    return stage_sized(df, name)[0]


def stage_sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stage``, and the bytes that were written."""
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), written_bytes(spark, path)
