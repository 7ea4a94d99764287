"""New trip files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rideframe.sources.trips import tip_trips, typed_schema


def stream_trips(
    spark: SparkSession, path: str, service: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Trips of one service in canonical columns, file by file as they arrive."""
    reader = spark.readStream.schema(typed_schema(service)).option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return tip_trips(reader.parquet(path), service)
