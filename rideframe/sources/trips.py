"""Reading trip files and bringing services to one schema."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideframe.spec import CANONICAL_NAMES, CANONICAL_TYPES, PRICE_COLUMNS, TIP_COLUMNS

# Prefix of the two time columns in the files of each service.
TIME_PREFIX = {"yellow": "tpep", "green": "lpep"}


def typed_schema(service: str) -> T.StructType:
    """File schema of the tip analysis; times are wall-clock times without a zone."""
    prefix = TIME_PREFIX[service]
    return T.StructType(
        [
            T.StructField(f"{prefix}_pickup_datetime", T.TimestampNTZType()),
            T.StructField(f"{prefix}_dropoff_datetime", T.TimestampNTZType()),
            T.StructField("VendorID", T.IntegerType()),
            T.StructField("fare_amount", T.DoubleType()),
            T.StructField("tip_amount", T.DoubleType()),
            T.StructField("payment_type", T.LongType()),
            T.StructField("trip_distance", T.DoubleType()),
            T.StructField("total_amount", T.DoubleType()),
        ]
    )


def scan_trips(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Trips of one service with the schema found in its Parquet files."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path)


def scan_trips_typed(spark: SparkSession, path: str, service: str) -> DataFrame:
    """Trips of one service with the fixed schema, from all sub-folders."""
    return (
        spark.read.schema(typed_schema(service))
        .option("recursiveFileLookup", "true")
        .parquet(path)
    )


def normalize_columns(df: DataFrame, keep: Iterable[str] = PRICE_COLUMNS) -> DataFrame:
    """Lower-case the column names and keep those on the list, in file order."""
    wanted = {name.lower() for name in keep}
    return df.select(*[F.col(c).alias(c.lower()) for c in df.columns if c.lower() in wanted])


def canonical_trips(df: DataFrame, service: str) -> DataFrame:
    """Rename and cast the columns of a service and add its name; unreadable text becomes null.

    Columns that a file lacks (the airport fee of green trips) stay absent.
    """
    columns = [
        F.col(c).try_cast(CANONICAL_TYPES[CANONICAL_NAMES[c.lower()]]).alias(CANONICAL_NAMES[c.lower()])
        for c in df.columns
        if c.lower() in CANONICAL_NAMES
    ]
    return df.select(F.lit(service).alias("service_type"), *columns)


def tip_trips(df: DataFrame, service: str) -> DataFrame:
    """The columns of the tip analysis, the same for every service."""
    return canonical_trips(df, service).select("service_type", *TIP_COLUMNS)


def union_services(*services: DataFrame) -> DataFrame:
    """Rows of all services, columns matched by name."""
    return reduce(DataFrame.unionByName, services)
