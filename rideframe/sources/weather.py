"""Reading the daily weather and the weather code list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather from CSV: first column the date, second the weather code.

    A row whose date or code cannot be read is left out.
    """
    raw = spark.read.csv(path, header=True)
    day, code = raw.columns[0], raw.columns[1]
    return raw.select(
        F.trim(F.col(f"`{code}`")).try_cast("int").alias("wmo_code"),
        F.try_to_timestamp(F.trim(F.col(f"`{day}`")), F.lit("yyyy-MM-dd")).cast("date").alias("date"),
    ).dropna()


def read_wmo_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Code list from a file of ``code;description`` lines below a header.

    The semicolon is the separator, so a comma in a description is kept. A row whose code
    cannot be read is left out.
    """
    raw = spark.read.csv(path, header=True, sep=";")
    code, description = raw.columns[0], raw.columns[1]
    return raw.select(
        F.trim(F.col(f"`{code}`")).try_cast("int").alias("wmo_code"),
        F.trim(F.col(f"`{description}`")).alias("description"),
    ).dropna(subset=["wmo_code"])
