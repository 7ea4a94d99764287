"""Joining trips with the weather of their pickup date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.functions.weather import weather_class
from rideframe.session import stage_sized

#: Largest size of the written daily weather, as Parquet, that is broadcast: some millions of days.
BROADCAST_BYTES = 16 * 1024 * 1024


def describe_weather(weather: DataFrame, lookup: DataFrame) -> DataFrame:
    """Weather rows with the description of their code; codes not listed lose their dates."""
    return weather.join(lookup, "wmo_code").select("date", "wmo_code", "description")


def one_row_per_date(weather: DataFrame) -> DataFrame:
    """The row with the lowest code of each date, so that no trip is counted twice."""
    lowest = F.min(F.struct("wmo_code", "description")).alias("lowest")
    return weather.groupBy("date").agg(lowest).select("date", "lowest.*")


def attach_weather(df: DataFrame, weather: DataFrame, day: str) -> DataFrame:
    """Rows that carry their date in column ``day``, with the weather code and class of it.

    Meant for sums per date: a row stands once for each weather row of its date, so sums
    count a trip as often as the trip itself would appear. No trip is shuffled for it.
    """
    classes = weather.select(F.col("date").alias(day), weather_class(F.col("wmo_code")).alias("weather"))
    return df.join(classes, day)


def join_weather(
    trips: DataFrame, weather: DataFrame, dedupe: bool = True, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Trips with the weather code, description and class of their pickup date.

    With ``dedupe`` a date has one weather row; without it a trip appears once per
    weather row of its date. The daily table is written first: up to ``broadcast_bytes``
    it is broadcast and trips are not shuffled; beyond that both sides are shuffled by
    date, and as the written side is a plain scan, a date with many trips can be split.
    """
    if dedupe:
        weather = one_row_per_date(weather)
    weather, size = stage_sized(weather, "daily-weather")
    if size <= broadcast_bytes:
        weather = F.broadcast(weather)
    return (
        trips.join(weather, F.to_date(trips["pickup_datetime"]) == weather["date"])
        .drop("date")
        .withColumn("weather", weather_class(F.col("wmo_code")))
    )
