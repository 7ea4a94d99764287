"""Average prices of trip classes and the deviation of each trip from its class."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideframe.functions.money import price_deviation, price_deviation_pct
from rideframe.functions.rounding import exact_average, half_up

PRICES = ("cost_per_distance", "cost_per_time")


def price_cells(df: DataFrame, class_columns: Sequence[str]) -> DataFrame:
    """Trips counted per class and pair of unit prices.

    Prices carry two decimals and classes are made of bins, so many trips of a large
    table share a cell. Everything the price report needs is a function of the cell, and
    partial counts merge the trips of a cell, hot or not, before the only shuffle of
    trip-sized data.
    """
    return df.groupBy(*class_columns, *PRICES).agg(F.count(F.lit(1)).alias("n_trips"))


def class_averages(
    df: DataFrame,
    class_columns: Sequence[str],
    decimals: int = 4,
    positive_only: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """Average price per mile and per minute of each class.

    ``weight`` names the trip count when the rows are cells rather than trips.
    ``positive_only`` drops classes with an average of zero or less.
    """
    count = F.col(weight) if weight else None
    averages = df.groupBy(*class_columns).agg(
        *[half_up(exact_average(F.col(p), 2, count), decimals).alias(f"avg_{p}") for p in PRICES],
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("n_class"),
    )
    if positive_only:
        averages = averages.filter(reduce(and_, [F.col(f"avg_{p}") > 0 for p in PRICES]))
    return averages


def looked_up(averages: DataFrame) -> DataFrame:
    """Averages that are joined by a lookup, for rows that are far more than their classes.

    A task holds the classes of its partition, each once, and passes the rows by. The sort of a
    merge join would hold all rows of the partition. A partition has no more classes than rows,
    and a class with very many rows is still one entry.
    """
    return averages.hint("shuffle_hash")


def attach_class_averages(
    df: DataFrame,
    averages: DataFrame,
    class_columns: Sequence[str],
    how: str = "inner",
    null_safe: bool = True,
) -> DataFrame:
    """Put the averages of its class on every row.

    No join hint: the averages are broadcast when their size is known to be below the
    session's threshold, at planning or at run time, and are joined by shuffle beyond it,
    where adaptive execution splits a class that holds too many rows. A caller whose rows are
    many may hint the averages; see ``looked_up``.
    """
    averages = averages.drop("n_class")
    if not null_safe:
        return df.join(averages, list(class_columns), how)
    right = averages.select(
        *[F.col(c).alias(f"__{c}") for c in class_columns],
        *[f"avg_{p}" for p in PRICES],
    )
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in class_columns])
    return df.join(right, on, how).drop(*[f"__{c}" for c in class_columns])


def with_price_deviation(df: DataFrame, form: str = "rounded_diff") -> DataFrame:
    """Add the deviation from the class average, in percent and, in the rounded form, in money."""
    columns: list[Column] = []
    for price in PRICES:
        value, average = F.col(price), F.col(f"avg_{price}")
        if form == "rounded_diff":
            columns.append(price_deviation(value, average).alias(f"{price}_diff"))
        columns.append(price_deviation_pct(value, average, form).alias(f"{price}_diff_pcg"))
    return df.select("*", *columns)
