"""Price anomaly from stored cells: a new or corrected month is counted alone.

The trips of each service and period (a month or a day of pickups) are counted per class
feature and pair of unit prices, and these cells are kept as a partitioned Parquet table.
Cells of different periods merge by adding their counts, and averages are sums of whole
cents over counts, so the report over all stored periods is that of all their trips, to
the last digit, while an update scans the trips of its own periods only.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideframe.operators import classes
from rideframe.plans.price_anomaly import CELL_FEATURES, SERVICE, price_trips_services
from rideframe.sources.reports import read_report, write_report

#: Partition column by period. Its name says the period, so a table cannot hold two kinds.
PERIODS = {"month": "pickup_month", "day": "pickup_day"}

FIRST_OF_ALL = 1


def _period_column(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"a period is one of {', '.join(PERIODS)}, not {period!r}")
    return PERIODS[period]


def _check_window(start: date, end: date, period: str) -> None:
    if start >= end:
        raise ValueError(f"no period lies between {start} and {end}")
    if period == "month" and (start.day != 1 or end.day != 1):
        raise ValueError(f"a month is replaced as a whole: {start} to {end} cuts one")


def in_window(trips: DataFrame, start: date, end: date) -> DataFrame:
    """Trips picked up from ``start`` up to, but not on, ``end``; the condition reaches the scan."""
    pickup = F.col("pickup_datetime")
    first, after = (F.lit(datetime(d.year, d.month, d.day)).cast("timestamp_ntz") for d in (start, end))
    return trips.filter((pickup >= first) & (pickup < after))


def cells_of_window(
    raw: Mapping[str, DataFrame], start: date, end: date, period: str = "month"
) -> DataFrame:
    """Trips counted per service, period, class features and unit prices.

    Every period of the window has one more row for each service, with a count of zero and
    nulls: with it a period that has lost all its trips is still replaced when written.
    """
    name = _period_column(period)
    _check_window(start, end, period)
    trips = in_window(price_trips_services(raw, FIRST_OF_ALL, None), start, end)
    of_pickup = F.trunc(F.to_date("pickup_datetime"), period) if period == "month" else F.to_date("pickup_datetime")
    cells = classes.price_cells(trips.withColumn(name, of_pickup), [SERVICE, name, *CELL_FEATURES])
    calendar = trips.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in raw])).alias(SERVICE),
        F.explode(
            F.sequence(F.lit(start), F.date_sub(F.lit(end), 1), F.expr(f"interval 1 {period}"))
        ).alias(name),
        F.lit(0).cast("bigint").alias("n_trips"),
    )
    return cells.unionByName(calendar, allowMissingColumns=True)


def update_cells(
    raw: Mapping[str, DataFrame], path: str, start: date, end: date, period: str = "month"
) -> None:
    """Count the trips of a window anew and replace its periods in the table at ``path``.

    ``raw`` must hold all trips of the named services in the window, in whichever files they
    are; trips outside it are not looked at. Other periods and services stay untouched, and
    the same update twice gives the same table. A table that does not exist is made.

    Rows are rebalanced by partition before they are written, so that a period gets few
    files; adaptive execution splits a period too large for one task.
    """
    name = _period_column(period)
    cells = cells_of_window(raw, start, end, period).hint("rebalance", SERVICE, name)
    write_report(cells, path, [SERVICE, name], replace="partitions")


def read_cells(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None, period: str = "month"
) -> DataFrame:
    """The stored cells, of all periods or of those from ``start`` up to ``end``.

    Only the folders of these periods are read. A cell has a row in each period it occurs in;
    ``price_anomaly_of_cells`` and ``class_averages_of_cells`` add them up.
    """
    name = _period_column(period)
    cells = read_report(spark, path)
    if name not in cells.columns:
        raise ValueError(f"the table at {path} is not one of a {period}")
    if start is not None:
        cells = cells.filter(F.col(name) >= F.lit(start))
    if end is not None:
        cells = cells.filter(F.col(name) < F.lit(end))
    return cells.filter(F.col("n_trips") > 0)
