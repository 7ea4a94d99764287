"""Register of the queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideframe.catalog.fixtures import TRIPS_SQL, WEATHER_SQL
from rideframe.spec import SERVICES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def on_trips(select: str, *ctes: str) -> str:
    """SQL over the derived trips, with further common tables."""
    return "WITH " + ",\n".join([TRIPS_SQL.strip(), *[c.strip() for c in ctes]]) + "\n" + select


def on_weather(select: str, *ctes: str) -> str:
    return on_trips(select, WEATHER_SQL, *ctes)


def per_service(build: Callable[[str], DataFrame]) -> DataFrame:
    """The result of each service, told apart by a column."""
    parts = [
        build(service).select(F.lit(service).alias("service_type"), "*") for service in SERVICES
    ]
    return reduce(DataFrame.unionByName, parts)


def union_sql(build: Callable[[str], str]) -> str:
    """One statement per service; each holds its own common tables in a sub-query."""
    return " UNION ALL ".join(
        f"SELECT '{service}' AS service_type, * FROM ({build(service)})" for service in SERVICES
    )


def r(expression: str, decimals: int) -> str:
    """Round half up on the decimal text of a double."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,20)), {decimals}) AS DOUBLE)"


def r_even(expression: str, decimals: int) -> str:
    """Round half to even on the decimal text of a double."""
    scaled = f"(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(30,20)) * {10**decimals})"
    floor = f"floor({scaled})"
    return (
        f"CAST(CASE WHEN {scaled} - {floor} > 0.5 OR ({scaled} - {floor} = 0.5 AND {floor} % 2 <> 0)"
        f" THEN {floor} + 1 ELSE {floor} END AS DOUBLE) / {10**decimals}"
    )


def step(expression: str, width: int) -> str:
    """Label of a step bin."""
    low = f"CAST(floor(({expression}) / {width}) * {width} AS BIGINT)"
    return f"'[' || {low} || '|' || ({low} + {width}) || ')'"
