"""Filters, projections and coercions. All are row-local and need no shuffle but ``dedupe``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideframe.functions.dates import millis_between
from rideframe.spec import (
    FEE_COLUMNS,
    FEE_COLUMNS_WITH_TOLLS,
    MAX_FEE,
    MAX_TIP_TO_FARE,
    MAX_TOLLS,
    PAYMENT_TYPES,
    RATE_CODE_UNKNOWN,
    RATE_CODES,
    STORE_FLAGS,
    VENDORS,
)

FLOATING = ("double", "float")
DECIMAL_TEXT = r"^-?\d+\.\d+$"
INTEGER_TEXT = r"^-?\d+$"


def _all_of(predicates: Sequence[Column]) -> Column:
    return reduce(and_, predicates, F.lit(True))


def number_of_text(column: Column) -> Column:
    """Text that reads as a whole or decimal number, as a double; null for other text."""
    readable = column.rlike(DECIMAL_TEXT) | column.rlike(INTEGER_TEXT)
    return F.when(readable, column).try_cast("double")


def coerce_columns(df: DataFrame) -> DataFrame:
    """Give every column the type the price analysis expects of its cells.

    Numbers become double, other values trimmed text, booleans and integers stay. Text
    that reads as a number has to be told apart per cell, so a text column ``c`` yields
    two typed columns: ``c`` with the trimmed text and ``c_number``, which is null for
    text that is not a number.
    """
    columns: list[Column] = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind in ("bigint", "float"):
            columns.append(column.cast("double").alias(name))
        elif kind in ("int", "double", "boolean"):
            columns.append(column)
        elif kind == "string":
            columns += [F.trim(column).alias(name), number_of_text(column).alias(f"{name}_number")]
        else:
            columns.append(F.trim(column.cast("string")).alias(name))
    return df.select(*columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns. NaN is a value here."""
    return df.filter(" and ".join(f"`{c}` is not null" for c in columns or df.columns))


def drop_incomplete_nan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or a NaN in any of the columns.

    One condition per column, unlike ``na.drop``: the scan can use them, and what is computed
    of the rows left is generated without null checks, which keeps it short enough to be compiled.
    """
    kinds = dict(df.dtypes)
    wanted = list(columns or df.columns)
    present = [f"`{c}` is not null" for c in wanted]
    numbers = [f"not isnan(`{c}`)" for c in wanted if kinds.get(c) in FLOATING]
    return df.filter(" and ".join([*present, *numbers]))


def _number(df: DataFrame, name: str) -> tuple[Column, list[Column]]:
    """A numeric column and the conditions that make it a real number.

    A floating column is compared as it is, so that the comparison reaches the Parquet
    scan; NaN sorts above every number and is excluded on its own. Text is tried as a
    number, and a value of another type is no number.
    """
    kind = dict(df.dtypes)[name]
    column = F.col(name)
    if kind in FLOATING:
        return column, [~F.isnan(column)]
    if kind == "string":
        return number_of_text(column), []
    if kind == "boolean" or kind == "date" or kind.startswith("timestamp"):
        return F.lit(None).cast("double"), []
    return column, []


def feature_ranges(df: DataFrame) -> list[Column]:
    """Valid ranges of the columns that are present; codes are cut to whole numbers first."""
    predicates: list[Column] = []

    def when_present(name: str, test) -> None:
        if name in df.columns:
            column, real = _number(df, name)
            predicates.extend([test(column), *real])

    when_present("passenger_count", lambda c: c >= 1)
    when_present("trip_distance", lambda c: c > 0)
    when_present(
        "ratecode_id",
        lambda c: ((c >= RATE_CODES[0]) & (c < RATE_CODES[1] + 1))
        | ((c >= RATE_CODE_UNKNOWN) & (c < RATE_CODE_UNKNOWN + 1)),
    )
    when_present("payment_type", lambda c: (c >= PAYMENT_TYPES[0]) & (c < PAYMENT_TYPES[1] + 1))
    when_present("fare_amount", lambda c: c > 0)
    when_present("tolls_amount", lambda c: (c >= 0) & (c < MAX_TOLLS))
    if "store_and_fwd_flag" in df.columns:
        predicates.append(F.col("store_and_fwd_flag").isin(*STORE_FLAGS))
    return predicates


def filter_feature_ranges(df: DataFrame) -> DataFrame:
    return df.filter(_all_of(feature_ranges(df)))


def filter_feature_ranges_df(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Ranges of the DataFrame form: codes are not cut, tolls have no lower bound."""
    ranges = {
        "passenger_count": F.col("passenger_count") > 0,
        "trip_distance": F.col("trip_distance") > 0,
        "ratecode_id": F.col("ratecode_id").between(*RATE_CODES)
        | (F.col("ratecode_id") == RATE_CODE_UNKNOWN),
        "store_and_fwd_flag": F.col("store_and_fwd_flag").isin(*STORE_FLAGS),
        "payment_type": F.col("payment_type").between(*PAYMENT_TYPES),
        "fare_amount": F.col("fare_amount") > 0,
        "tolls_amount": F.col("tolls_amount") < MAX_TOLLS,
    }
    present = [c for c in (columns or ranges) if c in df.columns]
    return df.filter(_all_of([ranges[c] for c in present]))


def filter_fee_ranges(df: DataFrame, fees: Sequence[str] = FEE_COLUMNS) -> DataFrame:
    """Keep rows whose present fees all lie in [0, 20)."""
    predicates: list[Column] = []
    for name in fees:
        if name in df.columns:
            column, real = _number(df, name)
            predicates += [column >= 0, column < MAX_FEE, *real]
    return df.filter(_all_of(predicates))


def filter_fee_signs(df: DataFrame, fees: Sequence[str] = FEE_COLUMNS_WITH_TOLLS) -> DataFrame:
    """Keep rows whose present fees are not negative."""
    return df.filter(_all_of([F.col(c) >= 0 for c in fees if c in df.columns]))


def filter_year_window(
    df: DataFrame,
    first_year: int,
    last_year: int | None,
    columns: Sequence[str] = ("pickup_datetime", "dropoff_datetime"),
) -> DataFrame:
    """Keep rows whose times all lie in the years; compared as times, so that the scan
    can skip files and row groups by their statistics. Without ``last_year`` the window
    has no upper end."""
    low = F.lit(datetime(first_year, 1, 1)).cast("timestamp_ntz")
    inside = [F.col(c) >= low for c in columns]
    if last_year is not None:
        high = F.lit(datetime(last_year + 1, 1, 1)).cast("timestamp_ntz")
        inside += [F.col(c) < high for c in columns]
    return df.filter(_all_of(inside))


def filter_positive_duration(df: DataFrame, form: str = "order") -> DataFrame:
    """Keep trips that end after they start.

    ``order`` compares the times; ``minutes`` asks for a positive duration after rounding
    to four decimals.
    """
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    if form == "order":
        return df.filter(dropoff > pickup)
    if form == "minutes":
        # Three milliseconds are the shortest duration that rounds to 0.0001 minutes.
        return df.filter(millis_between(pickup, dropoff) >= 3)
    raise ValueError(f"unknown duration test {form!r}")


def filter_vendor(df: DataFrame) -> DataFrame:
    """Keep the vendors valid for the service of each row.

    On a union of services with a literal service name the optimizer keeps only the
    matching branch of this condition below each side.
    """
    allowed = [
        (F.col("service_type") == service) & F.col("vendor_id").isin(*vendors)
        for service, vendors in VENDORS.items()
    ]
    return df.filter(reduce(lambda a, b: a | b, allowed))


def filter_tip_sanity(df: DataFrame) -> DataFrame:
    """Keep trips with a fare and a distance and with a tip of at most 1.5 fares."""
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    return df.filter(
        (fare > 0) & (tip >= 0) & (tip <= fare * MAX_TIP_TO_FARE) & (F.col("trip_distance") > 0)
    )


def filter_payment_type(df: DataFrame) -> DataFrame:
    return df.filter(F.col("payment_type").between(*PAYMENT_TYPES))


def project_columns(
    df: DataFrame, keep: Sequence[str] | None = None, remove: Sequence[str] = ()
) -> DataFrame:
    """Keep named columns, or remove some; names are compared without case."""
    removed = {name.lower() for name in remove}
    kept = None if keep is None else {name.lower() for name in keep}
    return df.select(
        *[
            c
            for c in df.columns
            if c.lower() not in removed and (kept is None or c.lower() in kept)
        ]
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Distinct rows. Copies collapse within each task before the shuffle."""
    return df.dropDuplicates()
