"""Minutes of a trip inside daily hour zones."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from rideframe.functions.dates import millis_of_day
from rideframe.functions.rounding import half_up_double
from rideframe.spec import ZoneSpec

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def _pieces(zone: ZoneSpec, midnight_gap_s: int) -> list[tuple[int, int]]:
    """The zone as intervals within one day, in milliseconds after midnight."""
    start, end = zone.start_hour * HOUR_MS, zone.end_hour * HOUR_MS
    if zone.start_hour > zone.end_hour:
        return [(start, DAY_MS - midnight_gap_s * 1000), (0, end)]
    return [(start, end)]


def day_span(pickup: Column, dropoff: Column) -> tuple[Column, Column, Column]:
    """Milliseconds of day of both times and the days between them.

    Name these as columns of their own before using them in ``zone_minutes_of_span``, so
    that they are computed once per row.
    """
    days = F.date_diff(F.to_date(dropoff), F.to_date(pickup)).cast("bigint")
    return millis_of_day(pickup), millis_of_day(dropoff), days


def zone_minutes_of_span(
    start: Column,
    end: Column,
    days: Column,
    zone: ZoneSpec,
    unit: str = "minute",
    midnight_gap_s: int = 0,
) -> Column:
    """``zone_minutes`` from the milliseconds of day and the days between them."""
    if unit == "minute":
        per_unit, decimals, half = 60000.0 / 10**4, 10**4, 0.5
    elif unit == "minute_trunc":
        per_unit, decimals, half = 60000.0, 1, 0.0
    else:
        raise ValueError(f"unknown zone unit {unit!r}")

    def rounded(millis: Column) -> Column:
        return F.floor(F.greatest(millis, F.lit(0)) / per_unit + half)

    pieces = _pieces(zone, midnight_gap_s)
    same_day, last_days, full_units = [], [], 0
    for low, high in pieces:
        from_low = F.greatest(start, F.lit(low))
        to_high = F.least(end, F.lit(high))
        same_day.append(rounded(to_high - from_low))
        last_days += [rounded(high - from_low), rounded(to_high - low)]
        full_units += int((high - low) / per_unit + half)
    units = (
        F.when(days == 0, reduce(add, same_day))
        .when(days > 0, reduce(add, last_days) + (days - 1) * full_units)
        .otherwise(F.lit(0))
    )
    return units / float(decimals)


def zone_minutes(
    pickup: Column,
    dropoff: Column,
    zone: ZoneSpec,
    unit: str = "minute",
    midnight_gap_s: int = 0,
) -> Column:
    """Minutes of [pickup, dropoff] that fall in the zone, for trips of any length.

    A trip touches its first day, its last day and whole days in between, so the sum
    over days needs three terms and no loop; it is plain arithmetic that stays in
    generated code. ``unit`` sets the rounding of each daily piece: ``minute`` keeps four
    decimals, ``minute_trunc`` whole minutes. ``midnight_gap_s=1`` ends a wrapping zone
    at 23:59:59 of each day.
    """
    return zone_minutes_of_span(*day_span(pickup, dropoff), zone, unit, midnight_gap_s)


def zone_share(minutes: Column, duration: Column, decimals: int = 4) -> Column:
    """Share of the duration in percent; null if the duration is zero or null."""
    return half_up_double(F.try_divide(minutes * 100, duration), decimals)
