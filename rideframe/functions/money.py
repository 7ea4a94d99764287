"""Fees, unit prices, deviations from a class average, tip rates and speeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from rideframe.functions.rounding import half_up_binary, half_up_double
from rideframe.spec import LONG_TRIP_MILES, LONG_TRIP_MINUTES


def fee_total(fees: Sequence[Column], distinct: bool = False, decimals: int | None = None) -> Column:
    """Sum of the fees; ``distinct`` counts equal amounts once."""
    if distinct:
        total = F.aggregate(F.array_distinct(F.array(*fees)), F.lit(0.0), add)
    else:
        total = reduce(add, fees)
    return total if decimals is None else half_up_double(total, decimals)


def unit_price(amount: Column, quantity: Column, form: str = "binary") -> Column:
    """Amount per unit at two decimals; null if the quantity is zero."""
    price = F.try_divide(amount, quantity)
    if form == "binary":
        return half_up_binary(price, 2)
    if form == "decimal":
        return half_up_double(price, 2)
    raise ValueError(f"unknown rounding form {form!r}")


def price_deviation(price: Column, average: Column, decimals: int = 4) -> Column:
    return half_up_double(price - average, decimals)


def price_deviation_pct(price: Column, average: Column, form: str = "rounded_diff") -> Column:
    """Deviation in percent of the average.

    ``rounded_diff`` starts from the difference at four decimals and keeps four;
    ``direct`` starts from the plain difference and keeps two.
    """
    if form == "rounded_diff":
        return half_up_double(F.try_divide(price_deviation(price, average), average) * 100, 4)
    if form == "direct":
        return half_up_double(F.try_divide((price - average) * 100, average), 2)
    raise ValueError(f"unknown deviation form {form!r}")


def tip_percentage(tip: Column, total: Column, zero_total: float | None = 0.0) -> Column:
    """Tip in percent of the total; ``zero_total`` is the answer for a total of zero."""
    rate = F.try_divide(tip, total) * 100
    if zero_total is None:
        return rate
    return F.when(total == 0, F.lit(float(zero_total))).otherwise(rate)


def speed_mph(miles: Column, minutes: Column) -> Column:
    """Average speed; zero for trips without a positive duration."""
    return F.when(minutes > 0, miles / (minutes / 60.0)).otherwise(F.lit(0.0))


def long_trip(miles: Column, minutes: Column) -> Column:
    return ((miles > LONG_TRIP_MILES) | (minutes > LONG_TRIP_MINUTES)).cast("int")
