"""Decimal rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, decimals: int) -> Column:
    """Round half away from zero on the shortest decimal text of a double."""
    return F.round(value, decimals)


#: What a scaled double may be off by, as a share of it and at least; nearer to a tie it is not told apart from one.
SCALED_SHARE = 1e-15
NEAR_TIE = 1e-4


def half_up_double(value: Column, decimals: int) -> Column:
    """``half_up`` of a double, with decimal arithmetic only next to a tie or for large numbers.

    Elsewhere the nearest whole number of units is certain, and its quotient by the scale is
    the double nearest to the decimal that ``half_up`` gives: the results are equal. Zero added
    makes a negative zero a plain one, as decimals have it.
    """
    scale = float(10**decimals)
    scaled = value * scale
    units = F.rint(scaled)
    certain = F.abs(scaled - units) + F.abs(scaled) * SCALED_SHARE < 0.5 - NEAR_TIE
    return F.when(certain, (units + 0.0) / scale).otherwise(F.round(value, decimals))


def half_up_binary(value: Column, decimals: int) -> Column:
    """Round by scaling the double itself; differs from ``half_up`` only at ties.

    1.005 becomes 1.0 here and 1.01 with ``half_up``. It avoids decimal arithmetic, so
    it is the cheaper form for columns computed on every row.
    """
    scale = float(10**decimals)
    return F.floor(value * scale + 0.5) / scale


def exact_average(value: Column, decimals: int, weight: Column | None = None) -> Column:
    """Average of a column that holds at most ``decimals`` decimals.

    The sum runs over whole units (cents for money), so it does not depend on the order
    of the rows, the partitioning or a retried task, as a sum of doubles does.
    """
    scale = 10**decimals
    units = F.floor(value * float(scale) + 0.5)
    if weight is None:
        return F.try_divide(F.sum(units), F.count(value) * scale)
    present = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(units * weight), F.sum(present) * scale)
