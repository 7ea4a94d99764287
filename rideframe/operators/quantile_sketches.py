"""Approximate quantiles as stored sketches that merge, for every group of a table at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.session import stage
from rideframe.spec import QUANTILE_ERROR

# A KLL sketch of size k has, with a probability of 99 %, a rank error of at most 2.296 / k ** 0.9723.
# Sketches are made for a third of the wanted error, which is nearly eight standard deviations.
ERROR_FACTOR, ERROR_POWER, SAFETY = 2.296, 0.9723, 3
LEAST_SIZE, MOST_SIZE = 8, 65535


def sketch_size(relative_error: float = QUANTILE_ERROR) -> int:
    """The size of a sketch whose ranks are off by at most this share of the rows."""
    if not 0 < relative_error < 1:
        raise ValueError("the relative error must lie between 0 and 1")
    size = math.ceil((SAFETY * ERROR_FACTOR / relative_error) ** (1 / ERROR_POWER))
    if size > MOST_SIZE:
        raise ValueError(f"no sketch is that exact ({relative_error}); take exact quantiles")
    return max(LEAST_SIZE, size)


def quantile_sketches(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), relative_error: float = QUANTILE_ERROR
) -> DataFrame:
    """One row per combination of ``keys`` with a sketch of each column, in place of its values.

    One aggregation for all groups and columns. Each task sketches its rows first, so only
    sketches (18 kB at the default error) are shuffled and a hot group costs no more than any
    other. Null and NaN are left out. Without keys there is one row, even for an empty table.
    """
    size = F.lit(sketch_size(relative_error))
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(c) for c in columns])


def merge_sketches(sketches: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of fewer keys, from stored ones: days into months, services into all trips."""
    return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])


def sketch_quantiles(sketches: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Each sketch replaced by the array of its quantiles; null where it holds no value."""
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    found = {
        c: F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, points)) for c in columns
    }
    return sketches.withColumns(found)


def trim_by_sketch(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    relative_error: float = QUANTILE_ERROR,
) -> DataFrame:
    """Keep rows within the approximate quantiles of every column of their group, both ends included.

    The sketches are written, as they are random: every use of the result then sees the same
    bounds. No bound passes through the driver. Without keys the bounds are scalar sub-queries,
    which the scan of a written table uses as filters; with keys they are joined. Keys match by
    value, null to null; a group without any value in one of the columns has no row left.
    """
    columns, keys = list(dict.fromkeys(columns)), list(keys)
    sketches = stage(quantile_sketches(df, columns, keys, relative_error), "quantile-sketches")
    ends = [min(probabilities), max(probabilities)]
    found = sketch_quantiles(sketches, columns, ends)
    bounds = found.select(
        *[F.col(key).alias(f"__key_{key}") for key in keys],
        *[F.get(c, F.lit(i)).alias(f"__{end}_{c}") for c in columns for i, end in enumerate(("low", "high"))],
    )
    if not keys:
        for c in columns:
            low, high = (bounds.select(f"__{end}_{c}").scalar() for end in ("low", "high"))
            df = df.filter((F.col(c) >= low) & (F.col(c) <= high))
        return df
    on = [F.col(key).eqNullSafe(F.col(f"__key_{key}")) for key in keys]
    on += [F.col(c).between(F.col(f"__low_{c}"), F.col(f"__high_{c}")) for c in columns]
    return df.join(bounds, on).select(*df.columns)
