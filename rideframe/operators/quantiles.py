"""Quantiles of numeric columns and trimming by them.

What returns numbers returns a handful to the driver, whatever the size of the input.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideframe.operators.quantile_sketches import trim_by_sketch
from rideframe.spec import QUANTILE_ERROR, TRIM_QUANTILES

# Sub-ranges per pass and quantile. It bounds the rows that a pass returns.
SUB_RANGES = 512


def approx_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = QUANTILE_ERROR,
) -> dict[str, list[float]]:
    """Approximate quantiles of several columns in one pass over the data."""
    rows = df.approxQuantile(list(columns), list(probabilities), relative_error)
    return dict(zip(columns, rows))


def _target_rank(probability: float, count: int, rank_rule: str) -> int:
    """1-based rank of the wanted value among ``count`` sorted values."""
    # Rounded first, so that 0.3 of 10 rows is 3 rows in spite of binary fractions.
    share = round(probability * count, 6)
    if rank_rule == "disc":
        return max(1, math.ceil(share))
    if rank_rule == "floor":
        # Zero-based index floor(q * n); past the end it stands for the minimum.
        index = math.floor(share)
        return index + 1 if index < count else 1
    raise ValueError(f"unknown rank rule {rank_rule!r}")


def _double(value: float) -> str:
    return f"cast('{value!r}' as double)"


def _share(low: float | None, high: float | None) -> str:
    """Where a value stands between two finite ends, from 0 to 1.

    A range wider than the largest double is halved before it is measured.
    """
    if low is None or low == high:
        return "0"
    if math.isinf(high - low):
        return f"(value / 2 - {_double(low / 2)}) / {_double(high / 2 - low / 2)}"
    return f"(value - {_double(low)}) / {_double(high - low)}"


def _hit(target: int, column: str, low: float, high: float, finite: tuple) -> str:
    """The sub-range of an open quantile that a counted value falls in, else null.

    The two ends of the range, which may be infinite, get sub-ranges of their own, so each
    pass narrows it; the finite values between are divided evenly.
    """
    bottom, top = _double(low), _double(high)
    inner = f"greatest(0, least(floor({_share(*finite)} * {SUB_RANGES}), {SUB_RANGES - 1}))"
    part = f"case when value = {bottom} then -1 when value = {top} then {SUB_RANGES} else {inner} end"
    return (
        f"case when feature = '{column}' and value between {bottom} and {top}"
        f" then named_struct('target', {target}, 'part', cast({part} as int)) end"
    )


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    rank_rule: str = "disc",
    weight: str | None = None,
) -> dict[str, list[float]]:
    """Exact quantiles of several columns, found by rank; null and NaN are left out.

    ``weight`` names a column that says for how many rows a row stands.

    One pass counts the distinct values of all columns, with partial counts before the
    shuffle, so a value that holds most rows costs no more than a rare one. Further passes
    read only those counts. Each narrows every open quantile to one of 512 sub-ranges by
    value, until the sub-range holds a single value; no sort and no single-task step.
    """
    columns = list(wanted)
    counts = (
        df.select((F.col(weight) if weight else F.lit(1)).alias("n"), *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(["n"], columns, "feature", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(F.sum("n").alias("n"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        found: dict[tuple[str, float], float | None] = {}
        ranges: dict[tuple[str, float], tuple[float, float, tuple, int]] = {}
        finite = F.when(F.abs("value") < float("inf"), F.col("value"))
        ends = (
            F.sum("n").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.min(finite).alias("finite_low"),
            F.max(finite).alias("finite_high"),
        )
        summary = counts.groupBy("feature").agg(*ends)
        for row in summary.collect():
            for q in wanted[row.feature]:
                rank = _target_rank(q, row.n, rank_rule)
                if row.low == row.high:
                    found[row.feature, q] = row.low
                else:
                    ranges[row.feature, q] = (row.low, row.high, (row.finite_low, row.finite_high), rank)
        while ranges:
            targets = list(ranges)
            hits = ", ".join(_hit(i, key[0], *ranges[key][:3]) for i, key in enumerate(targets))
            parts = (
                counts.selectExpr(f"explode(array({hits})) as hit", "value", "n")
                .filter("hit is not null")
                .groupBy("hit.target", "hit.part")
                .agg(*ends)
            )
            passed = dict.fromkeys(targets, 0)
            open_ranges: dict[tuple[str, float], tuple[float, float, tuple, int]] = {}
            # At most 514 rows per quantile.
            for row in sorted(parts.collect(), key=lambda r: (r.target, r.part)):
                key = targets[row.target]
                rank = ranges[key][3]
                before = passed[key]
                passed[key] = before + row.n
                if before < rank <= passed[key]:
                    if row.low == row.high:
                        found[key] = row.low
                    else:
                        open_ranges[key] = (row.low, row.high, (row.finite_low, row.finite_high), rank - before)
            ranges = open_ranges
    finally:
        counts.unpersist()
    return {c: [found.get((c, q)) for q in wanted[c]] for c in columns}


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    method: str = "approx",
    relative_error: float = QUANTILE_ERROR,
) -> dict[str, list[float]]:
    if method == "approx":
        return approx_quantiles(df, columns, probabilities, relative_error)
    if method == "exact":
        return exact_quantiles(df, {c: list(probabilities) for c in columns})
    raise ValueError(f"unknown quantile method {method!r}")


def exact_quantiles_by_key(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] | Mapping[str, Sequence[float]],
    key: str,
    values: Sequence[str],
    weight: str | None = None,
) -> dict[str, dict[str, list[float]]]:
    """Exact quantiles of each column for each of the given values of ``key``, in one job.

    ``values`` are few, such as the names of services; rows with another key are left out.
    """
    parts = {(value, c): f"{i}:{c}" for i, value in enumerate(values) for c in columns}
    split = df.select(
        *([weight] if weight else []),
        *[F.when(F.col(key) == value, F.col(c)).alias(name) for (value, c), name in parts.items()],
    )
    wanted = {
        name: list(probabilities[c] if isinstance(probabilities, Mapping) else probabilities)
        for (_, c), name in parts.items()
    }
    found = exact_quantiles(split, wanted, weight=weight)
    return {value: {c: found[parts[value, c]] for c in columns} for value in values}


def trim_outliers(
    df: DataFrame,
    columns: Sequence[str] = ("trip_distance", "trip_duration_min"),
    probabilities: Sequence[float] = TRIM_QUANTILES,
    method: str = "approx",
    relative_error: float = QUANTILE_ERROR,
    key: str | None = None,
    values: Sequence[str] = (),
) -> DataFrame:
    """Keep rows within the quantile bounds of every column, both ends included.

    The bounds of all columns are taken before any row is removed; with ``key`` each group
    has its own. Approximate bounds come from sketches and stay on the executors. Exact
    ones come back as literals, which the scan of a written table can use; they need the
    ``values`` of the key, and rows with another one go.
    """
    if method == "approx":
        return trim_by_sketch(df, columns, probabilities, [key] if key else [], relative_error)
    if key is None:
        return df.filter(_within(quantiles(df, columns, probabilities, method, relative_error)))
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    bounds = exact_quantiles_by_key(df, columns, probabilities, key, values)
    kept = [(F.col(key) == value) & _within(bounds[value]) for value in values]
    return df.filter(reduce(or_, kept, F.lit(False)))


def _within(bounds: Mapping[str, Sequence[float | None]]) -> Column:
    """Whether every column lies between its first and its last bound; never, where it has none."""
    inside = [
        F.col(c).between(found[0], found[-1]) if found and None not in found else F.lit(False)
        for c, found in bounds.items()
    ]
    return reduce(and_, inside, F.lit(True))
