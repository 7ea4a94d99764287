"""Binned columns on a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.functions import bins, labels
from rideframe.operators.quantiles import approx_quantiles, exact_quantiles, exact_quantiles_by_key
from rideframe.spec import QUANTILE_ERROR, TIP_BINS, BinSpec


def with_step_bin(df: DataFrame, column: str, step: int = 5) -> DataFrame:
    """Add ``<column>_bin`` (bin number) and ``<column>_bin_label``."""
    return df.select(
        "*",
        bins.bin_step_value(F.col(column), step).alias(f"{column}_bin"),
        bins.bin_step(F.col(column), step).alias(f"{column}_bin_label"),
    )


def quantile_splits(
    df: DataFrame,
    scales: Mapping[str, int],
    method: str = "approx",
    relative_error: float = QUANTILE_ERROR,
) -> dict[str, list[float]]:
    """Distinct ascending splits at equally spaced quantiles, for all columns in one job."""
    steps = _steps(scales)
    if method not in ("approx", "exact"):
        raise ValueError(f"unknown quantile method {method!r}")
    if method == "exact":
        found = exact_quantiles(df, steps)
    else:
        union = sorted({q for points in steps.values() for q in points})
        rows = approx_quantiles(df, list(scales), union, relative_error)
        found = {
            c: [value for q, value in zip(union, rows[c]) if q in points]
            for c, points in steps.items()
        }
    return {c: _distinct(values) for c, values in found.items()}


def quantile_splits_by_key(
    df: DataFrame, scales: Mapping[str, int], key: str, values: Sequence[str], weight: str | None = None
) -> dict[str, dict[str, list[float]]]:
    """Exact splits of each column for each value of ``key``; a row stands for ``weight`` rows, or for itself."""
    found = exact_quantiles_by_key(df, list(scales), _steps(scales), key, values, weight)
    return {value: {c: _distinct(points) for c, points in found[value].items()} for value in values}


def _steps(scales: Mapping[str, int]) -> dict[str, list[float]]:
    return {c: [i / n for i in range(n + 1)] for c, n in scales.items()}


def _distinct(values: Sequence[float | None]) -> list[float]:
    return sorted({v for v in values if v is not None})


def with_quantile_bin(df: DataFrame, column: str, splits: Sequence[float]) -> DataFrame:
    """Add ``<column>_bin`` (bucket index) and ``<column>_bin_label`` from given splits."""
    if not splits:
        return df.select(
            "*",
            F.lit(None).cast("double").alias(f"{column}_bin"),
            F.lit("Unknown").alias(f"{column}_bin_label"),
        )
    index = bins.bucket_index(F.col(column), splits)
    return df.select(
        "*",
        index.alias(f"{column}_bin"),
        bins.bucket_label(index, splits).alias(f"{column}_bin_label"),
    )


def with_threshold_bins(df: DataFrame, config: Mapping[str, BinSpec] = TIP_BINS) -> DataFrame:
    """Add ``<feature>_bin`` for every feature of the configuration."""
    return df.select(
        "*",
        *[
            bins.bin_thresholds(F.col(name), spec).alias(f"{name}_bin")
            for name, spec in config.items()
        ],
    )


def merge_value_bins(report: DataFrame, max_values: int = 15, top: int = 100) -> DataFrame:
    """Merge the value bins of features that have more than ``max_values`` of them.

    Such a feature gets ``max_values`` whole-number edges between its lowest lower bound
    and its highest, at most ``top``; the last bin is open (``>=edge``). Edges that
    coincide on a narrow range count once; a value below the first edge, which is cut to a
    whole number, belongs to the first bin. Counts are summed. Features with few values, or
    with a value that is not an interval of numbers, keep their rows.
    """
    low = labels.lower_bound(F.col("value"))
    middle = labels.midpoint(F.col("value"))
    ranges = report.groupBy("feature").agg(
        F.count_distinct("value").alias("n_values"),
        F.count_if(middle.isNull()).alias("n_plain"),
        F.min(low).alias("low"),
        F.greatest(F.min(low), F.least(F.max(low), F.lit(float(top)))).alias("high"),
    )
    tagged = report.join(ranges, "feature")

    width = (F.col("high") - F.col("low")) / float(max_values - 1)
    edges = F.array_distinct(
        F.array(
            *[(F.col("low") + width * i).cast("bigint") for i in range(max_values - 1)],
            F.col("high").cast("bigint"),
        )
    )
    tagged = tagged.select("*", edges.alias("edges"))
    position = F.greatest(F.size(F.filter("edges", lambda edge: edge <= middle)), F.lit(1))
    lower = F.get(F.col("edges"), position - 1)
    upper = F.get(F.col("edges"), position)
    merged = F.when(upper.isNull(), F.concat(F.lit(">="), lower.cast("string"))).otherwise(
        F.concat(F.lit("["), lower.cast("string"), F.lit("|"), upper.cast("string"), F.lit(")"))
    )
    crowded = (F.col("n_values") > max_values) & (F.col("n_plain") == 0)
    value = F.when(crowded, merged).otherwise(F.col("value"))
    return (
        tagged.select(
            "feature", value.alias("value"), "cost_distance_label", "cost_time_label", "count"
        )
        .groupBy("feature", "value", "cost_distance_label", "cost_time_label")
        .agg(F.sum("count").alias("count"))
        .filter(F.col("count") != 0)
    )


def rebin_equal_width(report: DataFrame, max_values: int = 15, top: int = 100) -> DataFrame:
    """``merge_value_bins`` with the share of each row within (feature, value), in percent."""
    counted = merge_value_bins(report, max_values, top)
    totals = counted.groupBy("feature", "value").agg(F.sum("count").alias("total"))
    return counted.join(totals, ["feature", "value"]).select(
        "feature",
        "value",
        "cost_distance_label",
        "cost_time_label",
        "count",
        F.bround(F.col("count") / F.col("total") * 100, 5).alias("pcg"),
    )
