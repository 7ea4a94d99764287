"""Reading bounds back from bin labels and report keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_integer(label: Column) -> Column:
    return F.regexp_extract(label, r"(-?\d+)", 1).try_cast("bigint")


def lower_bound(label: Column) -> Column:
    """Number after ``[`` in a label ``[a|...``; null if the label has another form."""
    return F.regexp_extract(label, r"\[(-?\d+(?:\.\d+)?)\|", 1).try_cast("double")


def midpoint(label: Column, signed: bool = True) -> Column:
    """Middle of ``[a|b)``; null for other text. Unsigned reads non-negative bounds only."""
    number = r"(-?\d+(?:\.\d+)?)" if signed else r"(\d+(?:\.\d+)?)"
    pattern = rf"^\[{number}\|{number}\)"
    low = F.regexp_extract(label, pattern, 1).try_cast("double")
    high = F.regexp_extract(label, pattern, 2).try_cast("double")
    return (low + high) / 2.0


def sort_key(label: Column) -> Column:
    """Numeric order of interval labels: open-ended ones first (``<``) or last (``>``)."""
    return (
        F.when(label.startswith("<"), F.lit(-1e6))
        .when(label.startswith(">"), F.lit(1e6))
        .otherwise(lower_bound(label))
    )


def descending_key(label: Column) -> Column:
    """Minus the first unsigned number in a label; 0 without one, minus infinity for null."""
    number = F.regexp_extract(F.trim(label), r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    return F.when(label.isNull(), F.lit(float("-inf"))).otherwise(
        F.coalesce(F.lit(0.0) - number, F.lit(0.0))
    )


def coarsen_label(label: Column, step: int = 10, top: int = 100) -> Column:
    """Label of the wider bin that holds the first integer of a label."""
    value = first_integer(label)
    start = F.floor(value / step) * step
    wide = F.concat(
        F.lit("["), start.cast("string"), F.lit("|"), (start + step).cast("string"), F.lit(")")
    )
    return F.when(
        label.isNotNull() & (label != ""),
        F.when(value.isNull(), "unknown").when(value >= top, f">= {top}").otherwise(wide),
    )


def feature_key(feature: str, bin_label: Column) -> Column:
    return F.concat_ws("_", F.lit(feature), bin_label)


def class_key(*columns: Column) -> Column:
    """The values of class columns as one text. Only for display: group by the columns."""
    return F.concat_ws("_", *[c.cast("string") for c in columns])


def split_feature_key(key: Column) -> tuple[Column, Column]:
    """Feature and bin of a key ``feature_bin``, split at the first underscore."""
    parts = F.split(key, "_", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
