"""Bins of a number as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rideframe.spec import BinSpec


def step_start(value: Column, step: int = 5) -> Column:
    """Lower bound of the bin of width ``step`` that holds the value; null for NaN."""
    number = value.cast("double")
    return F.when(~F.isnan(number), F.floor(number / step) * step)


def step_label(start: Column, step: int = 5) -> Column:
    """Label ``[lower|upper)`` of a bin, from its lower bound."""
    return F.concat(
        F.lit("["), start.cast("string"), F.lit("|"), (start + step).cast("string"), F.lit(")")
    )


def bin_step(value: Column, step: int = 5) -> Column:
    return step_label(step_start(value, step), step)


def bin_step_value(value: Column, step: int = 5) -> Column:
    """Bin number that truncates toward zero, so bins next to zero share a number."""
    number = value.cast("double")
    ratio = F.when(~F.isnan(number), F.signum(number) * F.floor(F.abs(number) / step))
    return ratio.cast("int") * step


def bin_thresholds(value: Column, spec: BinSpec) -> Column:
    """Label by thresholds, left-closed. Null and NaN get the last label."""
    label = F.when(value < spec.thresholds[0], spec.labels[0])
    for upper, name in zip(spec.thresholds[1:], spec.labels[1:]):
        label = label.when(value < upper, name)
    return label.otherwise(spec.labels[-1])


def bin_rank(label: Column, labels: Sequence[str]) -> Column:
    """Position of a label in its bin list, from 0; labels do not sort well as text."""
    return F.array_position(F.array(*[F.lit(name) for name in labels]), label) - 1


def bucket_index(value: Column, splits: Sequence[float]) -> Column:
    """Index of the left-closed bucket between ascending splits; the last one is closed.

    Null outside the splits. A single split is one bucket of its own.
    """
    if len(splits) == 1:
        return F.when(value == splits[0], F.lit(0.0))
    last = len(splits) - 2
    index = F.when((value < splits[0]) | (value > splits[-1]) | F.isnan(value), F.lit(None))
    for position in range(1, last + 1):
        index = index.when(value < splits[position], F.lit(float(position - 1)))
    return F.when(value.isNotNull(), index.otherwise(F.lit(float(last))))


def bucket_label(index: Column, splits: Sequence[float]) -> Column:
    """Label ``[a|b)`` of a bucket index, ``Unknown`` for none."""
    edges = list(splits) if len(splits) > 1 else [splits[0], splits[0]]
    labels = [
        F.concat(
            F.lit("["),
            F.lit(float(low)).cast("string"),
            F.lit("|"),
            F.lit(float(high)).cast("string"),
            F.lit(")"),
        )
        for low, high in zip(edges[:-1], edges[1:])
    ]
    return F.coalesce(F.get(F.array(*labels), index.cast("int")), F.lit("Unknown"))
