"""Counts per feature value, their shares, and small inspection queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideframe.functions.labels import coarsen_label, sort_key
from rideframe.functions.rounding import half_up

# The columns listed by ``distinct_values`` and ``top_amounts``.
AMOUNT_COLUMNS = (
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)
TOP_COLUMNS = (
    "total_amount",
    "fare_amount",
    "tip_amount",
    "aggregate_fee",
    "duration_minutes_bin_label",
    "trip_distance_bin_label",
)
TOP_ROWS = 500


def feature_profile(
    df: DataFrame,
    features: Sequence[str],
    distance_label: str,
    time_label: str,
    decimals: int = 4,
    weight: str | None = None,
    keys: Sequence[str] = (),
    numbers: Sequence[str] | None = None,
    label: Callable[[DataFrame], DataFrame] = lambda counted: counted,
) -> DataFrame:
    """Rows per feature value and pair of deviation bins, with their share of all rows.

    With ``keys`` there is one profile per combination of them, and shares are of its rows.
    Combinations must be few, such as the names of services: their totals are broadcast.

    Rows are counted per value of each feature and pair of labels, by one grouping set per
    feature. A task holds one count per value and pair, which are far fewer than the
    combinations of all features. Values are written as text on these counts, not on every
    row. ``numbers`` names columns that stand for the features and labels in this count, and
    ``label`` puts those in their place afterwards: numbers are short to group by and to move.
    ``label`` passes ``n_rows`` on as it is; it holds the feature that a count is of, too.
    """
    keys = list(keys)
    count = F.sum(weight) if weight else F.count(F.lit(1))
    *names, distance, time = [*features, distance_label, time_label] if numbers is None else numbers
    labels = [distance] if distance == time else [distance, time]

    def count_values() -> DataFrame:
        feature = F.coalesce(*[F.when(F.grouping(n) == 0, F.lit(f)) for f, n in zip(features, names)])
        grouped = df.groupingSets([[*keys, n, *labels] for n in names], *keys, *names, *labels).agg(
            F.struct(feature.alias("feature"), count.alias("count")).alias("n_rows")
        )
        value = F.coalesce(*[F.when(F.col("n_rows.feature") == f, F.col(f).cast("string")) for f in features])
        return (
            label(grouped)
            .select(
                *keys,
                "n_rows.feature",
                value.alias("value"),
                F.col(distance_label).alias("cost_distance_label"),
                F.col(time_label).alias("cost_time_label"),
                "n_rows.count",
            )
            .groupBy(*keys, "feature", "value", "cost_distance_label", "cost_time_label")
            .agg(F.sum("count").alias("count"))
        )

    # Both sides of the join are written from the start: Spark reuses the shuffles of two such
    # plans, but not of a table that is joined with itself, whose grouping sets it renames.
    # The broadcast side is as short as the list of features, for each of the few
    # combinations of keys.
    counted = count_values()
    totals = count_values().groupBy(*keys, "feature").agg(F.sum("count").alias("total"))
    return counted.join(F.broadcast(totals), [*keys, "feature"]).select(
        *keys,
        "feature",
        "value",
        "count",
        half_up(F.col("count") / F.col("total") * 100, decimals).alias("pcg"),
        "cost_distance_label",
        "cost_time_label",
    )


def distinct_values(df: DataFrame, columns: Sequence[str] = AMOUNT_COLUMNS) -> DataFrame:
    """Distinct values of each column, per column in descending order."""
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .distinct()
        .orderBy("feature", F.desc("value"))
    )


def top_amounts(df: DataFrame, n: int = TOP_ROWS, columns: Sequence[str] = TOP_COLUMNS) -> DataFrame:
    """The trips with the highest totals. Each task keeps its own first ``n`` rows only.

    The other columns break ties, so the rows do not depend on the partitioning.
    """
    first, *rest = columns
    return (
        df.select(*columns).orderBy(F.desc(first), *[F.desc(c) for c in rest]).limit(n)
    )


def share_within_value(
    report: DataFrame, metrics: Sequence[str] = ("distance", "time"), step: int = 10
) -> DataFrame:
    """Share of each coarse deviation bin within (feature, value), in percent.

    All metrics share one pass over the report. The window holds the coarse bins of one
    value and metric, about twenty rows.
    """
    binned = [
        F.struct(
            F.lit(metric).alias("metric"),
            coarsen_label(F.col(f"cost_{metric}_label"), step).alias("bin"),
        )
        for metric in metrics
    ]
    counted = (
        report.select("feature", "value", "count", F.explode(F.array(*binned)).alias("b"))
        .groupBy("feature", "value", "b.metric", "b.bin")
        .agg(F.sum("count").alias("count"))
    )
    total = F.sum("count").over(Window.partitionBy("feature", "value", "metric"))
    return (
        counted.select("*", F.bround(F.col("count") / total * 100, 5).alias("pcg"))
        .filter(F.col("count") != 0)
        .select(
            "feature",
            "value",
            "metric",
            "bin",
            "count",
            "pcg",
            sort_key(F.col("value")).alias("value_order"),
            sort_key(F.col("bin")).alias("bin_order"),
        )
    )
