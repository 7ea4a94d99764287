"""Differences between the average tips of bins.

The inputs are finished tip reports: one row per bin of a fixed list of features, some
twenty rows at any data size.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.functions.labels import descending_key, split_feature_key
from rideframe.spec import TIP_BINS, TIP_REPORT_FEATURES


def split_feature_keys(report: DataFrame) -> DataFrame:
    """Add the feature and the bin of the key ``<feature>_<bin>``."""
    feature, label = split_feature_key(F.col("feature"))
    return report.select("*", feature.alias("feature_type"), label.alias("bin"))


def _side(tips: DataFrame, side: str) -> DataFrame:
    return tips.select(
        F.col("feature_type").alias(f"feature{side}"),
        F.col("bin").alias(f"bin{side}"),
        F.col("avg_tip_pct").alias(f"tip{side}"),
    )


def pairwise_bin_diff(
    tips: DataFrame, features: Sequence[str] = tuple(TIP_REPORT_FEATURES)
) -> DataFrame:
    """Difference of average tips for the bins of every two features.

    Each row names the features it is compared with, and is joined with these by name.
    """
    partners = F.lit(None).cast("array<string>")
    for feature in features:
        later = [b for a, b in combinations(features, 2) if a == feature]
        if later:
            partners = F.when(
                F.col("featureA") == feature, F.array(*[F.lit(name) for name in later])
            ).otherwise(partners)
    left = _side(tips, "A").select("*", F.explode(partners).alias("featureB"))
    return left.join(_side(tips, "B"), "featureB").select(
        "featureA", "binA", "featureB", "binB", (F.col("tipA") - F.col("tipB")).alias("diff")
    )


def same_feature_diff(tips: DataFrame) -> DataFrame:
    """Difference of average tips for every two bins of one feature."""
    left = _side(tips, "A").withColumn("featureB", F.col("featureA"))
    return left.join(_side(tips, "B"), "featureB").select(
        "featureA", "binA", "featureB", "binB", (F.col("tipA") - F.col("tipB")).alias("diff")
    )


def pivot_bin_diff(
    diffs: DataFrame, feature_a: str, feature_b: str, drop_empty: bool = False
) -> DataFrame:
    """Matrix of differences: one column per bin of A, one row per bin of B, in bin order.

    The columns come from the fixed bin list, so the pivot needs no job to find them.
    ``drop_empty`` removes columns without any value, for which it reads the matrix once.
    """
    labels = list(TIP_BINS[TIP_REPORT_FEATURES[feature_a]].labels)
    matrix = (
        diffs.filter((F.col("featureA") == feature_a) & (F.col("featureB") == feature_b))
        .groupBy("binB")
        .pivot("binA", labels)
        .agg(F.first("diff"))
    )
    matrix = matrix.filter(F.coalesce(*[F.col(f"`{label}`") for label in labels]).isNotNull())
    if drop_empty:
        filled = matrix.agg(*[F.count(F.col(f"`{label}`")).alias(label) for label in labels]).first()
        matrix = matrix.select("binB", *[F.col(f"`{label}`") for label in labels if filled[label]])
    return matrix.orderBy(descending_key(F.col("binB")))
