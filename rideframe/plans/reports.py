"""Report tables shaped from the results of the two analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.functions.labels import descending_key
from rideframe.operators.binning import merge_value_bins
from rideframe.operators.clean import drop_incomplete_nan
from rideframe.operators.compare import pairwise_bin_diff, same_feature_diff, split_feature_keys
from rideframe.operators.profile import share_within_value

# At most 15 value bins, open above 100, deviation bins of width 10.
MAX_VALUES = 15
TOP_VALUE = 100
DEVIATION_STEP = 10


def price_anomaly_report(profile: DataFrame) -> DataFrame:
    """Share of each coarse deviation bin per feature value, by distance and by time."""
    merged = merge_value_bins(drop_incomplete_nan(profile), MAX_VALUES, TOP_VALUE)
    return share_within_value(merged, step=DEVIATION_STEP)


def tip_diff_report(tips: DataFrame, mode: str = "pair") -> DataFrame:
    """Differences of average tips between bins, with the order of the bins in a heatmap."""
    split = split_feature_keys(tips).drop("feature")
    if mode == "pair":
        diffs = pairwise_bin_diff(split)
    elif mode == "same":
        diffs = same_feature_diff(split)
    else:
        raise ValueError(f"unknown mode {mode!r}, use 'pair' or 'same'")
    return diffs.filter(F.col("diff").isNotNull()).select(
        "*",
        (F.lit(0.0) - descending_key(F.col("binA"))).alias("column_order"),
        descending_key(F.col("binB")).alias("row_order"),
    )
