"""Average tips per bin, weather class, hour, month and combination of bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideframe.functions.bins import bin_rank
from rideframe.functions.dates import hour_bucket, rush_hour, weekend
from rideframe.functions.money import long_trip, speed_mph, tip_percentage
from rideframe.spec import HOUR_BUCKET_ORDER, IMPACT_KEYS, TIP_BINS, TIP_REPORT_FEATURES


def enrich_trips(df: DataFrame, zero_total: float | None = 0.0, weekend_form: str = "weekday") -> DataFrame:
    """Calendar parts, tip rate, speed and flags of trips that carry ``trip_duration_min``."""
    pickup = F.col("pickup_datetime")
    miles, minutes = F.col("trip_distance"), F.col("trip_duration_min")
    hour = F.hour(pickup)
    return df.select(
        "*",
        hour.alias("hour_of_day"),
        weekend(pickup, weekend_form).alias("is_weekend"),
        hour_bucket(hour).alias("trip_hour_bucket"),
        F.month(pickup).alias("month"),
        F.year(pickup).alias("year"),
        tip_percentage(F.col("tip_amount"), F.col("total_amount"), zero_total).alias(
            "tip_percentage"
        ),
        speed_mph(miles, minutes).alias("speed_mph"),
        rush_hour(hour).alias("is_rush_hour"),
        long_trip(miles, minutes).alias("is_long_trip"),
    )


def tip_cells(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Sum and count of the tip rate per combination of short labels.

    The labels come from fixed lists, so there are some thousand combinations at most, times
    the number of days where the date is a dimension, and every further report is cheap.
    """
    return df.groupBy(*dimensions).agg(
        F.sum("tip_percentage").alias("tip_sum"), F.count("tip_percentage").alias("tip_count")
    )


def merge_tip_cells(cells: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Cells of fewer dimensions from the output of ``tip_cells``."""
    return cells.groupBy(*dimensions).agg(
        F.sum("tip_sum").alias("tip_sum"), F.sum("tip_count").alias("tip_count")
    )


def average_tip(cells: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.try_divide(F.sum("tip_sum"), F.sum("tip_count")).alias("avg_tip_pct")
    )


def tip_by_feature_bin(
    df: DataFrame, features: Mapping[str, str] = TIP_REPORT_FEATURES, cells: bool = False, keys: Sequence[str] = ()
) -> DataFrame:
    """Average tip rate per feature and bin, keyed ``<feature>_<bin>``.

    ``cells`` says that the rows are already the output of ``tip_cells``; here and below,
    ``keys`` ask for a report per combination of them.
    """
    columns = {report: f"{name}_bin" for report, name in features.items()}
    if not cells:
        df = tip_cells(df, [*keys, *columns.values()])
    keyed = df.select(
        *keys,
        *[F.concat_ws("_", F.lit(report), F.col(c)).alias(report) for report, c in columns.items()],
        "tip_sum",
        "tip_count",
    ).unpivot([*keys, "tip_sum", "tip_count"], list(columns), "name", "feature")
    return average_tip(keyed, [*keys, "feature"])


def tip_by_weather(df: DataFrame, cells: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    if not cells:
        df = tip_cells(df, [*keys, "weather"])
    return average_tip(df, [*keys, "weather"])


def tip_by_hour_bucket(df: DataFrame, cells: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    if not cells:
        df = tip_cells(df, [*keys, "trip_hour_bucket"])
    return average_tip(df, [*keys, F.col("trip_hour_bucket").alias("hour_bucket")])


# --- reports of the DataFrame form -------------------------------------------------
#
# All three are averages over trips. ``impact_cells`` keeps, per combination of the keys
# of all three, the sums and counts they need, so that one pass over the trips serves
# them all. Nulls are left out of each average. Money is summed as decimals, so that the
# order of the rows does not matter; nine decimals hold any amount of money as it is, and
# what no decimal can hold is summed apart.

MONEY_SCALE = 9

AVERAGED = {
    "tip_amount": "tip",
    "fare_amount": "fare",
    "trip_duration_min": "duration",
    "tip_percentage": "tip_pct",
    "speed_mph": "speed",
}


MONEY = ("tip_amount", "fare_amount")


def _sums(columns: Sequence[str]) -> list[Column]:
    parts = []
    for c in columns:
        name = AVERAGED[c]
        if c in MONEY:
            decimal = F.col(c).try_cast(f"decimal(38,{MONEY_SCALE})")
            parts += [F.sum(decimal).alias(f"{name}_sum"), F.sum(F.when(decimal.isNull(), F.col(c))).alias(f"{name}_rest")]
        else:
            parts.append(F.sum(c).alias(f"{name}_sum"))
        parts.append(F.count(c).alias(f"{name}_count"))
    return parts


def impact_cells(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums per combination of keys: trips, money, minutes, tip rates and speeds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_trips"), *_sums(list(AVERAGED)))


def _average(name: str) -> Column:
    total = F.sum(f"{name}_sum").cast("double")
    if name in [AVERAGED[c] for c in MONEY]:
        total = F.coalesce(total, F.lit(0.0)) + F.coalesce(F.sum(f"{name}_rest"), F.lit(0.0))
    return F.try_divide(total, F.sum(f"{name}_count"))


def all_combinations_impact(
    df: DataFrame, keys: Sequence[str] = IMPACT_KEYS, cells: bool = False
) -> DataFrame:
    """Average tip, average duration and trips per combination of bins, sorted by the keys."""
    if not cells:
        df = impact_cells(df, keys)
    return (
        df.groupBy(*keys)
        .agg(
            _average("tip").alias("avg_tip"),
            _average("duration").alias("avg_duration"),
            F.sum("n_trips").alias("count_trips"),
        )
        .orderBy(*keys)
    )


def rush_hour_stats(df: DataFrame, cells: bool = False) -> DataFrame:
    """Average duration, tip rate and speed inside and outside the rush hours."""
    if not cells:
        df = impact_cells(df, ["is_rush_hour"])
    return df.groupBy("is_rush_hour").agg(
        _average("duration").alias("avg_duration"),
        _average("tip_pct").alias("avg_tip_pct"),
        _average("speed").alias("avg_speed"),
    )


def monthly_pattern(df: DataFrame, cells: bool = False) -> DataFrame:
    """Average fare, average tip and trips per month, in order."""
    if not cells:
        df = df.groupBy("year", "month").agg(
            F.count(F.lit(1)).alias("n_trips"), *_sums(["fare_amount", "tip_amount"])
        )
    return (
        df.groupBy("year", "month")
        .agg(
            _average("fare").alias("avg_fare"),
            _average("tip").alias("avg_tip"),
            F.sum("n_trips").alias("total_trips"),
        )
        .orderBy("year", "month")
    )


def bin_orders(keys: Sequence[str] = IMPACT_KEYS) -> dict[str, tuple[str, ...]]:
    """Bin labels of each impact key in their order."""
    return {
        key: HOUR_BUCKET_ORDER
        if key == "trip_hour_bucket"
        else TIP_BINS[key.removesuffix("_bin")].labels
        for key in keys
    }


def impact_vs_first_bin(
    impact: DataFrame, orders: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Change of the average tip in percent against the first bin of each feature.

    Each feature is varied while all others are held fixed. The first bin is the lowest
    one that occurs with these other values. The window holds the bins of one feature,
    five rows at most.
    """
    orders = dict(orders or bin_orders())
    keys = list(orders)
    variants = []
    for key in keys:
        others = [F.col(k) for k in keys if k != key]
        variants.append(
            F.struct(
                F.lit(key).alias("feature"),
                F.col(key).alias("bin"),
                bin_rank(F.col(key), orders[key]).alias("bin_rank"),
                F.concat_ws(" / ", *others).alias("others"),
            )
        )
    varied = impact.select(F.explode(F.array(*variants)).alias("v"), "avg_tip", "count_trips")
    window = Window.partitionBy("feature", "others").orderBy("bin_rank")
    first = F.first("avg_tip").over(window)
    return varied.select("v.*", "avg_tip", "count_trips").select(
        "feature",
        "others",
        "bin",
        "bin_rank",
        "avg_tip",
        F.round(F.try_divide((F.col("avg_tip") - first) * 100, first), 4).alias("change_pct"),
        "count_trips",
    )
