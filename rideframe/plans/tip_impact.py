"""Tip impact: average tip rates per feature bin, weather, hour, month and combination."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideframe.functions.dates import duration_minutes
from rideframe.operators import clean, impact
from rideframe.operators.binning import with_threshold_bins
from rideframe.operators.distinct import distinct_by_digest
from rideframe.operators.quantiles import trim_outliers
from rideframe.operators.weather import attach_weather, describe_weather, one_row_per_date
from rideframe.session import stage
from rideframe.sources.trips import tip_trips, union_services
from rideframe.spec import IMPACT_KEYS, QUANTILE_ERROR, TIP_BINS, TIP_REPORT_FEATURES

SERVICE = "service_type"
TRIM_COLUMNS = ("trip_distance", "trip_duration_min")


def _with_duration(trips: DataFrame, form: str) -> DataFrame:
    minutes = duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"), form)
    return trips.withColumn("trip_duration_min", minutes)


def plausible_tip_trips(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Complete and plausible trips of all services, copies included."""
    trips = union_services(*[tip_trips(df, service) for service, df in raw.items()])
    trips = clean.drop_incomplete_nan(trips)
    return clean.filter_positive_duration(clean.filter_tip_sanity(clean.filter_vendor(trips)))


def clean_tip_trips_services(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct, complete and plausible trips, told apart by ``SERVICE``.

    The filters stand before ``dedupe``, so that only plausible trips are shuffled. The
    service is a column of the trips, so equal trips of two services both stay.
    """
    return _with_duration(clean.dedupe(plausible_tip_trips(raw)), "exact_millis")


def _staged_distinct(trips: DataFrame, duration: str, distinct: str) -> DataFrame:
    """Distinct trips with their duration, written.

    ``distinct`` says what is shuffled to find copies: whole ``rows``, in one job, or only
    their ``digests``, which pays once the shuffle of the rows is what takes the time.
    """
    if distinct == "rows":
        return stage(_with_duration(clean.dedupe(trips), duration), "tip-trips")
    if distinct == "digests":
        return distinct_by_digest(_with_duration(trips, duration), "tip-trips")
    raise ValueError(f"unknown way to find copies: {distinct!r}")


def clean_tip_trips(raw: DataFrame, service: str) -> DataFrame:
    """``clean_tip_trips_services`` of a single service."""
    return clean_tip_trips_services({service: raw})


def tip_impact_weather_services(
    raw: Mapping[str, DataFrame],
    weather: DataFrame,
    lookup: DataFrame,
    trim_columns: Sequence[str] = TRIM_COLUMNS,
    quantile_method: str = "approx",
    relative_error: float = QUANTILE_ERROR,
    dedupe_weather: bool = True,
    distinct: str = "rows",
) -> dict[str, DataFrame]:
    """Average tip rate per service and feature bin, weather class and hour bucket.

    The cleaned trips of all services are written once, since the quantile bounds and the
    report both need the distinct rows and these cost the one large shuffle of the plan;
    with ``distinct="digests"`` only a hash of each trip is shuffled.
    Each service is trimmed by its own bounds. All three reports share one aggregation of
    the trips, per combination of service, labels and date; the weather is joined with
    these sums, never with trips. ``trim_columns`` with ``payment_type`` in place of the
    distance is the literal form of the outlier bounds.
    """
    trips = _staged_distinct(plausible_tip_trips(raw), "exact_millis", distinct)
    trips = trim_outliers(
        trips, trim_columns, method=quantile_method, relative_error=relative_error, key=SERVICE, values=list(raw)
    )
    trips = with_threshold_bins(impact.enrich_trips(trips))
    daily = describe_weather(weather, lookup)
    if dedupe_weather:
        daily = one_row_per_date(daily)
    labels = [SERVICE, *[f"{name}_bin" for name in TIP_REPORT_FEATURES.values()]]
    trips = trips.withColumn("pickup_date", F.to_date("pickup_datetime"))
    cells = impact.tip_cells(trips, [*labels, "trip_hour_bucket", "pickup_date"])
    cells = impact.merge_tip_cells(attach_weather(cells, daily, "pickup_date"), [*labels, "weather", "trip_hour_bucket"])
    return {
        "all_features": impact.tip_by_feature_bin(cells, cells=True, keys=[SERVICE]),
        "avg_tip_by_weather": impact.tip_by_weather(cells, cells=True, keys=[SERVICE]),
        "avg_tip_by_hour_bucket": impact.tip_by_hour_bucket(cells, cells=True, keys=[SERVICE]),
    }


def tip_impact_weather(
    raw: DataFrame,
    service: str,
    weather: DataFrame,
    lookup: DataFrame,
    trim_columns: Sequence[str] = TRIM_COLUMNS,
    quantile_method: str = "approx",
    relative_error: float = QUANTILE_ERROR,
    dedupe_weather: bool = True,
    distinct: str = "rows",
) -> dict[str, DataFrame]:
    """``tip_impact_weather_services`` of a single service, without its name."""
    reports = tip_impact_weather_services(
        {service: raw}, weather, lookup, trim_columns, quantile_method, relative_error, dedupe_weather, distinct
    )
    return {name: report.drop(SERVICE) for name, report in reports.items()}


def clean_tip_trips_df(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct, complete and plausible trips of all services together."""
    return _with_duration(clean.dedupe(clean.filter_payment_type(plausible_tip_trips(raw))), "exact")


def tip_impact_df(
    raw: Mapping[str, DataFrame],
    quantile_method: str = "approx",
    relative_error: float = QUANTILE_ERROR,
    distinct: str = "rows",
) -> dict[str, DataFrame]:
    """Tips per combination of bins, in and out of rush hours, and per month.

    The three reports share one aggregation of the trips. ``distinct`` is as in
    ``tip_impact_weather_services``.
    """
    trips = _staged_distinct(clean.filter_payment_type(plausible_tip_trips(raw)), "exact", distinct)
    trips = trim_outliers(trips, TRIM_COLUMNS, method=quantile_method, relative_error=relative_error)
    trips = with_threshold_bins(impact.enrich_trips(trips, zero_total=None), TIP_BINS)
    cells = impact.impact_cells(trips, [*IMPACT_KEYS, "is_rush_hour", "year", "month"])
    return {
        "allCombinationsImpact": impact.all_combinations_impact(cells, cells=True),
        "rushHourAnalysis": impact.rush_hour_stats(cells, cells=True),
        "monthlyPattern": impact.monthly_pattern(cells, cells=True),
    }


def long_report(
    reports: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], groups: Sequence[str] = ()
) -> DataFrame:
    """All reports as rows of (report, key, metric, value), whatever their columns.

    ``groups`` are columns of every report that stay columns, in front of these.
    """

    def melt(name: str, df: DataFrame) -> DataFrame:
        report_keys = list(keys[name])
        metrics = [c for c in df.columns if c not in report_keys and c not in groups]
        key: Column = F.concat_ws("|", *[F.col(k).cast("string") for k in report_keys])
        return df.select(
            *groups,
            F.lit(name).alias("report"),
            key.alias("key"),
            *[F.col(m).cast("double").alias(m) for m in metrics],
        ).unpivot([*groups, "report", "key"], metrics, "metric", "value")

    return reduce(DataFrame.unionByName, [melt(name, df) for name, df in reports.items()])


WEATHER_REPORT_KEYS = {
    "all_features": ("feature",),
    "avg_tip_by_weather": ("weather",),
    "avg_tip_by_hour_bucket": ("hour_bucket",),
}
IMPACT_REPORT_KEYS = {
    "allCombinationsImpact": IMPACT_KEYS,
    "rushHourAnalysis": ("is_rush_hour",),
    "monthlyPattern": ("year", "month"),
}
