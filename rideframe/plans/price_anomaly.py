"""Price anomaly: how far the price of each trip is from the average of its class.

Both forms run on the trips of any services, as read from their files, and return the
profile of price deviations per service and feature value. The plan is one scan of the
trips, one shuffle of their cells, and small steps after that, for all services together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideframe.functions import bins, dates, money, zones
from rideframe.operators import classes, clean
from rideframe.operators.binning import quantile_splits_by_key
from rideframe.operators.profile import feature_profile
from rideframe.session import stage
from rideframe.sources.reports import conform
from rideframe.sources.trips import canonical_trips, normalize_columns, union_services
from rideframe.spec import (
    FEE_COLUMNS,
    FEE_COLUMNS_WITH_TOLLS,
    FEE_QUANTILE_BINS,
    FEE_STEP,
    MIN_YEAR,
    OVERNIGHT_QUANTILE_BINS,
    PRICE_CLASS_COLUMNS,
    PRICE_CLASS_COLUMNS_DF,
    PRICE_STEP,
    PROFILE_SCHEMA,
    ZONES,
)

OVERNIGHT = ZONES[0]

SERVICE = "service_type"
SERVICE_PROFILE_SCHEMA = ((SERVICE, "string"), *PROFILE_SCHEMA)

# Bin labels of the price features and the width of their bins.
STEP_LABELS = {
    "agg_fee_bin_label": FEE_STEP,
    "duration_minutes_bin_label": PRICE_STEP,
    "distance_bin_label": PRICE_STEP,
    "overnight_duration_pcg_label": PRICE_STEP,
}
STEP_LABELS_DF = {
    "duration_minutes_bin_label": PRICE_STEP,
    "trip_distance_bin_label": PRICE_STEP,
}


def _starts(columns: Sequence[str], labels: dict[str, int]) -> list[str]:
    """Names of the columns that hold the lower bounds of labelled bins."""
    return [c.removesuffix("_label") + "_start" if c in labels else c for c in columns]


def _label_starts(df: DataFrame, labels: dict[str, int]) -> DataFrame:
    """Replace lower bounds by labels. Bounds are numbers and cheap to group by, so
    labels are made only once the rows have been counted."""
    starts = {_starts([label], labels)[0]: label for label in labels}
    return df.select(
        *[
            bins.step_label(F.col(c), labels[starts[c]]).alias(starts[c]) if c in starts else F.col(c)
            for c in df.columns
        ]
    )


# Labels of the deviation bins and the width of their bins.
DEVIATION_LABELS = {f"{price}_diff_pcg_label": PRICE_STEP for price in classes.PRICES}
DEVIATION_STARTS = _starts(list(DEVIATION_LABELS), DEVIATION_LABELS)


def _with_deviation_starts(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        *[
            bins.step_start(F.col(f"{price}_diff_pcg"), PRICE_STEP).alias(start)
            for price, start in zip(classes.PRICES, DEVIATION_STARTS)
        ],
    )


SPAN = ("pickup_ms_of_day", "dropoff_ms_of_day", "days_between")


def _with_day_span(trips: DataFrame) -> DataFrame:
    span = zones.day_span(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.select("*", *[c.alias(name) for c, name in zip(span, SPAN)])


def _overnight(unit: str, midnight_gap_s: int) -> Column:
    start, end, days = (F.col(name) for name in SPAN)
    return zones.zone_minutes_of_span(start, end, days, OVERNIGHT, unit, midnight_gap_s)


def clean_price_trips(raw: DataFrame, service: str, first_year: int, last_year: int | None) -> DataFrame:
    """Complete trips with valid codes, amounts, fees and years, in canonical columns."""
    trips = canonical_trips(normalize_columns(raw), service)
    trips = clean.drop_incomplete(trips)
    trips = clean.filter_feature_ranges(trips)
    trips = clean.filter_fee_ranges(trips)
    trips = clean.filter_year_window(trips, first_year, last_year)
    return clean.filter_positive_duration(trips, "minutes")


def with_price_features(
    trips: DataFrame, distinct_fees: bool = False, midnight_gap_s: int = 0
) -> DataFrame:
    """Duration, overnight share, fees, unit prices and the lower bounds of their bins."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    fees = [F.col(c) for c in FEE_COLUMNS if c in trips.columns]
    trips = _with_day_span(trips).select(
        "*",
        dates.duration_minutes(pickup, dropoff).alias("duration_minutes"),
        F.year(pickup).alias("year"),
        _overnight("minute", midnight_gap_s).alias("overnight_duration"),
        dates.weekday_surcharge(pickup).alias("weekday_surcharge"),
        money.fee_total(fees, distinct_fees).alias("fees"),
    )
    trips = trips.drop(*SPAN)
    duration, fare = F.col("duration_minutes"), F.col("fare_amount")
    trips = trips.select(
        "*",
        zones.zone_share(F.col("overnight_duration"), duration).alias("overnight_duration_pcg"),
        money.unit_price(fare, duration).alias("cost_per_time"),
        money.unit_price(fare, F.col("trip_distance")).alias("cost_per_distance"),
    )
    return trips.select(
        "*",
        bins.step_start(F.col("fees"), FEE_STEP).alias("agg_fee_bin_start"),
        bins.step_start(duration, PRICE_STEP).alias("duration_minutes_bin_start"),
        bins.step_start(F.col("trip_distance"), PRICE_STEP).alias("distance_bin_start"),
        bins.step_start(F.col("overnight_duration_pcg"), PRICE_STEP).alias(
            "overnight_duration_pcg_start"
        ),
    )


def label_price_features(trips: DataFrame) -> DataFrame:
    return _label_starts(trips, STEP_LABELS)


CELL_FEATURES = _starts(PRICE_CLASS_COLUMNS, STEP_LABELS)


def price_trips_services(
    raw: Mapping[str, DataFrame],
    first_year: int,
    last_year: int | None,
    distinct_fees: bool = False,
    midnight_gap_s: int = 0,
) -> DataFrame:
    """Clean trips of all services with their class features, unit prices and pickup time."""
    parts = []
    for service, df in raw.items():
        trips = clean_price_trips(df, service, first_year, last_year)
        trips = with_price_features(trips, distinct_fees, midnight_gap_s)
        # Whole-number codes are held as doubles here, so they read "1.0" in the report.
        trips = trips.withColumn("payment_type", F.col("payment_type").cast("double"))
        parts.append(trips.select(SERVICE, "pickup_datetime", *CELL_FEATURES, *classes.PRICES))
    return union_services(*parts)


def class_averages_of_cells(cells: DataFrame, class_columns: Sequence[str] = PRICE_CLASS_COLUMNS) -> DataFrame:
    """Average prices of each class, with the labels of its bins, by service, from counted cells."""
    keys = [SERVICE, *_starts(class_columns, STEP_LABELS)]
    return _label_starts(classes.class_averages(cells, keys, weight="n_trips"), STEP_LABELS)


def price_anomaly_of_cells(cells: DataFrame, class_columns: Sequence[str] = PRICE_CLASS_COLUMNS) -> DataFrame:
    """The report of ``price_anomaly_services`` from trips counted per service, features and prices.

    A cell may come in several rows, such as one of each month; their counts add up.
    """
    keys = [SERVICE, *_starts(class_columns, STEP_LABELS)]
    averages = classes.class_averages(cells, keys, weight="n_trips")
    cells = classes.attach_class_averages(cells, classes.looked_up(averages), keys)
    cells = _with_deviation_starts(classes.with_price_deviation(cells))
    report = feature_profile(
        cells,
        PRICE_CLASS_COLUMNS,
        "cost_per_distance_diff_pcg_label",
        "cost_per_time_diff_pcg_label",
        weight="n_trips",
        keys=[SERVICE],
        numbers=[*CELL_FEATURES, *DEVIATION_STARTS],
        label=lambda counted: _label_starts(counted, STEP_LABELS | DEVIATION_LABELS),
    )
    return conform(report, SERVICE_PROFILE_SCHEMA)


def price_anomaly_services(
    raw: Mapping[str, DataFrame],
    first_year: int = MIN_YEAR,
    last_year: int | None = None,
    class_columns: Sequence[str] = PRICE_CLASS_COLUMNS,
    distinct_fees: bool = False,
    midnight_gap_s: int = 0,
) -> DataFrame:
    """Price deviations with step bins and four decimals, of all years from ``first_year`` on.

    The services, by name, keep their own columns, filters, classes and shares; ``SERVICE``
    is a key of every step after the scans, so all of them take one shuffle and one job.

    ``distinct_fees`` and ``midnight_gap_s=1`` choose the literal forms of two known
    oddities: equal fees count once, and an overnight zone loses the second before
    midnight.
    """
    trips = price_trips_services(raw, first_year, last_year, distinct_fees, midnight_gap_s)
    cells = classes.price_cells(trips.drop("pickup_datetime"), [SERVICE, *CELL_FEATURES])
    return price_anomaly_of_cells(cells, class_columns)


def price_anomaly(
    raw: DataFrame,
    service: str,
    first_year: int = MIN_YEAR,
    last_year: int | None = None,
    class_columns: Sequence[str] = PRICE_CLASS_COLUMNS,
    distinct_fees: bool = False,
    midnight_gap_s: int = 0,
) -> DataFrame:
    """``price_anomaly_services`` of a single service, without its name."""
    report = price_anomaly_services(
        {service: raw}, first_year, last_year, class_columns, distinct_fees, midnight_gap_s
    )
    return report.drop(SERVICE)


def clean_price_trips_df(raw: DataFrame, service: str) -> DataFrame:
    """Complete trips of the DataFrame form: every column but the e-hail fee must be there."""
    trips = canonical_trips(clean.drop_incomplete_nan(raw.drop("ehail_fee")), service)
    trips = clean.filter_feature_ranges_df(trips)
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    # One second is the shortest duration whose minutes, at two decimals, are above zero.
    trips = trips.filter(dates.whole_seconds_between(pickup, dropoff) > 0).select(
        "*",
        dates.duration_minutes(pickup, dropoff, "seconds").alias("duration_minutes"),
        dates.weekday_surcharge(pickup).alias("weekday_surcharge"),
    )
    return clean.filter_fee_signs(trips)


def _with_charges_df(trips: DataFrame) -> DataFrame:
    fees = [F.col(c) for c in FEE_COLUMNS_WITH_TOLLS if c in trips.columns]
    return _with_day_span(trips).select(
        "*",
        F.year("pickup_datetime").alias("year"),
        money.fee_total(fees, decimals=2).alias("aggregate_fee"),
    )


def _with_prices_df(trips: DataFrame, zone_unit: str, midnight_gap_s: int) -> DataFrame:
    duration, fare = F.col("duration_minutes"), F.col("fare_amount")
    minutes = _overnight(zone_unit, midnight_gap_s)
    return trips.select(
        *[F.col(c) for c in trips.columns if c not in SPAN],
        zones.zone_share(minutes, duration, 2).alias("duration_minutes_overnight_pcg"),
        money.unit_price(fare, F.col("trip_distance"), "decimal").alias("cost_per_distance"),
        money.unit_price(fare, duration, "decimal").alias("cost_per_time"),
        bins.step_start(duration, PRICE_STEP).alias("duration_minutes_bin_start"),
        bins.step_start(F.col("trip_distance"), PRICE_STEP).alias("trip_distance_bin_start"),
    )


def with_price_features_df(
    trips: DataFrame, zone_unit: str = "minute", midnight_gap_s: int = 0
) -> DataFrame:
    return _with_prices_df(_with_charges_df(trips), zone_unit, midnight_gap_s)


FEE, OVERNIGHT_SHARE = "aggregate_fee", "duration_minutes_overnight_pcg"


def _cell_names_df(columns: Sequence[str]) -> list[str]:
    return _starts([f"{FEE}_bin" if c == f"{FEE}_bin_label" else c for c in columns], STEP_LABELS_DF)


def _bins_of_service(services: Mapping[str, list[float]], make: Callable[[list[float]], Column]) -> Column:
    """A column made of the splits of the service that a row belongs to."""
    choice = F
    for service, splits in services.items():
        choice = choice.when(F.col(SERVICE) == service, make(splits or [0.0]))
    return choice


def _binned_cells_df(
    raw: Mapping[str, DataFrame], zone_unit: str, midnight_gap_s: int
) -> tuple[DataFrame, dict[str, list[float]]]:
    """Trips counted per service, class and prices, and the splits of the fee bins by service.

    The trips are scanned once and written with the few columns that the rest needs. Quantiles
    are exact, from counts of the written fees and overnight shares, and bins take the place of
    these before the only shuffle of trip-sized data. Unit prices and their classes are
    computed in that second pass: all of it at once is more than one method that gets compiled.
    """
    names = _cell_names_df(PRICE_CLASS_COLUMNS_DF)
    values = {f"{FEE}_bin": FEE, f"{OVERNIGHT_SHARE}_bin": OVERNIGHT_SHARE}
    written = ("passenger_count", "store_and_fwd_flag", "payment_type", FEE, "year")
    measures = (*SPAN, "duration_minutes", "trip_distance", "fare_amount")
    parts = [
        _with_charges_df(clean_price_trips_df(df, service)).select(SERVICE, *written, *measures)
        for service, df in raw.items()
    ]
    trips = _with_prices_df(stage(union_services(*parts), "price-trips"), zone_unit, midnight_gap_s)
    scales = {FEE: FEE_QUANTILE_BINS, OVERNIGHT_SHARE: OVERNIGHT_QUANTILE_BINS}
    splits = quantile_splits_by_key(trips, scales, SERVICE, list(raw))
    binned = trips.withColumns(
        {
            c: _bins_of_service(
                {service: found[value] for service, found in splits.items()},
                lambda edges, value=value: bins.bucket_index(F.col(value), edges),
            )
            for c, value in values.items()
        }
    )
    cells = classes.price_cells(binned, [SERVICE, *names])
    return cells, {service: found[FEE] for service, found in splits.items()}


def _with_labels_df(cells: DataFrame, fee_splits: Mapping[str, list[float]]) -> DataFrame:
    label = _bins_of_service(fee_splits, lambda edges: bins.bucket_label(F.col(f"{FEE}_bin"), edges))
    return _label_starts(cells, STEP_LABELS_DF).withColumn(f"{FEE}_bin_label", label)


def class_averages_df_services(
    raw: Mapping[str, DataFrame], class_columns: Sequence[str] = PRICE_CLASS_COLUMNS_DF
) -> DataFrame:
    """Average prices of each class of the DataFrame form, with the labels of its bins, by service."""
    cells, fee_splits = _binned_cells_df(raw, "minute", 0)
    averages = classes.class_averages(
        cells,
        [SERVICE, *_cell_names_df(class_columns)],
        decimals=2,
        positive_only=False,
        weight="n_trips",
    )
    labelled = _with_labels_df(averages, fee_splits)
    return labelled.select(SERVICE, *class_columns, *[f"avg_{p}" for p in classes.PRICES], "n_class")


def class_averages_df(
    raw: DataFrame, service: str, class_columns: Sequence[str] = PRICE_CLASS_COLUMNS_DF
) -> DataFrame:
    """``class_averages_df_services`` of a single service, without its name."""
    return class_averages_df_services({service: raw}, class_columns).drop(SERVICE)


def price_anomaly_df_services(
    raw: Mapping[str, DataFrame],
    class_columns: Sequence[str] = PRICE_CLASS_COLUMNS_DF,
    zone_unit: str = "minute",
    midnight_gap_s: int = 0,
) -> DataFrame:
    """Price deviations with quantile bins for fees and overnight share, two decimals, by service.

    Quantiles are exact and those of each service. ``zone_unit="minute_trunc"`` with
    ``midnight_gap_s=1`` is the literal form of the overnight minutes.
    """
    cells, fee_splits = _binned_cells_df(raw, zone_unit, midnight_gap_s)
    keys = [SERVICE, *_cell_names_df(class_columns)]
    averages = classes.class_averages(
        cells, keys, decimals=2, positive_only=False, weight="n_trips"
    )
    cells = classes.attach_class_averages(cells, classes.looked_up(averages), keys, how="left")
    cells = _with_deviation_starts(classes.with_price_deviation(cells, "direct"))
    report = feature_profile(
        cells,
        PRICE_CLASS_COLUMNS_DF,
        "cost_per_distance_diff_pcg_label",
        "cost_per_time_diff_pcg_label",
        decimals=2,
        weight="n_trips",
        keys=[SERVICE],
        numbers=[*_cell_names_df(PRICE_CLASS_COLUMNS_DF), *DEVIATION_STARTS],
        label=lambda counted: _label_starts(_with_labels_df(counted, fee_splits), DEVIATION_LABELS),
    )
    return conform(report, SERVICE_PROFILE_SCHEMA)


def price_anomaly_df(
    raw: DataFrame,
    service: str,
    class_columns: Sequence[str] = PRICE_CLASS_COLUMNS_DF,
    zone_unit: str = "minute",
    midnight_gap_s: int = 0,
) -> DataFrame:
    """``price_anomaly_df_services`` of a single service, without its name."""
    return price_anomaly_df_services({service: raw}, class_columns, zone_unit, midnight_gap_s).drop(SERVICE)
