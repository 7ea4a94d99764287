"""Column names and parameters shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Names of the trip columns, valid codes, bin edges and labels.
# Results depend on these, so they are stated here together and in full.
# ---------------------------------------------------------------------------

SERVICES = ("yellow", "green")

# Names in the published trip files, lower-cased, and the names used here.
CANONICAL_NAMES = {
    "vendorid": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "ratecodeid": "ratecode_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
}

# The columns the price analysis reads; the vendor is not one of them.
PRICE_COLUMNS = tuple(name for name in CANONICAL_NAMES if name != "vendorid")

CANONICAL_TYPES = {
    "vendor_id": "int",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "ratecode_id": "double",
    "store_and_fwd_flag": "string",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# The tip analysis reads these columns of every service.
TIP_COLUMNS = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "fare_amount",
    "tip_amount",
    "payment_type",
    "trip_distance",
    "total_amount",
)

FEE_COLUMNS = (
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

# The wider fee of the DataFrame form: tolls and the weekday surcharge count too.
FEE_COLUMNS_WITH_TOLLS = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "weekday_surcharge",
)

VENDORS = {"yellow": (1, 2, 6, 7), "green": (1, 2, 6)}
RATE_CODES = (1, 6)
RATE_CODE_UNKNOWN = 99
PAYMENT_TYPES = (1, 6)
STORE_FLAGS = ("Y", "N")
MAX_TOLLS = 200
MAX_FEE = 20
MAX_TIP_TO_FARE = 1.5
MIN_YEAR = 2024
WEEKDAY_SURCHARGE = 2.5
RUSH_HOURS = (8, 9, 15, 16, 17, 18, 19)
LONG_TRIP_MILES = 5.0
LONG_TRIP_MINUTES = 20.0

# (first hour, last hour, name); any other hour is "night".
HOUR_BUCKETS = (
    (0, 5, "late_night"),
    (6, 9, "morning"),
    (10, 15, "midday"),
    (16, 19, "evening"),
)

# (first code, last code, name); any other weather code is "unknown".
WEATHER_CLASSES = (
    (0, 1, "clear"),
    (2, 4, "cloudy"),
    (45, 45, "foggy"),
    (48, 48, "foggy"),
    (50, 67, "rainy"),
    (70, 77, "snowy"),
    (80, 99, "stormy"),
)

TRIM_QUANTILES = (0.02, 0.98)
QUANTILE_ERROR = 0.01


@dataclass(frozen=True)
class BinSpec:
    """Ascending thresholds and one label more than thresholds."""

    thresholds: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.thresholds) + 1:
            raise ValueError("a BinSpec needs one more label than thresholds")
        if list(self.thresholds) != sorted(set(self.thresholds)):
            raise ValueError("BinSpec thresholds must ascend strictly")


@dataclass(frozen=True)
class ZoneSpec:
    """A daily zone of hours; a zone whose start is after its end wraps midnight."""

    name: str
    start_hour: int
    end_hour: int

    def __post_init__(self) -> None:
        if not (0 <= self.start_hour <= 23 and 0 <= self.end_hour <= 24):
            raise ValueError("zone hours must lie within a day")


ZONES = (ZoneSpec("overnight", 20, 6), ZoneSpec("regular", 6, 20))

TIP_BINS = {
    "trip_distance": BinSpec((1.0, 3.0, 6.0), ("0-1", "1-3", "3-6", "6+")),
    "trip_duration_min": BinSpec((5.0, 15.0, 30.0), ("0-5", "5-15", "15-30", "30+")),
    "fare_amount": BinSpec((5.0, 10.0, 20.0, 40.0), ("0-5", "5-10", "10-20", "20-40", "40+")),
    "tip_percentage": BinSpec(
        (5.0, 10.0, 20.0, 30.0), ("0-5%", "5-10%", "10-20%", "20-30%", "30%+")
    ),
    "speed_mph": BinSpec((5.0, 15.0, 30.0), ("0-5mph", "5-15mph", "15-30mph", "30mph+")),
}

# Report name of a binned feature in the tip reports -> the feature.
TIP_REPORT_FEATURES = {
    "tripDistanceBin": "trip_distance",
    "tripDurationBin": "trip_duration_min",
    "fareAmountBin": "fare_amount",
    "speedBin": "speed_mph",
}

IMPACT_KEYS = (
    "fare_amount_bin",
    "trip_distance_bin",
    "trip_duration_min_bin",
    "tip_percentage_bin",
    "speed_mph_bin",
    "trip_hour_bucket",
)

HOUR_BUCKET_ORDER = tuple(name for _, _, name in HOUR_BUCKETS) + ("night",)

PRICE_STEP = 5
FEE_STEP = 2
FEE_QUANTILE_BINS = 10
OVERNIGHT_QUANTILE_BINS = 20

PRICE_CLASS_COLUMNS = (
    "passenger_count",
    "store_and_fwd_flag",
    "payment_type",
    "agg_fee_bin_label",
    "duration_minutes_bin_label",
    "distance_bin_label",
    "year",
    "overnight_duration_pcg_label",
)

PRICE_CLASS_COLUMNS_DF = (
    "passenger_count",
    "store_and_fwd_flag",
    "payment_type",
    "aggregate_fee_bin_label",
    "duration_minutes_bin_label",
    "trip_distance_bin_label",
    "year",
    "duration_minutes_overnight_pcg_bin",
)

PROFILE_SCHEMA = (
    ("feature", "string"),
    ("value", "string"),
    ("count", "bigint"),
    ("pcg", "double"),
    ("cost_distance_label", "string"),
    ("cost_time_label", "string"),
)
