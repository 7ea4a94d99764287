"""Queries for sources, sinks and schema adapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.catalog.registry import on_trips, on_weather, per_service, query, union_sql
from rideframe.session import new_shared_path
from rideframe.sources import reports, trips as trip_sources, weather as weather_sources
from rideframe.spec import SERVICES

RAW_COLUMNS = """
  vendor_id AS VendorID, pickup_datetime, dropoff_datetime,
  passenger_count, trip_distance, ratecode_id AS RatecodeID, store_and_fwd_flag, payment_type, fare_amount,
  extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge"""


def without_prefix(df, service):
    prefix = {"yellow": "tpep_", "green": "lpep_"}[service]
    return df.select(*[F.col(c).alias(c.removeprefix(prefix)) for c in df.columns])


def alike(df, service):
    """Times without the prefix of the service; the airport fee, which only yellow trips have, is null in green ones."""
    df = without_prefix(df, service).drop("ehail_fee")
    if "airport_fee" in (c.lower() for c in df.columns):
        return df.withColumnRenamed("Airport_fee", "airport_fee")
    return df.withColumn("airport_fee", F.lit(None).cast("double"))


def airport_fee_sql(service):
    return "airport_fee" if service == "yellow" else "CAST(NULL AS DOUBLE) AS airport_fee"


@query(
    "scan_trips",
    union_sql(
        lambda s: on_trips(
            f"SELECT {RAW_COLUMNS}, {airport_fee_sql(s)} FROM trips WHERE service_type = '{s}'"
        )
    ),
)
def scan_trips(spark, sf_dir):
    def scan(service):
        path = new_shared_path(spark, service)
        fx.raw_trips(spark, sf_dir, service).write.parquet(path)
        return alike(trip_sources.scan_trips(spark, path), service)

    return per_service(scan)


@query(
    "scan_trips_typed",
    union_sql(
        lambda s: on_trips(
            f"""SELECT pickup_datetime, dropoff_datetime, vendor_id AS VendorID, fare_amount, tip_amount,
            payment_type, trip_distance, total_amount FROM trips WHERE service_type = '{s}'"""
        )
    ),
)
def scan_trips_typed(spark, sf_dir):
    """Files lie in sub-folders of different depth."""

    def scan(service):
        path = new_shared_path(spark, f"{service}-typed")
        raw = fx.raw_trips(spark, sf_dir, service)
        raw.filter("payment_type <= 3").write.parquet(f"{path}/first")
        raw.filter("payment_type > 3").write.parquet(f"{path}/second/deeper")
        return without_prefix(trip_sources.scan_trips_typed(spark, path, service), service)

    return per_service(scan)


@query(
    "scan_trips_recursive",
    on_trips(
        """SELECT service_type, vendor_id, pickup_datetime, dropoff_datetime, fare_amount, tip_amount,
        payment_type, trip_distance, total_amount FROM trips"""
    ),
)
def scan_trips_recursive(spark, sf_dir):
    """Both services with the schema found in files that lie in sub-folders of different depth."""

    def scan(service):
        path = new_shared_path(spark, f"{service}-tree")
        raw = fx.raw_trips(spark, sf_dir, service)
        raw.filter("payment_type <= 3").write.parquet(f"{path}/first")
        raw.filter("payment_type > 3").write.parquet(f"{path}/second/deeper")
        return trip_sources.tip_trips(trip_sources.scan_trips(spark, path, recursive=True), service)

    return trip_sources.union_services(*[scan(service) for service in SERVICES])


@query("weather_daily", on_weather("SELECT wmo_code, date FROM weather"))
def weather_daily(spark, sf_dir):
    """Cells are padded with blanks in the file."""
    path = new_shared_path(spark, "weather")
    fx.weather(spark, sf_dir).select(
        F.concat(F.lit(" "), F.col("date").cast("string"), F.lit("  ")).alias("time"),
        F.concat(F.lit("  "), F.col("wmo_code").cast("string"), F.lit(" ")).alias("weather_code"),
    ).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return weather_sources.read_weather(spark, path)


@query("wmo_lookup", on_weather("SELECT wmo_code, description FROM wmo_lookup"))
def wmo_lookup(spark, sf_dir):
    path = new_shared_path(spark, "wmo")
    fx.wmo_lookup(spark, sf_dir).write.csv(path, header=True, sep=";")
    return weather_sources.read_wmo_lookup(spark, path)


@query(
    "normalize_columns",
    union_sql(
        lambda s: on_trips(
            f"""SELECT pickup_datetime, dropoff_datetime,
            passenger_count, trip_distance, ratecode_id AS ratecodeid, store_and_fwd_flag, payment_type,
            fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
            congestion_surcharge, {airport_fee_sql(s)} FROM trips WHERE service_type = '{s}'"""
        )
    ),
)
def normalize_columns(spark, sf_dir):
    return per_service(lambda s: alike(trip_sources.normalize_columns(fx.raw_trips(spark, sf_dir, s)), s))


@query(
    "canonical_trips",
    on_trips("SELECT * REPLACE (CASE WHEN service_type = 'yellow' THEN airport_fee END AS airport_fee) FROM trips"),
)
def canonical_trips(spark, sf_dir):
    """Green trips have no airport fee, so it is null."""
    yellow, green = (trip_sources.canonical_trips(df, s) for s, df in fx.both_services(spark, sf_dir).items())
    return yellow.unionByName(green, allowMissingColumns=True)


@query(
    "union_services",
    on_trips(
        """SELECT service_type, vendor_id, pickup_datetime, dropoff_datetime, fare_amount, tip_amount,
        payment_type, trip_distance, total_amount FROM trips"""
    ),
)
def union_services(spark, sf_dir):
    raw = fx.both_services(spark, sf_dir)
    return trip_sources.union_services(
        *[trip_sources.tip_trips(df, service) for service, df in raw.items()]
    )


@query(
    "write_read_roundtrip",
    on_trips(
        """SELECT service_type, payment_type, count(*) AS trips,
        CAST(sum(CAST(round(fare_amount * 100) AS BIGINT)) AS BIGINT) AS fare_cents
        FROM trips GROUP BY service_type, payment_type"""
    ),
)
def write_read_roundtrip(spark, sf_dir):
    """The second write replaces the first; the services become folders."""
    path = new_shared_path(spark, "roundtrip")
    report = (
        fx.trips(spark, sf_dir)
        .groupBy("service_type", "payment_type")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum(F.round(F.col("fare_amount") * 100).cast("bigint")).alias("fare_cents"),
        )
    )
    schema = [
        ("service_type", "string"),
        ("payment_type", "bigint"),
        ("trips", "bigint"),
        ("fare_cents", "bigint"),
    ]
    report = reports.conform(report, schema)
    reports.write_report(report.filter("payment_type = 1"), path, ["service_type"])
    reports.write_report(report, path, ["service_type"], single_file=True)
    return reports.conform(reports.read_report(spark, path), schema)
