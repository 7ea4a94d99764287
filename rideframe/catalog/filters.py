"""Queries for filters, projections and coercions. Each runs over all trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.catalog.registry import on_trips, query
from rideframe.operators import clean
from rideframe.operators.distinct import distinct_by_digest
from rideframe.operators.quantiles import trim_outliers
from rideframe.functions.dates import duration_minutes


@query(
    "coerce_columns",
    """WITH cells AS (
      SELECT l_orderkey, l_linenumber, CAST(l_discount AS FLOAT) AS discount, l_tax, l_shipdate,
        l_linestatus = 'O' AS is_open,
        CASE l_linenumber % 4 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
          WHEN 1 THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.25'
          WHEN 2 THEN ' ' || l_returnflag || '  ' END AS cell
      FROM lineitem)
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, l_linenumber, CAST(discount AS DOUBLE) AS discount,
      l_tax, CAST(l_shipdate AS VARCHAR) AS l_shipdate, is_open, trim(cell) AS cell,
      TRY_CAST(CASE WHEN regexp_full_match(cell, '-?[0-9]+([.][0-9]+)?') THEN cell END AS DOUBLE) AS cell_number
    FROM cells""",
)
def coerce_columns(spark, sf_dir):
    cells = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "cast(l_discount as float) as discount",
        "l_tax",
        "l_shipdate",
        "l_linestatus = 'O' as is_open",
        """case l_linenumber % 4 when 0 then cast(cast(l_quantity as bigint) as string)
           when 1 then concat('-', cast(cast(l_quantity as bigint) as string), '.25')
           when 2 then concat(' ', l_returnflag, '  ') end as cell""",
    )
    return clean.coerce_columns(cells)


@query("drop_incomplete", on_trips("SELECT * FROM trips WHERE passenger_count IS NOT NULL"))
def drop_incomplete(spark, sf_dir):
    return clean.drop_incomplete(fx.trips(spark, sf_dir))


@query(
    "drop_incomplete_nan",
    on_trips(
        """SELECT service_type, pickup_datetime, passenger_count, fare_amount / extra AS fare_per_extra
        FROM trips WHERE passenger_count IS NOT NULL AND NOT (fare_amount >= 500 AND extra = 0)
        AND extra <> 0"""
    ),
)
def drop_incomplete_nan(spark, sf_dir):
    """The ratio is NaN for some trips without extras and null for the others."""
    ratio = F.when(F.col("extra") != 0, F.col("fare_amount") / F.col("extra")).when(
        F.col("fare_amount") >= 500, F.lit(float("nan"))
    )
    trips = fx.trips(spark, sf_dir).select(
        "service_type", "pickup_datetime", "passenger_count", ratio.alias("fare_per_extra")
    )
    return clean.drop_incomplete_nan(trips)


RANGES_SQL = """passenger_count >= 1 AND trip_distance > 0 AND fare_amount > 0
  AND (ratecode_id BETWEEN 1 AND 6 OR ratecode_id = 99) AND store_and_fwd_flag IN ('Y', 'N')
  AND payment_type BETWEEN 1 AND 6"""


@query(
    "filter_feature_ranges",
    on_trips(
        f"SELECT * FROM trips WHERE {RANGES_SQL} AND tolls_amount >= 0 AND tolls_amount < 200"
    ),
)
def filter_feature_ranges(spark, sf_dir):
    return clean.filter_feature_ranges(fx.trips(spark, sf_dir))


@query(
    "filter_feature_ranges_df",
    on_trips(f"SELECT * FROM trips WHERE {RANGES_SQL} AND tolls_amount < 200"),
)
def filter_feature_ranges_df(spark, sf_dir):
    return clean.filter_feature_ranges_df(fx.trips(spark, sf_dir))


@query(
    "filter_fee_ranges",
    on_trips(
        """SELECT * FROM trips WHERE extra >= 0 AND extra < 20 AND mta_tax >= 0 AND mta_tax < 20
        AND improvement_surcharge >= 0 AND improvement_surcharge < 20 AND congestion_surcharge >= 0
        AND congestion_surcharge < 20 AND airport_fee >= 0 AND airport_fee < 20"""
    ),
)
def filter_fee_ranges(spark, sf_dir):
    return clean.filter_fee_ranges(fx.trips(spark, sf_dir))


@query(
    "filter_fee_signs",
    on_trips(
        """SELECT * FROM trips WHERE extra >= 0 AND mta_tax >= 0 AND tolls_amount >= 0
        AND improvement_surcharge >= 0 AND congestion_surcharge >= 0 AND airport_fee >= 0"""
    ),
)
def filter_fee_signs(spark, sf_dir):
    return clean.filter_fee_signs(fx.trips(spark, sf_dir))


@query(
    "filter_year_window",
    on_trips(
        """SELECT * FROM trips WHERE year(pickup_datetime) BETWEEN 1996 AND 1999
        AND year(dropoff_datetime) BETWEEN 1996 AND 1999"""
    ),
)
def filter_year_window(spark, sf_dir):
    return clean.filter_year_window(fx.trips(spark, sf_dir), 1996, 1999)


@query(
    "filter_positive_duration",
    on_trips("SELECT * FROM trips WHERE dropoff_datetime > pickup_datetime"),
)
def filter_positive_duration(spark, sf_dir):
    return clean.filter_positive_duration(fx.trips(spark, sf_dir))


@query(
    "filter_vendor",
    on_trips(
        """SELECT * FROM trips WHERE vendor_id IN (1, 2, 6) OR (vendor_id = 7 AND service_type = 'yellow')"""
    ),
)
def filter_vendor(spark, sf_dir):
    return clean.filter_vendor(fx.trips(spark, sf_dir))


@query(
    "filter_tip_sanity",
    on_trips(
        """SELECT * FROM trips WHERE fare_amount > 0 AND tip_amount >= 0
        AND tip_amount <= 1.5::DOUBLE * fare_amount AND trip_distance > 0"""
    ),
)
def filter_tip_sanity(spark, sf_dir):
    return clean.filter_tip_sanity(fx.trips(spark, sf_dir))


TIP_CLEAN_SQL = """tip_clean AS (
  SELECT *, epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE AS trip_duration_min
  FROM trips
  WHERE fare_amount > 0 AND tip_amount >= 0 AND tip_amount <= 1.5::DOUBLE * fare_amount
    AND trip_distance > 0 AND dropoff_datetime > pickup_datetime
    AND (vendor_id IN (1, 2, 6) OR (vendor_id = 7 AND service_type = 'yellow'))
)"""


def tip_clean(spark, sf_dir):
    """Plausible trips with their duration, without outlier bounds."""
    trips = clean.filter_vendor(clean.filter_tip_sanity(fx.trips(spark, sf_dir)))
    minutes = duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"), "exact")
    return clean.filter_positive_duration(trips).withColumn("trip_duration_min", minutes)


@query(
    "trim_outliers",
    on_trips(
        """SELECT service_type, pickup_datetime, trip_distance, trip_duration_min, fare_amount
        FROM tip_clean WHERE trip_distance BETWEEN
            (SELECT quantile_disc(trip_distance, 0.02) FROM tip_clean)
            AND (SELECT quantile_disc(trip_distance, 0.98) FROM tip_clean)
        AND trip_duration_min BETWEEN
            (SELECT quantile_disc(trip_duration_min, 0.02) FROM tip_clean)
            AND (SELECT quantile_disc(trip_duration_min, 0.98) FROM tip_clean)""",
        TIP_CLEAN_SQL,
    ),
)
def trim_outliers_query(spark, sf_dir):
    return trim_outliers(tip_clean(spark, sf_dir), method="exact").select(
        "service_type", "pickup_datetime", "trip_distance", "trip_duration_min", "fare_amount"
    )


@query(
    "project_columns",
    on_trips("SELECT vendor_id, pickup_datetime, total_amount FROM trips"),
)
def project_columns(spark, sf_dir):
    return clean.project_columns(
        fx.trips(spark, sf_dir),
        keep=["VENDOR_ID", "pickup_datetime", "fare_amount", "Total_Amount"],
        remove=["Fare_Amount"],
    )


DEDUPE_SQL = on_trips(
    """SELECT DISTINCT * FROM (
    SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE payment_type = 3 AND vendor_id = 1)"""
)


def trips_with_copies(spark, sf_dir):
    trips = fx.trips(spark, sf_dir)
    return trips.unionByName(trips.filter("payment_type = 3 and vendor_id = 1"))


@query("dedupe_rows", DEDUPE_SQL)
def dedupe_rows(spark, sf_dir):
    return clean.dedupe(trips_with_copies(spark, sf_dir))


@query("dedupe_rows_by_digest", DEDUPE_SQL)
def dedupe_rows_by_digest(spark, sf_dir):
    return distinct_by_digest(trips_with_copies(spark, sf_dir), "trips")
