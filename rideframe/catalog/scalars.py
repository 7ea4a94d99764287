"""Queries for scalar functions and bins. Each runs over all rows of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.catalog.filters import TIP_CLEAN_SQL, tip_clean
from rideframe.catalog.registry import on_trips, query, r, step
from rideframe.functions import bins, dates, labels, money, rounding, weather, zones
from rideframe.operators import binning, zone_calendar
from rideframe.session import stage
from rideframe.spec import FEE_COLUMNS, FEE_COLUMNS_WITH_TOLLS, TIP_BINS, ZONES, BinSpec


def pickup():
    return F.col("pickup_datetime")


def dropoff():
    return F.col("dropoff_datetime")


@query(
    "parse_timestamps",
    on_trips(
        """SELECT pickup_datetime, CASE
          WHEN payment_type = 7 THEN NULL
          WHEN payment_type % 2 = 0 THEN date_trunc('minute', pickup_datetime)
          ELSE pickup_datetime END AS parsed FROM trips"""
    ),
)
def parse_timestamps(spark, sf_dir):
    """Seconds are left out of some texts; some are no timestamps."""
    text = (
        F.when(F.col("payment_type") == 7, F.date_format(pickup(), "dd/MM/yyyy"))
        .when(F.col("payment_type") % 2 == 0, F.date_format(pickup(), "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.date_format(pickup(), " yyyy-MM-dd'T'HH:mm:ss "))
    )
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime", dates.parse_timestamp(text).alias("parsed")
    )


@query(
    "trip_duration",
    on_trips(
        f"""SELECT pickup_datetime, dropoff_datetime,
        {r("epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE", 4)} AS minutes_4,
        {r("epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE", 2)} AS minutes_2,
        epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE AS minutes_exact FROM trips"""
    ),
)
def trip_duration(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime",
        "dropoff_datetime",
        dates.duration_minutes(pickup(), dropoff(), "millis").alias("minutes_4"),
        dates.duration_minutes(pickup(), dropoff(), "seconds").alias("minutes_2"),
        dates.duration_minutes(pickup(), dropoff(), "exact").alias("minutes_exact"),
    )


@query(
    "calendar_parts",
    on_trips(
        """SELECT pickup_datetime, CAST(year(pickup_datetime) AS INTEGER) AS year,
        CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(hour(pickup_datetime) AS INTEGER) AS hour
        FROM trips"""
    ),
)
def calendar_parts(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime",
        F.year(pickup()).alias("year"),
        F.month(pickup()).alias("month"),
        F.hour(pickup()).alias("hour"),
    )


@query(
    "weekend_flag",
    on_trips(
        """SELECT pickup_datetime, CAST(isodow(pickup_datetime) >= 6 AS INTEGER) AS is_weekend,
        CAST((day(pickup_datetime) - 1) % 7 + 1 IN (6, 7) AS INTEGER) AS is_weekend_aligned FROM trips"""
    ),
)
def weekend_flag(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime",
        dates.weekend(pickup()).alias("is_weekend"),
        dates.weekend(pickup(), "aligned").alias("is_weekend_aligned"),
    )


# Zone minutes in SQL: one row per trip and day, cut to the zone of that day.
LONG_TRIPS_SQL = """long_trips AS (
  SELECT *, dropoff_datetime + to_days(vendor_id % 4) AS late_dropoff,
    row_number() OVER () AS trip_id FROM trips
), trip_days AS (
  SELECT trip_id, pickup_datetime AS p, late_dropoff AS q,
    unnest(generate_series(date_trunc('day', pickup_datetime)::TIMESTAMP,
                           date_trunc('day', late_dropoff)::TIMESTAMP, INTERVAL 1 DAY)) AS day
  FROM long_trips WHERE late_dropoff >= pickup_datetime
), cut AS (
  SELECT trip_id,
    greatest(epoch(least(q, day + INTERVAL 24 HOUR)) - epoch(greatest(p, day + INTERVAL 20 HOUR)), 0) AS late_s,
    greatest(epoch(least(q, day + INTERVAL 24 HOUR - INTERVAL 1 SECOND))
             - epoch(greatest(p, day + INTERVAL 20 HOUR)), 0) AS late_gap_s,
    greatest(epoch(least(q, day + INTERVAL 6 HOUR)) - epoch(greatest(p, day)), 0) AS early_s,
    greatest(epoch(least(q, day + INTERVAL 20 HOUR)) - epoch(greatest(p, day + INTERVAL 6 HOUR)), 0) AS day_s
  FROM trip_days
), zone_sums AS (
  SELECT trip_id,
    sum(round(CAST(late_s AS DECIMAL(18,0)) / 60, 4) + round(CAST(early_s AS DECIMAL(18,0)) / 60, 4)) AS overnight,
    sum(round(CAST(day_s AS DECIMAL(18,0)) / 60, 4)) AS regular,
    sum(round(CAST(late_gap_s AS DECIMAL(18,0)) / 60, 4) + round(CAST(early_s AS DECIMAL(18,0)) / 60, 4))
      AS overnight_gap,
    sum(floor(late_gap_s / 60) + floor(early_s / 60)) AS overnight_trunc
  FROM cut GROUP BY trip_id
)"""


@query(
    "zone_minutes",
    on_trips(
        f"""SELECT pickup_datetime, late_dropoff,
        coalesce({r("overnight", 4)}, 0) AS overnight, coalesce({r("regular", 4)}, 0) AS regular,
        coalesce({r("overnight_gap", 4)}, 0) AS overnight_gap,
        coalesce(CAST(overnight_trunc AS DOUBLE), 0) AS overnight_trunc
        FROM long_trips LEFT JOIN zone_sums USING (trip_id)""",
        LONG_TRIPS_SQL,
    ),
)
def zone_minutes(spark, sf_dir):
    """Trips are prolonged by up to three days."""
    late = F.col("late_dropoff")
    overnight, regular = ZONES
    return (
        fx.trips(spark, sf_dir)
        .selectExpr(
            "pickup_datetime", "timestampadd(DAY, vendor_id % 4, dropoff_datetime) as late_dropoff"
        )
        .select(
            "pickup_datetime",
            "late_dropoff",
            zones.zone_minutes(pickup(), late, overnight).alias("overnight"),
            zones.zone_minutes(pickup(), late, regular).alias("regular"),
            zones.zone_minutes(pickup(), late, overnight, midnight_gap_s=1).alias("overnight_gap"),
            zones.zone_minutes(pickup(), late, overnight, "minute_trunc", 1).alias("overnight_trunc"),
        )
    )


# A calendar with a zone per nation: an hour and more at times that differ by weekday, on
# five or so days of the week, and the first minutes of weekend days, which may overlap.
CALENDAR = (
    ("n_nationkey % 3 <> d % 3", "(n_nationkey * 53 + d * 17) % 1200", "(n_nationkey * 53 + d * 17) % 1200 + 60 + n_nationkey * 7"),
    ("d >= 5", "0", "30 + n_nationkey"),
)
CALENDAR_SQL = " UNION ALL ".join(
    f"""SELECT n_name AS zone, d AS weekday, {start} AS s, {end} AS e
    FROM nation, unnest(generate_series(0, 6)) AS days(d) WHERE {where}"""
    for where, start, end in CALENDAR
)
BY_PIECE = "PARTITION BY zone, weekday ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND"
CALENDAR_MINUTES_SQL = f"""calendar AS ({CALENDAR_SQL}
), opened AS (
  SELECT *, CASE WHEN s <= max(e) OVER ({BY_PIECE} 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM calendar
), numbered AS (
  SELECT *, sum(opens) OVER ({BY_PIECE} CURRENT ROW) AS piece FROM opened
), pieces AS (
  SELECT zone, weekday, min(s) AS s, max(e) AS e FROM numbered GROUP BY zone, weekday, piece
), numbered_trips AS (
  SELECT service_type, pickup_datetime AS p, dropoff_datetime + to_days(vendor_id % 4 * 4) AS q,
    row_number() OVER () AS trip_id FROM trips
), days_of_trips AS (
  SELECT *, unnest(generate_series(date_trunc('day', p)::TIMESTAMP, date_trunc('day', q)::TIMESTAMP,
    INTERVAL 1 DAY)) AS day FROM numbered_trips WHERE q > p
), trip_zones AS (
  SELECT service_type, trip_id, zone, sum(CAST(round(CAST(greatest(epoch(least(q, day + to_minutes(e)))
      - epoch(greatest(p, day + to_minutes(s))), 0) AS DECIMAL(18,0)) / 60, 4) AS DECIMAL(18,4))) AS minutes
  FROM days_of_trips JOIN pieces ON weekday = isodow(day) - 1 GROUP BY service_type, trip_id, zone
)"""


@query(
    "zone_minutes_calendar",
    on_trips(
        """SELECT service_type, zone, count(*) FILTER (minutes > 0) AS n_trips,
        CAST(sum(minutes) AS DOUBLE) AS minutes FROM trip_zones GROUP BY service_type, zone""",
        CALENDAR_MINUTES_SQL,
    ),
)
def zone_minutes_calendar(spark, sf_dir):
    """Minutes of all trips, prolonged by up to twelve days, in the zones of a calendar table."""
    days = fx.table(spark, sf_dir, "nation").selectExpr("*", "explode(sequence(0, 6)) as d")
    intervals = [
        days.filter(where).selectExpr("n_name as zone", "d as weekday", f"{start} as start_minute", f"{end} as end_minute")
        for where, start, end in CALENDAR
    ]
    marks = stage(zone_calendar.zone_marks(intervals[0].unionByName(intervals[1])), "zone-marks")
    trips = fx.trips(spark, sf_dir).selectExpr(
        "service_type", "pickup_datetime", "timestampadd(DAY, vendor_id % 4 * 4, dropoff_datetime) as dropoff_datetime"
    )
    minutes = F.col("zone_minutes").cast("decimal(18,4)")
    return (
        zone_calendar.calendar_minutes(trips, marks)
        .groupBy("service_type", "zone")
        .agg(F.count_if(minutes > 0).alias("n_trips"), F.sum(minutes).cast("double").alias("minutes"))
    )


@query(
    "zone_share",
    on_trips(
        f"""SELECT pickup_datetime, minutes,
        {r("100 * trip_distance / nullif(minutes, 0)", 4)} AS share_4,
        {r("100 * trip_distance / nullif(minutes, 0)", 2)} AS share_2
        FROM (SELECT *, greatest(epoch(dropoff_datetime - pickup_datetime), 0) / 60.0::DOUBLE AS minutes FROM trips)"""
    ),
)
def zone_share(spark, sf_dir):
    minutes = F.greatest(dates.duration_minutes(pickup(), dropoff(), "exact"), F.lit(0.0))
    part = F.col("trip_distance")
    return (
        fx.trips(spark, sf_dir)
        .withColumn("minutes", minutes)
        .select(
            "pickup_datetime",
            "minutes",
            zones.zone_share(part, F.col("minutes")).alias("share_4"),
            zones.zone_share(part, F.col("minutes"), 2).alias("share_2"),
        )
    )


HOLIDAY_SQL = """isodow({t}) >= 6 OR strftime({t}, '%m-%d') IN ('01-01', '07-04', '12-25')
  OR (month({t}) = 9 AND isodow({t}) = 1 AND day({t}) <= 7)
  OR (month({t}) = 11 AND isodow({t}) = 4 AND day({t}) BETWEEN 22 AND 28)"""


@query(
    "holiday_or_weekend",
    on_trips(
        f"""SELECT pickup_datetime, CAST({HOLIDAY_SQL.format(t="pickup_datetime")} AS INTEGER) AS is_free_day
        FROM trips"""
    ),
)
def holiday_or_weekend(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime", dates.holiday_or_weekend(pickup()).cast("int").alias("is_free_day")
    )


SURCHARGE_SQL = f"CASE WHEN {HOLIDAY_SQL.format(t='pickup_datetime')} THEN 0 ELSE 2.5 END::DOUBLE"


@query(
    "weekday_surcharge",
    on_trips(f"SELECT pickup_datetime, {SURCHARGE_SQL} AS weekday_surcharge FROM trips"),
)
def weekday_surcharge(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime", dates.weekday_surcharge(pickup()).alias("weekday_surcharge")
    )


@query(
    "fee_total",
    on_trips(
        """SELECT pickup_datetime,
        extra + mta_tax + improvement_surcharge + congestion_surcharge + airport_fee AS fees,
        list_sum(list_distinct([extra, mta_tax, improvement_surcharge, congestion_surcharge, airport_fee]))
          AS distinct_fees FROM trips"""
    ),
)
def fee_total(spark, sf_dir):
    fees = [F.col(c) for c in FEE_COLUMNS]
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime",
        money.fee_total(fees).alias("fees"),
        money.fee_total(fees, distinct=True).alias("distinct_fees"),
    )


@query(
    "fee_total_df",
    on_trips(
        f"""SELECT pickup_datetime, {r(f'''extra + mta_tax + tolls_amount + improvement_surcharge
        + congestion_surcharge + airport_fee + {SURCHARGE_SQL}''', 2)} AS fees FROM trips"""
    ),
)
def fee_total_df(spark, sf_dir):
    fees = [F.col(c) for c in FEE_COLUMNS_WITH_TOLLS]
    return (
        fx.trips(spark, sf_dir)
        .withColumn("weekday_surcharge", dates.weekday_surcharge(pickup()))
        .select("pickup_datetime", money.fee_total(fees, decimals=2).alias("fees"))
    )


@query(
    "unit_prices",
    on_trips(
        f"""SELECT fare_amount, trip_distance, minutes,
        floor(fare_amount / trip_distance * 100 + 0.5::DOUBLE) / 100 AS per_mile,
        floor(fare_amount / nullif(minutes, 0) * 100 + 0.5::DOUBLE) / 100 AS per_minute,
        {r("fare_amount / trip_distance", 2)} AS per_mile_decimal,
        {r("fare_amount / nullif(minutes, 0)", 2)} AS per_minute_decimal
        FROM (SELECT *, {r("epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE", 4)} AS minutes FROM trips)"""
    ),
)
def unit_prices(spark, sf_dir):
    fare, miles, minutes = F.col("fare_amount"), F.col("trip_distance"), F.col("minutes")
    return (
        fx.trips(spark, sf_dir)
        .withColumn("minutes", dates.duration_minutes(pickup(), dropoff()))
        .select(
            "fare_amount",
            "trip_distance",
            "minutes",
            money.unit_price(fare, miles).alias("per_mile"),
            money.unit_price(fare, minutes).alias("per_minute"),
            money.unit_price(fare, miles, "decimal").alias("per_mile_decimal"),
            money.unit_price(fare, minutes, "decimal").alias("per_minute_decimal"),
        )
    )


@query(
    "price_deviation",
    on_trips(
        f"""SELECT fare_amount, total_amount, diff,
        {r("diff / nullif(total_amount, 0) * 100", 4)} AS diff_pct,
        {r("100 * (fare_amount - total_amount) / nullif(total_amount, 0)", 2)} AS diff_pct_direct
        FROM (SELECT *, {r("fare_amount - total_amount", 4)} AS diff FROM trips)"""
    ),
)
def price_deviation(spark, sf_dir):
    price, average = F.col("fare_amount"), F.col("total_amount")
    return fx.trips(spark, sf_dir).select(
        "fare_amount",
        "total_amount",
        money.price_deviation(price, average).alias("diff"),
        money.price_deviation_pct(price, average).alias("diff_pct"),
        money.price_deviation_pct(price, average, "direct").alias("diff_pct_direct"),
    )


@query(
    "tip_percentage",
    on_trips(
        """SELECT tip_amount, total_amount,
        CASE WHEN base = 0 THEN 0 ELSE tip_amount / base * 100 END AS tip_pct,
        CASE WHEN base = 0 THEN NULL ELSE tip_amount / base * 100 END AS tip_pct_null
        FROM (SELECT *, CASE WHEN payment_type = 6 THEN 0 ELSE total_amount END AS base FROM trips)"""
    ),
)
def tip_percentage(spark, sf_dir):
    """Totals of one payment type are taken as zero."""
    base = F.when(F.col("payment_type") == 6, F.lit(0.0)).otherwise(F.col("total_amount"))
    return fx.trips(spark, sf_dir).select(
        "tip_amount",
        "total_amount",
        money.tip_percentage(F.col("tip_amount"), base).alias("tip_pct"),
        money.tip_percentage(F.col("tip_amount"), base, None).alias("tip_pct_null"),
    )


@query(
    "trip_speed",
    on_trips(
        """SELECT pickup_datetime, dropoff_datetime, trip_distance,
        CASE WHEN minutes > 0 THEN trip_distance / (minutes / 60.0::DOUBLE) ELSE 0 END AS speed_mph
        FROM (SELECT *, epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE AS minutes FROM trips)"""
    ),
)
def trip_speed(spark, sf_dir):
    minutes = dates.duration_minutes(pickup(), dropoff(), "exact")
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime",
        "dropoff_datetime",
        "trip_distance",
        money.speed_mph(F.col("trip_distance"), minutes).alias("speed_mph"),
    )


@query(
    "rush_hour_flag",
    on_trips(
        """SELECT pickup_datetime, CAST(hour(pickup_datetime) IN (8, 9, 15, 16, 17, 18, 19) AS INTEGER)
        AS is_rush_hour FROM trips"""
    ),
)
def rush_hour_flag(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime", dates.rush_hour(F.hour(pickup())).alias("is_rush_hour")
    )


@query(
    "long_trip_flag",
    on_trips(
        """SELECT trip_distance, pickup_datetime, dropoff_datetime, CAST(trip_distance > 5
        OR epoch(dropoff_datetime - pickup_datetime) > 1200 AS INTEGER) AS is_long_trip FROM trips"""
    ),
)
def long_trip_flag(spark, sf_dir):
    minutes = dates.duration_minutes(pickup(), dropoff(), "exact")
    return fx.trips(spark, sf_dir).select(
        "trip_distance",
        "pickup_datetime",
        "dropoff_datetime",
        money.long_trip(F.col("trip_distance"), minutes).alias("is_long_trip"),
    )


HOUR_BUCKET_SQL = """CASE WHEN hour({t}) < 6 THEN 'late_night' WHEN hour({t}) < 10 THEN 'morning'
  WHEN hour({t}) < 16 THEN 'midday' WHEN hour({t}) < 20 THEN 'evening' ELSE 'night' END"""


@query(
    "hour_bucket",
    on_trips(
        f"SELECT pickup_datetime, {HOUR_BUCKET_SQL.format(t='pickup_datetime')} AS hour_bucket FROM trips"
    ),
)
def hour_bucket(spark, sf_dir):
    return fx.trips(spark, sf_dir).select(
        "pickup_datetime", dates.hour_bucket(F.hour(pickup())).alias("hour_bucket")
    )


WEATHER_CLASS_SQL = """CASE WHEN {c} IN (0, 1) THEN 'clear' WHEN {c} IN (2, 3, 4) THEN 'cloudy'
  WHEN {c} IN (45, 48) THEN 'foggy' WHEN {c} >= 50 AND {c} <= 67 THEN 'rainy'
  WHEN {c} >= 70 AND {c} <= 77 THEN 'snowy' WHEN {c} >= 80 AND {c} <= 99 THEN 'stormy'
  ELSE 'unknown' END"""


@query(
    "weather_class",
    f"""SELECT code, {WEATHER_CLASS_SQL.format(c="code")} AS weather, count(*) AS n
    FROM (SELECT l_partkey % 110 AS code FROM lineitem) GROUP BY code""",
)
def weather_class(spark, sf_dir):
    code = F.col("l_partkey") % 110
    return (
        fx.table(spark, sf_dir, "lineitem")
        .groupBy(code.alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("code", weather.weather_class(F.col("code")).alias("weather"), "n")
    )


@query(
    "round_half_up",
    f"""SELECT x, {r("x", 2)} AS decimal_2, floor(x * 100 + 0.5::DOUBLE) / 100 AS binary_2, {r("y", 4)} AS decimal_4
    FROM (SELECT l_quantity / 200 AS x, l_extendedprice / 7 AS y FROM lineitem)""",
)
def round_half_up(spark, sf_dir):
    """Every second value of x is a tie at two decimals."""
    return (
        fx.table(spark, sf_dir, "lineitem")
        .select((F.col("l_quantity") / 200).alias("x"), (F.col("l_extendedprice") / 7).alias("y"))
        .select(
            "x",
            rounding.half_up(F.col("x"), 2).alias("decimal_2"),
            rounding.half_up_binary(F.col("x"), 2).alias("binary_2"),
            rounding.half_up(F.col("y"), 4).alias("decimal_4"),
        )
    )


# --- bins -------------------------------------------------------------------


@query(
    "bin_step",
    f"""SELECT x, {step("x", 5)} AS label_5, {step("x", 2)} AS label_2
    FROM (SELECT (l_extendedprice - 40000) / 500 AS x FROM lineitem)""",
)
def bin_step(spark, sf_dir):
    x = (F.col("l_extendedprice") - 40000) / 500
    return (
        fx.table(spark, sf_dir, "lineitem")
        .select(x.alias("x"))
        .select(
            "x",
            bins.bin_step(F.col("x")).alias("label_5"),
            bins.bin_step(F.col("x"), 2).alias("label_2"),
        )
    )


@query(
    "bin_step_value",
    """SELECT x, CAST(trunc(x / 5) AS INTEGER) * 5 AS bin
    FROM (SELECT (l_extendedprice - 40000) / 500 AS x FROM lineitem)""",
)
def bin_step_value(spark, sf_dir):
    x = (F.col("l_extendedprice") - 40000) / 500
    return (
        fx.table(spark, sf_dir, "lineitem")
        .select(x.alias("x"))
        .select("x", bins.bin_step_value(F.col("x")).alias("bin"))
    )


def quantile_splits_sql(name: str, source: str, column: str, scale: int) -> str:
    """Common tables ``<name>_splits`` (distinct splits in order) and ``<name>_bins``."""
    return f"""{name}_ranked AS (
  SELECT {column} AS v, row_number() OVER (ORDER BY {column}) AS rn, count(*) OVER () AS cnt FROM {source}
), {name}_splits AS (
  SELECT s, row_number() OVER (ORDER BY s) - 1 AS i FROM (
    SELECT DISTINCT v AS s FROM {name}_ranked
    WHERE rn IN (SELECT greatest(1, CAST(ceil(k * cnt / {scale}::DOUBLE) AS BIGINT))
                 FROM range(0, {scale + 1}) AS steps(k), (SELECT max(cnt) AS cnt FROM {name}_ranked)))
), {name}_bins AS (
  SELECT a.i AS idx, a.s AS low, b.s AS high, b.i = (SELECT max(i) FROM {name}_splits) AS is_last,
    '[' || CAST(a.s AS VARCHAR) || '|' || CAST(b.s AS VARCHAR) || ')' AS label
  FROM {name}_splits a JOIN {name}_splits b ON b.i = a.i + 1
)"""


@query(
    "bin_quantiles",
    on_trips(
        """SELECT fare_amount, CAST(idx AS DOUBLE) AS fare_amount_bin, label AS fare_amount_bin_label
        FROM trips LEFT JOIN fare_bins
        ON fare_amount >= low AND (fare_amount < high OR (is_last AND fare_amount = high))""",
        quantile_splits_sql("fare", "trips", "fare_amount", 20),
    ),
)
def bin_quantiles(spark, sf_dir):
    trips = fx.trips(spark, sf_dir).select("fare_amount")
    splits = binning.quantile_splits(trips, {"fare_amount": 20}, "exact")
    return binning.with_quantile_bin(trips, "fare_amount", splits["fare_amount"])


@query(
    "bin_thresholds",
    on_trips(
        """SELECT passenger_count, CASE WHEN passenger_count < 1 THEN '0-1' WHEN passenger_count < 3 THEN '1-3'
        WHEN passenger_count < 6 THEN '3-6' ELSE '6+' END AS label FROM trips"""
    ),
)
def bin_thresholds(spark, sf_dir):
    """Nulls take the last label."""
    spec = BinSpec((1.0, 3.0, 6.0), ("0-1", "1-3", "3-6", "6+"))
    return fx.trips(spark, sf_dir).select(
        "passenger_count", bins.bin_thresholds(F.col("passenger_count"), spec).alias("label")
    )


def thresholds_sql(column: str, edges: list[int], names: list[str]) -> str:
    cases = " ".join(f"WHEN {column} < {edge} THEN '{name}'" for edge, name in zip(edges, names))
    return f"CASE {cases} ELSE '{names[-1]}' END AS {column}_bin"


ALL_BINS_SQL = ", ".join(
    [
        thresholds_sql("trip_distance", [1, 3, 6], ["0-1", "1-3", "3-6", "6+"]),
        thresholds_sql("trip_duration_min", [5, 15, 30], ["0-5", "5-15", "15-30", "30+"]),
        thresholds_sql("fare_amount", [5, 10, 20, 40], ["0-5", "5-10", "10-20", "20-40", "40+"]),
        thresholds_sql(
            "tip_percentage", [5, 10, 20, 30], ["0-5%", "5-10%", "10-20%", "20-30%", "30%+"]
        ),
        thresholds_sql("speed_mph", [5, 15, 30], ["0-5mph", "5-15mph", "15-30mph", "30mph+"]),
    ]
)
RATES_SQL = """tip_amount / nullif(total_amount, 0) * 100 AS tip_percentage,
  trip_distance / (trip_duration_min / 60.0::DOUBLE) AS speed_mph"""


@query(
    "bin_all_features",
    on_trips(
        f"""SELECT pickup_datetime, trip_distance, trip_duration_min, fare_amount, tip_percentage, speed_mph,
        {ALL_BINS_SQL} FROM (SELECT *, {RATES_SQL} FROM tip_clean)""",
        TIP_CLEAN_SQL,
    ),
)
def bin_all_features(spark, sf_dir):
    miles, minutes = F.col("trip_distance"), F.col("trip_duration_min")
    features = tip_clean(spark, sf_dir).select(
        "pickup_datetime",
        "trip_distance",
        "trip_duration_min",
        "fare_amount",
        money.tip_percentage(F.col("tip_amount"), F.col("total_amount"), None).alias(
            "tip_percentage"
        ),
        money.speed_mph(miles, minutes).alias("speed_mph"),
    )
    return binning.with_threshold_bins(features, TIP_BINS)


# --- labels -----------------------------------------------------------------

LABELS_SQL = f"""(SELECT CASE l_linenumber WHEN 6 THEN l_returnflag WHEN 7 THEN
  CASE WHEN l_returnflag = 'R' THEN '' END ELSE {step("(l_extendedprice - 40000) / 400", 5)} END AS label
  FROM lineitem)"""


def interval_labels(spark, sf_dir):
    """Step labels on both sides of zero, and some cells that are no labels."""
    x = (F.col("l_extendedprice") - 40000) / 400
    label = (
        F.when(F.col("l_linenumber") == 6, F.col("l_returnflag"))
        .when(F.col("l_linenumber") == 7, F.when(F.col("l_returnflag") == "R", F.lit("")))
        .otherwise(bins.bin_step(x))
    )
    return fx.table(spark, sf_dir, "lineitem").select(label.alias("label"))


@query(
    "coarsen_labels",
    f"""SELECT label, CASE WHEN label IS NULL OR label = '' THEN NULL WHEN v IS NULL THEN 'unknown'
      WHEN v >= 100 THEN '>= 100' ELSE {step("v", 10)} END AS coarse, count(*) AS n
    FROM (SELECT label, TRY_CAST(nullif(regexp_extract(label, '-?[0-9]+'), '') AS BIGINT) AS v FROM {LABELS_SQL})
    GROUP BY label, v""",
)
def coarsen_labels(spark, sf_dir):
    return (
        interval_labels(spark, sf_dir)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("label", labels.coarsen_label(F.col("label")).alias("coarse"), "n")
    )


@query(
    "label_bounds",
    f"""SELECT label, TRY_CAST(nullif(regexp_extract(label, '-?[0-9]+'), '') AS BIGINT) AS first_integer, low,
      (low + high) / 2 AS middle, CASE WHEN low >= 0 THEN (low + high) / 2 END AS middle_unsigned, count(*) AS n
    FROM (SELECT label,
      TRY_CAST(nullif(regexp_extract(label, '\\[(-?[0-9]+)\\|', 1), '') AS DOUBLE) AS low,
      TRY_CAST(nullif(regexp_extract(label, '\\|(-?[0-9]+)\\)', 1), '') AS DOUBLE) AS high FROM {LABELS_SQL})
    GROUP BY label, low, high""",
)
def label_bounds(spark, sf_dir):
    label = F.col("label")
    return (
        interval_labels(spark, sf_dir)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "label",
            labels.first_integer(label).alias("first_integer"),
            labels.lower_bound(label).alias("low"),
            labels.midpoint(label).alias("middle"),
            labels.midpoint(label, signed=False).alias("middle_unsigned"),
            "n",
        )
    )


@query(
    "label_sort_key",
    f"""SELECT label, CASE WHEN label LIKE '<%' THEN -1e6 WHEN label LIKE '>%' THEN 1e6 ELSE
        TRY_CAST(nullif(regexp_extract(label, '\\[(-?[0-9]+)\\|', 1), '') AS DOUBLE) END::DOUBLE AS sort_key,
      coalesce(0 - TRY_CAST(nullif(regexp_extract(label, '[0-9]+'), '') AS DOUBLE), 0) AS descending_key, count(*) AS n
    FROM (SELECT CASE WHEN v < -50 THEN '<-50' WHEN v >= 50 THEN '>= 50' ELSE label END AS label FROM (
      SELECT label, TRY_CAST(nullif(regexp_extract(label, '-?[0-9]+'), '') AS BIGINT) AS v FROM {LABELS_SQL}))
    WHERE label IS NOT NULL GROUP BY label""",
)
def label_sort_key(spark, sf_dir):
    value = labels.first_integer(F.col("label"))
    open_ended = F.when(value < -50, "<-50").when(value >= 50, ">= 50").otherwise(F.col("label"))
    return (
        interval_labels(spark, sf_dir)
        .select(open_ended.alias("label"))
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "label",
            labels.sort_key(F.col("label")).alias("sort_key"),
            labels.descending_key(F.col("label")).alias("descending_key"),
            "n",
        )
    )


@query(
    "feature_key_split",
    on_trips(
        """SELECT 'fareAmountBin' AS feature_type, CASE WHEN fare_amount < 5 THEN '0-5' WHEN fare_amount < 10 THEN '5-10'
          WHEN fare_amount < 20 THEN '10-20' WHEN fare_amount < 40 THEN '20-40' ELSE '40+' END AS bin, count(*) AS n
        FROM trips GROUP BY 2 UNION ALL
        SELECT 'hourBin', CASE WHEN hour(pickup_datetime) < 6 THEN 'late_night' ELSE 'other_hours' END, count(*)
        FROM trips GROUP BY 2"""
    ),
)
def feature_key_split(spark, sf_dir):
    """Only the first underscore separates; bins may hold more of them."""
    fare = bins.bin_thresholds(F.col("fare_amount"), TIP_BINS["fare_amount"])
    hours = F.when(F.hour(pickup()) < 6, "late_night").otherwise("other_hours")
    keys = F.array(labels.feature_key("fareAmountBin", fare), labels.feature_key("hourBin", hours))
    counted = (
        fx.trips(spark, sf_dir)
        .groupBy(keys.alias("keys"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode("keys").alias("key"), "n")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    feature, label = labels.split_feature_key(F.col("key"))
    return counted.select(feature.alias("feature_type"), label.alias("bin"), "n")
