"""Queries for aggregations, quantiles, windows and joins."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.catalog.filters import TIP_CLEAN_SQL, tip_clean
from rideframe.catalog.registry import on_trips, on_weather, per_service, query, r, step, union_sql
from rideframe.catalog.scalars import (
    ALL_BINS_SQL,
    HOLIDAY_SQL,
    HOUR_BUCKET_SQL,
    RATES_SQL,
    WEATHER_CLASS_SQL,
)
from rideframe.functions import bins, dates, labels, money
from rideframe.operators import binning, classes, clean, compare, impact, profile
from rideframe.operators import quantile_sketches as sketch_ops
from rideframe.operators import quantiles as quantile_ops
from rideframe.operators import weather as weather_ops
from rideframe.plans import price_anomaly as price_plan
from rideframe.session import stage
from rideframe.spec import PRICE_CLASS_COLUMNS

# --- price classes ----------------------------------------------------------


def years_sql(first_year: int, last_year: int | None) -> str:
    upto = "" if last_year is None else f" AND {{0}} < '{last_year + 1}-01-01'::TIMESTAMP"
    within = f"{{0}} >= '{first_year}-01-01'::TIMESTAMP{upto}"
    return " AND ".join(within.format(column) for column in ("pickup_datetime", "dropoff_datetime"))


def price_features_sql(service: str, distinct_fees: bool = False, gap: int = 0, years: str = "true") -> str:
    """Common tables up to ``price_rows``: clean trips of a service with all price features, of all years unless a condition is given."""
    fees = ["extra", "mta_tax", "improvement_surcharge", "congestion_surcharge"]
    if service == "yellow":
        fees.append("airport_fee")
    total = (
        f"list_sum(list_distinct([{', '.join(fees)}]))" if distinct_fees else " + ".join(fees)
    )
    in_range = " AND ".join(f"{fee} >= 0 AND {fee} < 20" for fee in fees)
    minutes = r("epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE", 4)

    def cut(day: str, start: str, end: str) -> str:
        low = f"greatest(pickup_datetime, {day} + INTERVAL {start})"
        high = f"least(dropoff_datetime, {day} + INTERVAL {end})"
        return f"round(CAST(greatest(epoch({high}) - epoch({low}), 0) AS DECIMAL(18,0)) / 60, 4)"

    evening_end = f"{86400 - gap} SECOND"
    # No trip is longer than a day and a half, so two days cover it.
    overnight = " + ".join(
        cut(day, *hours)
        for day in ("day0", "(day0 + INTERVAL 1 DAY)")
        for hours in (("20 HOUR", evening_end), ("0 HOUR", "6 HOUR"))
    )
    return f"""price_clean AS (
  SELECT *, {minutes} AS duration_minutes, CAST(year(pickup_datetime) AS INTEGER) AS year,
    date_trunc('day', pickup_datetime)::TIMESTAMP AS day0, {total} AS fees
  FROM trips
  WHERE service_type = '{service}' AND passenger_count >= 1 AND trip_distance > 0
    AND (ratecode_id BETWEEN 1 AND 6 OR ratecode_id = 99) AND payment_type BETWEEN 1 AND 6
    AND fare_amount > 0 AND tolls_amount >= 0 AND tolls_amount < 200 AND {in_range}
    AND {years}
    AND dropoff_datetime > pickup_datetime
), price_zones AS (
  SELECT *, CAST({overnight} AS DOUBLE) AS overnight_duration FROM price_clean
), price_shares AS (
  SELECT *, {r("100 * overnight_duration / duration_minutes", 4)} AS overnight_duration_pcg,
    floor(fare_amount / duration_minutes * 100 + 0.5::DOUBLE) / 100 AS cost_per_time,
    floor(fare_amount / trip_distance * 100 + 0.5::DOUBLE) / 100 AS cost_per_distance
  FROM price_zones
), price_rows AS (
  SELECT * REPLACE (CAST(payment_type AS DOUBLE) AS payment_type),
    {step("fees", 2)} AS agg_fee_bin_label,
    {step("duration_minutes", 5)} AS duration_minutes_bin_label,
    {step("trip_distance", 5)} AS distance_bin_label,
    {step("overnight_duration_pcg", 5)} AS overnight_duration_pcg_label
  FROM price_shares
)"""


def class_averages_sql(keys: str, source: str = "price_rows") -> str:
    """Averages from whole cents, as the sum of doubles depends on the order of the rows."""

    def average(column: str) -> str:
        cents = f"sum(CAST(round({column} * 100) AS BIGINT))::DOUBLE / (count(*) * 100)"
        return r(cents, 4)

    return f"""class_averages AS (
  SELECT * FROM (
    SELECT {keys}, {average("cost_per_distance")} AS avg_cost_per_distance,
      {average("cost_per_time")} AS avg_cost_per_time, count(*) AS n_class
    FROM {source} GROUP BY {keys})
  WHERE avg_cost_per_distance > 0 AND avg_cost_per_time > 0
)"""


def price_rows(spark, sf_dir, service="yellow"):
    raw = fx.raw_trips(spark, sf_dir, service)
    trips = price_plan.clean_price_trips(raw, service, *fx.ALL_YEARS)
    trips = price_plan.label_price_features(price_plan.with_price_features(trips))
    return trips.withColumn("payment_type", F.col("payment_type").cast("double"))


@query(
    "class_averages",
    union_sql(
        lambda s: on_trips(
            "SELECT * FROM class_averages",
            price_features_sql(s),
            class_averages_sql(", ".join(PRICE_CLASS_COLUMNS)),
        )
    ),
)
def class_averages(spark, sf_dir):
    return per_service(
        lambda s: classes.class_averages(price_rows(spark, sf_dir, s), PRICE_CLASS_COLUMNS)
    )


@query(
    "class_keys",
    union_sql(
        lambda s: on_trips(
            f"""SELECT concat_ws('_', {", ".join(f"CAST({c} AS VARCHAR)" for c in PRICE_CLASS_COLUMNS)}) AS class_key,
            count(*) AS n_trips FROM price_rows GROUP BY 1""",
            price_features_sql(s),
        )
    ),
)
def class_keys(spark, sf_dir):
    """The text of each price class and its trips."""

    def build(service):
        rows = price_rows(spark, sf_dir, service)
        key = labels.class_key(*[F.col(c) for c in PRICE_CLASS_COLUMNS])
        return rows.groupBy(key.alias("class_key")).agg(F.count(F.lit(1)).alias("n_trips"))

    return per_service(build)


SMALL_CLASS = ["payment_type", "duration_minutes_bin_label", "distance_bin_label"]
JOINED = [*SMALL_CLASS, "pickup_datetime", "cost_per_distance", "cost_per_time"]


def class_join_sql(join: str) -> str:
    return union_sql(
        lambda s: on_trips(
            f"""SELECT {", ".join(JOINED)}, avg_cost_per_distance, avg_cost_per_time
            FROM price_rows {join} USING ({", ".join(SMALL_CLASS)})""",
            price_features_sql(s),
            class_averages_sql(", ".join(SMALL_CLASS)),
        )
    )


@query("class_avg_join", class_join_sql("JOIN class_averages"))
def class_avg_join(spark, sf_dir):
    """Planned as a shuffle join of both sides."""

    def build(service):
        rows = price_rows(spark, sf_dir, service).select(*JOINED)
        averages = classes.class_averages(rows, SMALL_CLASS).hint("merge")
        return classes.attach_class_averages(rows, averages, SMALL_CLASS, null_safe=False)

    return per_service(build)


@query("class_avg_broadcast_join", class_join_sql("JOIN class_averages"))
def class_avg_broadcast_join(spark, sf_dir):
    """The averages are broadcast where their size allows it."""

    def build(service):
        rows = price_rows(spark, sf_dir, service).select(*JOINED)
        return classes.attach_class_averages(rows, classes.class_averages(rows, SMALL_CLASS), SMALL_CLASS)

    return per_service(build)


@query(
    "class_avg_left_join",
    class_join_sql("LEFT JOIN (SELECT * FROM class_averages WHERE payment_type <> 3)"),
)
def class_avg_left_join(spark, sf_dir):
    """The averages of one payment type are left out, so its trips stay without."""

    def build(service):
        rows = price_rows(spark, sf_dir, service).select(*JOINED)
        averages = classes.class_averages(rows, SMALL_CLASS).filter("payment_type <> 3")
        return classes.attach_class_averages(rows, averages, SMALL_CLASS, how="left")

    return per_service(build)


def profile_sql(
    source: str, features: list[str], distance: str, time: str, decimals: int = 4
) -> str:
    """One grouped count per feature over a table of rows."""
    return " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, count(*) AS count,
        {r(f"count(*) / (SELECT count(*) FROM {source})::DOUBLE * 100", decimals)} AS pcg,
        {distance} AS cost_distance_label, {time} AS cost_time_label
        FROM {source} GROUP BY {f}, {distance}, {time}"""
        for f in features
    )


PROFILED = ["passenger_count", "store_and_fwd_flag", "payment_type", "year", "distance_bin_label"]


@query(
    "feature_profile",
    union_sql(
        lambda s: on_trips(
            profile_sql("labelled", PROFILED, "d_label", "t_label"),
            price_features_sql(s),
            f"labelled AS (SELECT *, {step('cost_per_distance', 5)} AS d_label, {step('cost_per_time', 5)} AS t_label FROM price_rows)",
        )
    ),
)
def feature_profile(spark, sf_dir):
    def build(service):
        rows = price_rows(spark, sf_dir, service).select(
            *PROFILED,
            bins.bin_step(F.col("cost_per_distance")).alias("d_label"),
            bins.bin_step(F.col("cost_per_time")).alias("t_label"),
        )
        return profile.feature_profile(rows, PROFILED, "d_label", "t_label")

    return per_service(build)


@query(
    "distinct_values",
    on_trips(
        " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS feature, {c} AS value FROM trips"
            for c in profile.AMOUNT_COLUMNS
        )
    ),
)
def distinct_values(spark, sf_dir):
    return profile.distinct_values(fx.trips(spark, sf_dir))


@query(
    "top_amounts",
    on_trips(
        f"""SELECT total_amount, fare_amount, tip_amount, aggregate_fee,
        {step("minutes", 5)} AS duration_minutes_bin_label, {step("trip_distance", 5)} AS trip_distance_bin_label
        FROM (SELECT *, {r(f'''extra + mta_tax + tolls_amount + improvement_surcharge + congestion_surcharge
          + airport_fee + CASE WHEN {HOLIDAY_SQL.format(t='pickup_datetime')} THEN 0 ELSE 2.5 END::DOUBLE''', 2)} AS aggregate_fee,
          {r("epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE", 2)} AS minutes FROM trips)
        ORDER BY 1 DESC, 2 DESC, 3 DESC, 4 DESC, 5 DESC, 6 DESC LIMIT 500"""
    ),
)
def top_amounts(spark, sf_dir):
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    trips = fx.trips(spark, sf_dir).withColumn(
        "weekday_surcharge", dates.weekday_surcharge(pickup)
    )
    fees = [F.col(c) for c in price_plan.FEE_COLUMNS_WITH_TOLLS]
    trips = trips.select(
        "*",
        money.fee_total(fees, decimals=2).alias("aggregate_fee"),
        bins.bin_step(dates.duration_minutes(pickup, dropoff, "seconds")).alias(
            "duration_minutes_bin_label"
        ),
        bins.bin_step(F.col("trip_distance")).alias("trip_distance_bin_label"),
    )
    return profile.top_amounts(trips)


# --- quantiles --------------------------------------------------------------

QUANTILES = (0.02, 0.25, 0.5, 0.75, 0.98)
QUANTILE_COLUMNS = ("trip_distance", "fare_amount", "trip_duration_min")
RANKED_SQL = ", ".join(
    f"""{c}_ranked AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n
    FROM tip_clean)"""
    for c in QUANTILE_COLUMNS
)


def approx_rank_sql(column: str, q: float) -> str:
    """Bounds of the ranks that an approximate quantile may have, and its values at them."""
    low, high = f"greatest(1, CAST(floor(({q} - 0.01) * n) AS BIGINT))", f"least(n, CAST(ceil(({q} + 0.01) * n) AS BIGINT))"
    return f"""SELECT '{column}' AS feature, {q}::DOUBLE AS q, max(n) AS n,
      min(v) FILTER (rn = {low}) AS lowest, max(v) FILTER (rn = {high}) AS highest, true AS within
    FROM {column}_ranked"""


@query(
    "approx_quantiles",
    on_trips(
        " UNION ALL ".join(approx_rank_sql(c, q) for c in QUANTILE_COLUMNS for q in QUANTILES),
        TIP_CLEAN_SQL,
        RANKED_SQL,
    ),
)
def approx_quantiles(spark, sf_dir):
    """The exact values one percent of ranks below and above each approximate quantile.

    The approximate value itself depends on the engine; it must lie within these.
    """
    trips = tip_clean(spark, sf_dir)
    found = quantile_ops.approx_quantiles(trips, QUANTILE_COLUMNS, QUANTILES)
    n = {c: trips.agg(F.count(c)).first()[0] for c in QUANTILE_COLUMNS}
    error = quantile_ops.QUANTILE_ERROR

    def ranks(column, q):
        return max(1, math.floor((q - error) * n[column])), min(n[column], math.ceil((q + error) * n[column]))

    # A probability that stands for a rank exactly, so the exact quantiles are those values.
    wanted = {c: [(r - 0.5) / n[c] for q in QUANTILES for r in ranks(c, q)] for c in QUANTILE_COLUMNS}
    exact = quantile_ops.exact_quantiles(trips, wanted)
    rows = []
    for c in QUANTILE_COLUMNS:
        ends = exact[c]
        for i, q in enumerate(QUANTILES):
            low, high = ends[2 * i], ends[2 * i + 1]
            rows.append((c, q, n[c], low, high, low <= found[c][i] <= high))
    return spark.createDataFrame(rows, "feature string, q double, n bigint, lowest double, highest double, within boolean")


SERVICE_RANKED_SQL = ", ".join(
    f"""{c}_ranked AS (SELECT service_type, {c} AS v, row_number() OVER (PARTITION BY service_type ORDER BY {c}) AS rn,
    count(*) OVER (PARTITION BY service_type) AS n FROM tip_clean)"""
    for c in QUANTILE_COLUMNS
)


def sketch_rank_sql(column: str, q: float) -> str:
    low = f"greatest(1, CAST(floor(({q}::DOUBLE - 0.01::DOUBLE) * n) AS BIGINT))"
    high = f"least(n, CAST(ceil(({q}::DOUBLE + 0.01::DOUBLE) * n) AS BIGINT))"
    return f"""SELECT service_type, '{column}' AS feature, {q}::DOUBLE AS q, max(n) AS n,
      min(v) FILTER (rn = {low}) AS lowest, max(v) FILTER (rn = {high}) AS highest, true AS within
    FROM {column}_ranked GROUP BY service_type"""


@query(
    "sketch_quantiles",
    on_trips(
        " UNION ALL ".join(sketch_rank_sql(c, q) for c in QUANTILE_COLUMNS for q in QUANTILES),
        TIP_CLEAN_SQL,
        SERVICE_RANKED_SQL,
    ),
)
def sketch_quantiles(spark, sf_dir):
    """Quantiles of each service from stored sketches of its months, and the exact values around them.

    As in ``approx_quantiles``, each must lie between the exact values one percent of ranks
    below and above.
    """
    trips = tip_clean(spark, sf_dir)
    months = trips.withColumn("month", F.trunc("pickup_datetime", "month"))
    stored = stage(
        sketch_ops.quantile_sketches(months, QUANTILE_COLUMNS, ["service_type", "month"]), "month-sketches"
    )
    merged = sketch_ops.merge_sketches(stored, QUANTILE_COLUMNS, ["service_type"])
    counts = [F.kll_sketch_get_n_double(c).alias(f"{c}_n") for c in QUANTILE_COLUMNS]
    found = sketch_ops.sketch_quantiles(merged.select("*", *counts), QUANTILE_COLUMNS, QUANTILES).collect()

    error = sketch_ops.QUANTILE_ERROR
    wanted, columns = {}, []
    for row in found:  # one row per service
        for c in QUANTILE_COLUMNS:
            n, name = row[f"{c}_n"], f"{row.service_type}:{c}"
            ranks = [
                r
                for q in QUANTILES
                for r in (max(1, math.floor((q - error) * n)), min(n, math.ceil((q + error) * n)))
            ]
            # A probability that stands for a rank exactly, so the exact quantiles are those values.
            wanted[name] = [(r - 0.5) / n for r in ranks]
            columns.append(F.when(F.col("service_type") == row.service_type, F.col(c)).alias(name))
    exact = quantile_ops.exact_quantiles(trips.select(*columns), wanted)
    rows = []
    for row in found:
        for c in QUANTILE_COLUMNS:
            ends = exact[f"{row.service_type}:{c}"]
            for i, q in enumerate(QUANTILES):
                low, high = ends[2 * i], ends[2 * i + 1]
                rows.append((row.service_type, c, q, row[f"{c}_n"], low, high, low <= row[c][i] <= high))
    return spark.createDataFrame(
        rows, "service_type string, feature string, q double, n bigint, lowest double, highest double, within boolean"
    )


@query(
    "exact_quantile",
    on_trips(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, 'disc' AS rule, {q}::DOUBLE AS q,
              (SELECT v FROM {c}_ranked WHERE rn = greatest(1, CAST(ceil({q} * n) AS BIGINT))) AS value
            UNION ALL SELECT '{c}', 'floor', {q}::DOUBLE,
              (SELECT v FROM {c}_ranked WHERE rn = CASE WHEN floor({q} * n) < n THEN CAST(floor({q} * n) AS BIGINT) + 1 ELSE 1 END)"""
            for c in QUANTILE_COLUMNS
            for q in (*QUANTILES, 1.0)
        ),
        TIP_CLEAN_SQL,
        RANKED_SQL,
    ),
)
def exact_quantile(spark, sf_dir):
    trips = tip_clean(spark, sf_dir)
    points = (*QUANTILES, 1.0)
    rows = []
    for rule in ("disc", "floor"):
        found = quantile_ops.exact_quantiles(trips, {c: points for c in QUANTILE_COLUMNS}, rule)
        rows += [(c, rule, q, value) for c in QUANTILE_COLUMNS for q, value in zip(points, found[c])]
    return spark.createDataFrame(rows, "feature string, rule string, q double, value double")


# --- tips -------------------------------------------------------------------

TIP_BINNED_SQL = f"""tip_binned AS (
  SELECT *, {ALL_BINS_SQL}, {HOUR_BUCKET_SQL.format(t="pickup_datetime")} AS trip_hour_bucket,
    CAST(hour(pickup_datetime) IN (8, 9, 15, 16, 17, 18, 19) AS INTEGER) AS is_rush_hour,
    CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month
  FROM (SELECT *, {RATES_SQL} FROM tip_clean)
)"""

REPORT_FEATURES_SQL = {
    "tripDistanceBin": "trip_distance_bin",
    "tripDurationBin": "trip_duration_min_bin",
    "fareAmountBin": "fare_amount_bin",
    "speedBin": "speed_mph_bin",
}


def tip_by_feature_sql(source: str = "tip_binned") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}_' || {column} AS feature, avg(tip_percentage) AS avg_tip_pct FROM {source} GROUP BY {column}"
        for name, column in REPORT_FEATURES_SQL.items()
    )


def tip_binned(spark, sf_dir):
    return binning.with_threshold_bins(impact.enrich_trips(tip_clean(spark, sf_dir)))


def rounded(df, *columns, decimals=6):
    """Averages of doubles depend on the order of the rows in their last digits."""
    return df.select(
        *[F.round(c, decimals).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    )


@query(
    "tip_by_feature_bin",
    on_trips(
        f"SELECT feature, {r('avg_tip_pct', 6)} AS avg_tip_pct FROM ({tip_by_feature_sql()})",
        TIP_CLEAN_SQL,
        TIP_BINNED_SQL,
    ),
)
def tip_by_feature_bin(spark, sf_dir):
    return rounded(impact.tip_by_feature_bin(tip_binned(spark, sf_dir)), "avg_tip_pct")


WEATHER_DAILY_SQL = """described AS (
  SELECT date, wmo_code, description FROM weather JOIN wmo_lookup USING (wmo_code)
), one_per_date AS (
  SELECT date, min(wmo_code) AS wmo_code, arg_min(description, wmo_code) AS description
  FROM described GROUP BY date
)"""


@query(
    "tip_by_weather",
    on_weather(
        f"""SELECT weather, {r("avg(tip_percentage)", 6)} AS avg_tip_pct FROM (
          SELECT *, {WEATHER_CLASS_SQL.format(c="wmo_code")} AS weather
          FROM tip_binned JOIN one_per_date ON CAST(pickup_datetime AS DATE) = date)
        GROUP BY weather""",
        TIP_CLEAN_SQL,
        TIP_BINNED_SQL,
        WEATHER_DAILY_SQL,
    ),
)
def tip_by_weather(spark, sf_dir):
    daily = weather_ops.describe_weather(fx.weather(spark, sf_dir), fx.wmo_lookup(spark, sf_dir))
    trips = tip_binned(spark, sf_dir).withColumn("pickup_date", F.to_date("pickup_datetime"))
    cells = impact.tip_cells(trips, ["pickup_date"])
    cells = weather_ops.attach_weather(cells, weather_ops.one_row_per_date(daily), "pickup_date")
    return rounded(impact.tip_by_weather(cells, cells=True), "avg_tip_pct")


@query(
    "tip_by_hour_bucket",
    on_trips(
        f"""SELECT trip_hour_bucket AS hour_bucket, {r("avg(tip_percentage)", 6)} AS avg_tip_pct
        FROM tip_binned GROUP BY 1""",
        TIP_CLEAN_SQL,
        TIP_BINNED_SQL,
    ),
)
def tip_by_hour_bucket(spark, sf_dir):
    return rounded(impact.tip_by_hour_bucket(tip_binned(spark, sf_dir)), "avg_tip_pct")


KEYS_SQL = ", ".join(impact.IMPACT_KEYS)


#: Averages of amounts with few decimals often lie halfway between two results, where the
#: order of the summed doubles decides; both sides add this before they round.
NUDGE = 1e-9


def nudged(df, *columns):
    return rounded(df.withColumns({c: F.col(c) + NUDGE for c in columns}), *columns)


def nudged_sql(*columns: str) -> str:
    return ", ".join(f"{r(f'{c} + {NUDGE}', 6)} AS {c}" for c in columns)


IMPACT_SQL = f"""impact AS (
  SELECT {KEYS_SQL}, {nudged_sql("avg_tip", "avg_duration")}, count_trips
  FROM (SELECT {KEYS_SQL}, avg(tip_amount) AS avg_tip, avg(trip_duration_min) AS avg_duration,
          count(*) AS count_trips
        FROM tip_binned GROUP BY {KEYS_SQL})
)"""


@query(
    "all_combinations_impact",
    on_trips("SELECT * FROM impact", TIP_CLEAN_SQL, TIP_BINNED_SQL, IMPACT_SQL),
)
def all_combinations_impact(spark, sf_dir):
    report = impact.all_combinations_impact(tip_binned(spark, sf_dir))
    return nudged(report, "avg_tip", "avg_duration")


RUSH_SQL = f"""SELECT is_rush_hour, avg(trip_duration_min) AS avg_duration,
  avg(tip_percentage) AS avg_tip_pct, avg(speed_mph) AS avg_speed
  FROM tip_binned GROUP BY is_rush_hour"""
MONTHLY_SQL = f"""SELECT year, month, avg(fare_amount) AS avg_fare,
  avg(tip_amount) AS avg_tip, count(*) AS total_trips
  FROM tip_binned GROUP BY year, month"""


RUSH_AVERAGES = ("avg_duration", "avg_tip_pct", "avg_speed")
MONTHLY_AVERAGES = ("avg_fare", "avg_tip")


@query(
    "rush_hour_stats",
    on_trips(
        f"SELECT is_rush_hour, {nudged_sql(*RUSH_AVERAGES)} FROM ({RUSH_SQL})",
        TIP_CLEAN_SQL,
        TIP_BINNED_SQL,
    ),
)
def rush_hour_stats(spark, sf_dir):
    report = impact.rush_hour_stats(tip_binned(spark, sf_dir))
    return nudged(report, *RUSH_AVERAGES)


@query(
    "monthly_pattern",
    on_trips(
        f"SELECT year, month, {nudged_sql(*MONTHLY_AVERAGES)}, total_trips FROM ({MONTHLY_SQL})",
        TIP_CLEAN_SQL,
        TIP_BINNED_SQL,
    ),
)
def monthly_pattern(spark, sf_dir):
    return nudged(impact.monthly_pattern(tip_binned(spark, sf_dir)), *MONTHLY_AVERAGES)


def vs_first_sql() -> str:
    parts = []
    for key, order in impact.bin_orders().items():
        others = " || ' / ' || ".join(k for k in impact.IMPACT_KEYS if k != key)
        ranks = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(order))
        parts.append(
            f"""SELECT '{key}' AS feature, {others} AS others, {key} AS bin,
            CAST(CASE {key} {ranks} END AS BIGINT) AS bin_rank, avg_tip, count_trips FROM impact"""
        )
    return " UNION ALL ".join(parts)


@query(
    "impact_vs_first_bin",
    on_trips(
        f"""SELECT feature, others, bin, bin_rank, avg_tip,
          {r("(avg_tip - first_tip) * 100 / nullif(first_tip, 0)", 4)} AS change_pct, count_trips
        FROM (SELECT *, first_value(avg_tip) OVER (PARTITION BY feature, others ORDER BY bin_rank) AS first_tip
              FROM ({vs_first_sql()}))""",
        TIP_CLEAN_SQL,
        TIP_BINNED_SQL,
        IMPACT_SQL,
    ),
)
def impact_vs_first_bin(spark, sf_dir):
    report = nudged(impact.all_combinations_impact(tip_binned(spark, sf_dir)), "avg_tip", "avg_duration")
    return impact.impact_vs_first_bin(report)


# --- weather joins ----------------------------------------------------------


@query(
    "weather_lookup_join",
    on_weather("SELECT date, wmo_code, description FROM described", WEATHER_DAILY_SQL),
)
def weather_lookup_join(spark, sf_dir):
    return weather_ops.describe_weather(fx.weather(spark, sf_dir), fx.wmo_lookup(spark, sf_dir))


def weather_join_sql(source: str) -> str:
    return on_weather(
        f"""SELECT service_type, pickup_datetime, total_amount, wmo_code, description,
        {WEATHER_CLASS_SQL.format(c="wmo_code")} AS weather
        FROM trips JOIN {source} ON CAST(pickup_datetime AS DATE) = date""",
        WEATHER_DAILY_SQL,
    )


def joined_weather(spark, sf_dir, dedupe):
    daily = weather_ops.describe_weather(fx.weather(spark, sf_dir), fx.wmo_lookup(spark, sf_dir))
    trips = fx.trips(spark, sf_dir).select("service_type", "pickup_datetime", "total_amount")
    return weather_ops.join_weather(trips, daily, dedupe=dedupe)


@query("weather_join", weather_join_sql("described"))
def weather_join(spark, sf_dir):
    """Dates with two weather rows repeat their trips."""
    return joined_weather(spark, sf_dir, dedupe=False)


@query("weather_broadcast_join", weather_join_sql("one_per_date"))
def weather_broadcast_join(spark, sf_dir):
    return joined_weather(spark, sf_dir, dedupe=True)


# --- differences between bins ----------------------------------------------

TIPS_SPLIT_SQL = f"""tips_split AS (
  SELECT split_part(feature, '_', 1) AS feature_type, substr(feature, strpos(feature, '_') + 1) AS bin,
    avg_tip_pct FROM ({tip_by_feature_sql()})
), feature_order AS (
  SELECT unnest({list(REPORT_FEATURES_SQL)!r}) AS feature_type, unnest(range(4)) AS pos
)"""
PAIRS_SQL = """pairs AS (
  SELECT a.feature_type AS "featureA", a.bin AS "binA", b.feature_type AS "featureB", b.bin AS "binB",
    a.avg_tip_pct - b.avg_tip_pct AS diff
  FROM tips_split a JOIN feature_order oa ON oa.feature_type = a.feature_type
  JOIN feature_order ob ON ob.pos > oa.pos JOIN tips_split b ON b.feature_type = ob.feature_type
)"""
SAME_SQL = """same AS (
  SELECT a.feature_type AS "featureA", a.bin AS "binA", b.feature_type AS "featureB", b.bin AS "binB",
    a.avg_tip_pct - b.avg_tip_pct AS diff
  FROM tips_split a JOIN tips_split b USING (feature_type)
)"""
TIP_CTES = (TIP_CLEAN_SQL, TIP_BINNED_SQL, TIPS_SPLIT_SQL)


def tips_split(spark, sf_dir):
    return compare.split_feature_keys(impact.tip_by_feature_bin(tip_binned(spark, sf_dir))).drop(
        "feature"
    )


def diff_sql(source: str) -> str:
    return f'SELECT "featureA", "binA", "featureB", "binB", {r("diff", 6)} AS diff FROM {source}'


@query("pairwise_bin_diff", on_trips(diff_sql("pairs"), *TIP_CTES, PAIRS_SQL))
def pairwise_bin_diff(spark, sf_dir):
    return rounded(compare.pairwise_bin_diff(tips_split(spark, sf_dir)), "diff")


@query("same_feature_diff", on_trips(diff_sql("same"), *TIP_CTES, SAME_SQL))
def same_feature_diff(spark, sf_dir):
    return rounded(compare.same_feature_diff(tips_split(spark, sf_dir)), "diff")


DISTANCE_LABELS = ("0-1", "1-3", "3-6", "6+")


@query(
    "pivot_bin_diff",
    on_trips(
        'SELECT "binB", '
        + ", ".join(
            f"""{r(f"max(CASE WHEN binA = '{b}' THEN diff END)", 6)} AS "{b}" """
            for b in DISTANCE_LABELS
        )
        + """FROM pairs WHERE "featureA" = 'tripDistanceBin' AND "featureB" = 'fareAmountBin' GROUP BY "binB" """,
        *TIP_CTES,
        PAIRS_SQL,
    ),
)
def pivot_bin_diff(spark, sf_dir):
    diffs = compare.pairwise_bin_diff(tips_split(spark, sf_dir))
    matrix = compare.pivot_bin_diff(diffs, "tripDistanceBin", "fareAmountBin")
    return matrix.select("binB", *[F.round(f"`{b}`", 6).alias(b) for b in DISTANCE_LABELS])


@query(
    "pivot_bin_diff_dropped",
    on_trips(
        f"""SELECT "binB", {r("max(CASE WHEN binA = '1-3' THEN diff END)", 6)} AS "1-3"
        FROM pairs WHERE "featureA" = 'tripDistanceBin' AND "featureB" = 'fareAmountBin' AND binA = '1-3'
        GROUP BY "binB" HAVING max(diff) IS NOT NULL""",
        *TIP_CTES,
        PAIRS_SQL,
    ),
)
def pivot_bin_diff_dropped(spark, sf_dir):
    """Columns and rows without any difference are left out."""
    diffs = compare.pairwise_bin_diff(tips_split(spark, sf_dir))
    diffs = diffs.withColumn("diff", F.when(F.col("binA") == "1-3", F.col("diff")))
    matrix = compare.pivot_bin_diff(diffs, "tripDistanceBin", "fareAmountBin", drop_empty=True)
    return matrix.select("binB", *[F.round(f"`{b}`", 6).alias(b) for b in matrix.columns if b != "binB"])
