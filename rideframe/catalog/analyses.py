"""The two analyses and their report tables, end to end over both services."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.catalog.aggregates import (
    KEYS_SQL,
    MONTHLY_SQL,
    NUDGE,
    PAIRS_SQL,
    RUSH_SQL,
    SAME_SQL,
    TIP_BINNED_SQL,
    TIPS_SPLIT_SQL,
    WEATHER_DAILY_SQL,
    class_averages_sql,
    nudged,
    price_features_sql,
    years_sql,
    profile_sql,
    rounded,
    tip_by_feature_sql,
)
from rideframe.catalog.registry import on_trips, on_weather, per_service, query, r, r_even, step, union_sql
from rideframe.catalog.scalars import HOLIDAY_SQL, WEATHER_CLASS_SQL, quantile_splits_sql
from rideframe.operators import binning, profile
from rideframe.plans import price_anomaly as price_plan
from rideframe.plans import reports as report_plan
from rideframe.plans import stored_cells as store
from rideframe.plans import tip_impact as tip_plan
from rideframe.session import new_shared_path
from rideframe.sources.reports import read_report, write_report
from rideframe.spec import PRICE_CLASS_COLUMNS, PRICE_CLASS_COLUMNS_DF, SERVICES


# --- price anomaly ----------------------------------------------------------

PRICE_KEYS_SQL = ", ".join(PRICE_CLASS_COLUMNS)


def deviation_sql(rows: str, keys: str) -> str:
    def pct(price: str) -> str:
        diff = r(f"{price} - avg_{price}", 4)
        return r(f"{diff} / avg_{price} * 100", 4)

    return f"""deviations AS (
  SELECT *, {pct("cost_per_distance")} AS d_pct, {pct("cost_per_time")} AS t_pct
  FROM {rows} JOIN class_averages USING ({keys})
), deviation_labels AS (
  SELECT *, {step("d_pct", 5)} AS d_label, {step("t_pct", 5)} AS t_label FROM deviations
)"""


def price_anomaly_sql(service: str, distinct_fees: bool = False, gap: int = 0, years: str = "true") -> str:
    return on_trips(
        profile_sql("deviation_labels", list(PRICE_CLASS_COLUMNS), "d_label", "t_label"),
        price_features_sql(service, distinct_fees, gap, years),
        class_averages_sql(PRICE_KEYS_SQL),
        deviation_sql("price_rows", PRICE_KEYS_SQL),
    )


@query("price_anomaly", union_sql(lambda s: price_anomaly_sql(s, years=years_sql(fx.FIRST_YEAR, fx.LAST_YEAR))))
def price_anomaly(spark, sf_dir):
    raw = fx.both_services(spark, sf_dir)
    return price_plan.price_anomaly_services(raw, fx.FIRST_YEAR, fx.LAST_YEAR)


@query("price_anomaly_literal", union_sql(lambda s: price_anomaly_sql(s, True, 1, years_sql(fx.FIRST_YEAR, None))))
def price_anomaly_literal(spark, sf_dir):
    """Equal fees count once and the overnight zone ends at 23:59:59; all years from the first on."""
    raw = fx.both_services(spark, sf_dir)
    return price_plan.price_anomaly_services(raw, fx.FIRST_YEAR, distinct_fees=True, midnight_gap_s=1)


def stored_cells(spark, sf_dir):
    """Cells of all months, written in two updates, and a month in the middle replaced by itself."""
    raw = fx.both_services(spark, sf_dir)
    first, last = fx.trips(spark, sf_dir).agg(F.min("pickup_datetime"), F.max("pickup_datetime")).first()
    start, cut, end = date(first.year, 1, 1), date((first.year + last.year) // 2, 6, 1), date(last.year + 1, 1, 1)
    path = new_shared_path(spark, "stored-cells")
    store.update_cells(raw, path, start, cut)
    store.update_cells(raw, path, cut, end)
    store.update_cells({SERVICES[0]: raw[SERVICES[0]]}, path, cut, date(cut.year, cut.month + 1, 1))
    return store.read_cells(spark, path)


@query("price_anomaly_incremental", union_sql(price_anomaly_sql))
def price_anomaly_incremental(spark, sf_dir):
    """The report over cells that were stored month by month: equal to that of all trips at once."""
    return price_plan.price_anomaly_of_cells(stored_cells(spark, sf_dir))


@query(
    "class_averages_incremental",
    union_sql(
        lambda s: on_trips(
            "SELECT * FROM class_averages", price_features_sql(s), class_averages_sql(PRICE_KEYS_SQL)
        )
    ),
)
def class_averages_incremental(spark, sf_dir):
    return price_plan.class_averages_of_cells(stored_cells(spark, sf_dir))


def price_df_ctes(service: str, literal: bool = False) -> tuple[str, ...]:
    """Common tables of the DataFrame form up to ``labelled_df``."""
    fees = [
        "extra",
        "mta_tax",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
        "weekday_surcharge",
    ]
    if service == "yellow":
        fees.insert(5, "airport_fee")
    gap = 1 if literal else 0

    def cut(day: str, start: str, end: str) -> str:
        low = f"greatest(pickup_datetime, {day} + INTERVAL {start})"
        high = f"least(dropoff_datetime, {day} + INTERVAL {end})"
        seconds = f"greatest(epoch({high}) - epoch({low}), 0)"
        if literal:
            return f"floor({seconds} / 60)"
        return f"round(CAST({seconds} AS DECIMAL(18,0)) / 60, 4)"

    overnight = " + ".join(
        cut(day, *hours)
        for day in ("day0", "(day0 + INTERVAL 1 DAY)")
        for hours in (("20 HOUR", f"{86400 - gap} SECOND"), ("0 HOUR", "6 HOUR"))
    )
    surcharge = (
        f"CASE WHEN {HOLIDAY_SQL.format(t='pickup_datetime')} THEN 0 ELSE 2.5 END::DOUBLE"
    )
    keys = ", ".join(PRICE_CLASS_COLUMNS_DF)

    def average(price: str) -> str:
        return r(f"sum(CAST(round({price} * 100) AS BIGINT))::DOUBLE / (count(*) * 100)", 2)

    def pct(price: str) -> str:
        return r(f"100 * ({price} - avg_{price}) / nullif(avg_{price}, 0)", 2)

    in_bin = "{c} >= {b}.low AND ({c} < {b}.high OR ({b}.is_last AND {c} = {b}.high))"
    return (
        f"""timed AS (
  SELECT *, {r("epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE", 2)} AS duration_minutes,
    {surcharge} AS weekday_surcharge, date_trunc('day', pickup_datetime)::TIMESTAMP AS day0,
    CAST(year(pickup_datetime) AS INTEGER) AS year
  FROM trips
  WHERE service_type = '{service}' AND passenger_count > 0 AND trip_distance > 0
    AND (ratecode_id BETWEEN 1 AND 6 OR ratecode_id = 99) AND payment_type BETWEEN 1 AND 6
    AND fare_amount > 0 AND tolls_amount < 200
), featured AS (
  SELECT *, {r(" + ".join(fees), 2)} AS aggregate_fee,
    {r(f"100 * CAST({overnight} AS DOUBLE) / duration_minutes", 2)} AS duration_minutes_overnight_pcg,
    {r("fare_amount / trip_distance", 2)} AS cost_per_distance,
    {r("fare_amount / duration_minutes", 2)} AS cost_per_time,
    {step("duration_minutes", 5)} AS duration_minutes_bin_label,
    {step("trip_distance", 5)} AS trip_distance_bin_label
  FROM timed WHERE duration_minutes > 0 AND {" AND ".join(f"{fee} >= 0" for fee in fees)}
)""",
        quantile_splits_sql("fee", "featured", "aggregate_fee", 10),
        quantile_splits_sql("night", "featured", "duration_minutes_overnight_pcg", 20),
        f"""binned_df AS (
  SELECT featured.*, fee_bins.label AS aggregate_fee_bin_label,
    CAST(night_bins.idx AS DOUBLE) AS duration_minutes_overnight_pcg_bin
  FROM featured
  JOIN fee_bins ON {in_bin.format(c="aggregate_fee", b="fee_bins")}
  JOIN night_bins ON {in_bin.format(c="duration_minutes_overnight_pcg", b="night_bins")}
), averages_df AS (
  SELECT {keys}, {average("cost_per_distance")} AS avg_cost_per_distance,
    {average("cost_per_time")} AS avg_cost_per_time
  FROM binned_df GROUP BY {keys}
), deviations_df AS (
  SELECT *, {pct("cost_per_distance")} AS d_pct, {pct("cost_per_time")} AS t_pct
  FROM binned_df LEFT JOIN averages_df USING ({keys})
), labelled_df AS (
  SELECT *, {step("d_pct", 5)} AS d_label, {step("t_pct", 5)} AS t_label FROM deviations_df
)""",
    )


def price_anomaly_df_sql(service: str, literal: bool = False) -> str:
    profile = profile_sql("labelled_df", list(PRICE_CLASS_COLUMNS_DF), "d_label", "t_label", 2)
    return on_trips(profile, *price_df_ctes(service, literal))


@query("price_anomaly_df", union_sql(price_anomaly_df_sql))
def price_anomaly_df(spark, sf_dir):
    return price_plan.price_anomaly_df_services(fx.both_services(spark, sf_dir))


@query("price_anomaly_df_literal", union_sql(lambda s: price_anomaly_df_sql(s, True)))
def price_anomaly_df_literal(spark, sf_dir):
    """Overnight minutes are cut to whole minutes and end at 23:59:59."""
    raw = fx.both_services(spark, sf_dir)
    return price_plan.price_anomaly_df_services(raw, zone_unit="minute_trunc", midnight_gap_s=1)


@query(
    "class_averages_df",
    union_sql(
        lambda s: on_trips(
            "SELECT *, (SELECT count(*) FROM binned_df b WHERE "
            + " AND ".join(f"b.{c} IS NOT DISTINCT FROM a.{c}" for c in PRICE_CLASS_COLUMNS_DF)
            + ") AS n_class FROM averages_df a",
            *price_df_ctes(s),
        )
    ),
)
def class_averages_df(spark, sf_dir):
    return price_plan.class_averages_df_services(fx.both_services(spark, sf_dir))


# --- tip impact -------------------------------------------------------------


def within_sql(column: str, source: str) -> str:
    return f"""{column} BETWEEN (SELECT quantile_disc({column}, 0.02) FROM {source})
      AND (SELECT quantile_disc({column}, 0.98) FROM {source})"""


def tip_trimmed_sql(where: str, trim: tuple[str, ...]) -> str:
    """Common table ``tip_clean`` of trimmed trips, the source of ``tip_binned``."""
    bounds = " AND ".join(within_sql(c, "tip_plausible") for c in trim)
    return f"""tip_plausible AS (
  SELECT DISTINCT service_type, vendor_id, pickup_datetime, dropoff_datetime, fare_amount, tip_amount,
    payment_type, trip_distance, total_amount,
    epoch(dropoff_datetime - pickup_datetime) / 60.0::DOUBLE AS trip_duration_min
  FROM trips
  WHERE fare_amount > 0 AND tip_amount >= 0 AND tip_amount <= 1.5::DOUBLE * fare_amount
    AND trip_distance > 0 AND dropoff_datetime > pickup_datetime
    AND (vendor_id IN (1, 2, 6) OR (vendor_id = 7 AND service_type = 'yellow')) AND {where}
), tip_clean AS (SELECT * FROM tip_plausible WHERE {bounds})"""


def tip_impact_weather_sql(
    service: str, trim: tuple[str, ...] = tip_plan.TRIM_COLUMNS, weather: str = "one_per_date"
) -> str:
    return on_weather(
        f"""SELECT report, key, 'avg_tip_pct' AS metric, {r("avg_tip_pct", 6)} AS value FROM (
          SELECT 'all_features' AS report, feature AS key, avg_tip_pct
          FROM ({tip_by_feature_sql("tip_weather")})
          UNION ALL SELECT 'avg_tip_by_weather', weather, avg(tip_percentage) FROM tip_weather GROUP BY weather
          UNION ALL SELECT 'avg_tip_by_hour_bucket', trip_hour_bucket, avg(tip_percentage)
          FROM tip_weather GROUP BY trip_hour_bucket)""",
        tip_trimmed_sql(f"service_type = '{service}'", trim),
        TIP_BINNED_SQL,
        WEATHER_DAILY_SQL,
        f"""tip_weather AS (
  SELECT *, {WEATHER_CLASS_SQL.format(c="wmo_code")} AS weather
  FROM tip_binned JOIN {weather} ON CAST(pickup_datetime AS DATE) = date
)""",
    )


def weather_reports(spark, sf_dir, **options):
    return tip_plan.tip_impact_weather_services(
        fx.both_services(spark, sf_dir),
        fx.weather(spark, sf_dir),
        fx.wmo_lookup(spark, sf_dir),
        quantile_method="exact",
        **options,
    )


@query("tip_impact_weather", union_sql(tip_impact_weather_sql))
def tip_impact_weather(spark, sf_dir):
    reports = weather_reports(spark, sf_dir)
    return rounded(tip_plan.long_report(reports, tip_plan.WEATHER_REPORT_KEYS, [tip_plan.SERVICE]), "value")


LITERAL_TRIM = ("payment_type", "trip_duration_min")


@query(
    "tip_impact_weather_literal",
    union_sql(lambda s: tip_impact_weather_sql(s, LITERAL_TRIM, "described")),
)
def tip_impact_weather_literal(spark, sf_dir):
    """Trips are trimmed by payment type, and repeat on dates with two weather rows."""
    reports = weather_reports(spark, sf_dir, trim_columns=LITERAL_TRIM, dedupe_weather=False)
    return rounded(tip_plan.long_report(reports, tip_plan.WEATHER_REPORT_KEYS, [tip_plan.SERVICE]), "value")


def melt_sql(report: str, keys: list[str], metrics: dict[str, str], source: str) -> str:
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return " UNION ALL ".join(
        f"""SELECT '{report}' AS report, {key} AS key, '{name}' AS metric,
        CAST({expression} AS DOUBLE) AS value FROM ({source})"""
        for name, expression in metrics.items()
    )


def tip_impact_df_sql() -> str:
    impact_sql = f"""SELECT {KEYS_SQL}, avg(tip_amount) AS avg_tip, avg(trip_duration_min) AS avg_duration,
      count(*) AS count_trips FROM tip_binned GROUP BY {KEYS_SQL}"""
    parts = [
        melt_sql(
            "allCombinationsImpact",
            KEYS_SQL.split(", "),
            {c: r(f"{c} + {NUDGE}", 6) for c in ("avg_tip", "avg_duration", "count_trips")},
            impact_sql,
        ),
        melt_sql(
            "rushHourAnalysis",
            ["is_rush_hour"],
            {c: r(f"{c} + {NUDGE}", 6) for c in ("avg_duration", "avg_tip_pct", "avg_speed")},
            RUSH_SQL,
        ),
        melt_sql(
            "monthlyPattern",
            ["year", "month"],
            {c: r(f"{c} + {NUDGE}", 6) for c in ("avg_fare", "avg_tip", "total_trips")},
            MONTHLY_SQL,
        ),
    ]
    return on_trips(
        " UNION ALL ".join(parts),
        tip_trimmed_sql("payment_type BETWEEN 1 AND 6", tip_plan.TRIM_COLUMNS),
        TIP_BINNED_SQL,
    )


@query("tip_impact_df", tip_impact_df_sql())
def tip_impact_df(spark, sf_dir):
    reports = tip_plan.tip_impact_df(fx.both_services(spark, sf_dir), quantile_method="exact")
    return nudged(tip_plan.long_report(reports, tip_plan.IMPACT_REPORT_KEYS), "value")


# --- report tables ----------------------------------------------------------

NUMBER_SQL = r"(-?[0-9]+(?:\.[0-9]+)?)"
LOW_SQL = rf"TRY_CAST(nullif(regexp_extract({{c}}, '\[{NUMBER_SQL}\|', 1), '') AS DOUBLE)"
HIGH_SQL = rf"TRY_CAST(nullif(regexp_extract({{c}}, '\|{NUMBER_SQL}\)', 1), '') AS DOUBLE)"


def rebin_sql(profile_query: str, most: int = 15) -> str:
    """Common table ``rebinned`` over a profile of one service."""
    low, high = LOW_SQL.format(c="value"), HIGH_SQL.format(c="value")
    return f"""profile AS ({profile_query}),
parsed AS (SELECT *, {low} AS low, {high} AS high FROM profile),
ranges AS (
  SELECT feature, count(DISTINCT value) AS n_values, count(*) FILTER (low IS NULL OR high IS NULL) AS n_plain,
    min(low) AS range_low, greatest(min(low), least(max(low), 100)) AS range_high
  FROM parsed GROUP BY feature
), edges AS (
  SELECT feature, edge, lead(edge) OVER (PARTITION BY feature ORDER BY edge) AS next_edge,
    row_number() OVER (PARTITION BY feature ORDER BY edge) AS place FROM (
    SELECT DISTINCT feature, CAST(trunc(CASE WHEN k = {most - 1} THEN range_high
      ELSE range_low + (range_high - range_low) / {most - 1} * k END) AS BIGINT) AS edge
    FROM ranges, range({most}) AS steps(k) WHERE n_values > {most} AND n_plain = 0)
), merged AS (
  SELECT p.feature, CASE WHEN e.edge IS NULL THEN p.value WHEN e.next_edge IS NULL THEN '>=' || e.edge
      ELSE '[' || e.edge || '|' || e.next_edge || ')' END AS value,
    p.cost_distance_label, p.cost_time_label, CAST(sum(p.count) AS BIGINT) AS count
  FROM parsed p LEFT JOIN edges e ON e.feature = p.feature AND ((p.low + p.high) / 2 >= e.edge OR e.place = 1)
    AND ((p.low + p.high) / 2 < e.next_edge OR e.next_edge IS NULL)
  GROUP BY ALL
), rebinned AS (
  SELECT *, {r_even("count / (sum(count) OVER (PARTITION BY feature, value))::DOUBLE * 100", 5)} AS pcg FROM merged
)"""


def profiles(spark, sf_dir):
    """The written profile of every service, which the report tables read several times."""
    report = price_plan.price_anomaly_services(fx.both_services(spark, sf_dir), *fx.ALL_YEARS)
    path = new_shared_path(spark, "price-anomaly")
    write_report(report, path, partition_by=[price_plan.SERVICE])
    written = read_report(spark, path)
    return lambda service: written.filter(F.col(price_plan.SERVICE) == service).drop(price_plan.SERVICE)


REBIN_COLUMNS = "feature, value, cost_distance_label, cost_time_label, count, pcg"


@query(
    "rebin_equal_width",
    union_sql(lambda s: f"WITH {rebin_sql(price_anomaly_sql(s))} SELECT {REBIN_COLUMNS} FROM rebinned"),
)
def rebin_equal_width(spark, sf_dir):
    profile_of = profiles(spark, sf_dir)
    return per_service(lambda service: binning.rebin_equal_width(profile_of(service)))


@query(
    "rebin_equal_width_df",
    union_sql(lambda s: f"WITH {rebin_sql(price_anomaly_df_sql(s), 6)} SELECT {REBIN_COLUMNS} FROM rebinned"),
)
def rebin_equal_width_df(spark, sf_dir):
    """The fee bins of the DataFrame form have decimal bounds, and more of them than are kept."""
    report = price_plan.price_anomaly_df_services(fx.both_services(spark, sf_dir))
    path = new_shared_path(spark, "price-anomaly-df")
    write_report(report, path, partition_by=[price_plan.SERVICE])
    written = read_report(spark, path)

    def build(service):
        own = written.filter(F.col(price_plan.SERVICE) == service).drop(price_plan.SERVICE)
        return binning.rebin_equal_width(own, max_values=6)

    return per_service(build)


SORT_KEY_SQL = (
    "CASE WHEN {c} LIKE '<%' THEN -1e6 WHEN {c} LIKE '>%' THEN 1e6 ELSE "
    + LOW_SQL
    + " END::DOUBLE"
)


def share_sql(source: str, metric: str) -> str:
    label = f"cost_{metric}_label"
    first = f"TRY_CAST(nullif(regexp_extract({label}, '-?[0-9]+'), '') AS BIGINT)"
    return f"""SELECT feature, value, '{metric}' AS metric, bin, count,
      {r_even("count / (sum(count) OVER (PARTITION BY feature, value))::DOUBLE * 100", 5)} AS pcg,
      {SORT_KEY_SQL.format(c="value")} AS value_order, {SORT_KEY_SQL.format(c="bin")} AS bin_order
    FROM (SELECT feature, value, CASE WHEN {first} >= 100 THEN '>= 100' ELSE {step(first, 10)} END AS bin,
          CAST(sum(count) AS BIGINT) AS count FROM {source} GROUP BY ALL)"""


@query(
    "share_within_value",
    union_sql(
        lambda s: f"""WITH profile AS ({price_anomaly_sql(s)})
        {share_sql("profile", "distance")} UNION ALL {share_sql("profile", "time")}"""
    ),
)
def share_within_value(spark, sf_dir):
    profile_of = profiles(spark, sf_dir)
    return per_service(lambda service: profile.share_within_value(profile_of(service), ["distance", "time"]))


def price_anomaly_report_sql(service: str) -> str:
    return f"""WITH {rebin_sql(price_anomaly_sql(service))}
    {share_sql("rebinned", "distance")} UNION ALL {share_sql("rebinned", "time")}"""


@query("price_anomaly_report", union_sql(price_anomaly_report_sql))
def price_anomaly_report(spark, sf_dir):
    profile_of = profiles(spark, sf_dir)
    return per_service(lambda service: report_plan.price_anomaly_report(profile_of(service)))


def tip_diff_report_sql(service: str) -> str:
    def ordered(mode: str, source: str) -> str:
        number = "TRY_CAST(nullif(regexp_extract({c}, '[0-9]+'), '') AS DOUBLE)"
        return f"""SELECT '{mode}' AS mode, "featureA", "binA", "featureB", "binB", {r("diff", 6)} AS diff,
        {number.format(c='"binA"')} AS column_order, 0 - {number.format(c='"binB"')} AS row_order FROM {source}"""

    return on_weather(
        ordered("pair", "pairs") + " UNION ALL " + ordered("same", "same"),
        tip_trimmed_sql(f"service_type = '{service}'", tip_plan.TRIM_COLUMNS),
        TIP_BINNED_SQL.replace("tip_binned AS", "tip_all AS"),
        WEATHER_DAILY_SQL,
        "tip_binned AS (SELECT * FROM tip_all JOIN one_per_date ON CAST(pickup_datetime AS DATE) = date)",
        TIPS_SPLIT_SQL,
        PAIRS_SQL,
        SAME_SQL,
    )


@query("tip_diff_report", union_sql(tip_diff_report_sql))
def tip_diff_report(spark, sf_dir):
    """Both kinds of differences, from the tip report of each service."""
    path = new_shared_path(spark, "tip-features")
    write_report(weather_reports(spark, sf_dir)["all_features"], path, single_file=True)
    tips = read_report(spark, path)

    def build(service):
        own = tips.filter(F.col(tip_plan.SERVICE) == service).drop(tip_plan.SERVICE)
        modes = [
            report_plan.tip_diff_report(own, mode).select(F.lit(mode).alias("mode"), "*")
            for mode in ("pair", "same")
        ]
        return modes[0].unionByName(modes[1])

    return rounded(per_service(build), "diff")
