"""Inputs off the test tables: wide ranges, later years, decimal labels, ordinary weather files."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.functions import labels
from rideframe.operators import binning, clean, impact, quantiles, weather
from rideframe.plans import price_anomaly as price_plan
from rideframe.plans import tip_impact as tip_plan
from rideframe.session import drop_stages, path_exists, shared_folder, shuffle_partitions_for, stage
from rideframe.sources.weather import read_weather, read_wmo_lookup


def exact(spark, values, points=(0.0, 0.25, 0.5, 0.75, 1.0)):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return quantiles.exact_quantiles(df, {"x": list(points)})["x"]


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, math.inf],
        [-math.inf, math.inf],
        [-math.inf, -1.0, 0.0, 3.0, math.inf, math.inf],
        [-1e308, 0.0, 1.0, 1e308],
        [5e-324, 1e-323, 1.5e-323, 2e-323],
        [1.0, 1.0000000000000002, 1.0000000000000004],
    ],
)
def test_exact_quantiles_of_any_double(spark, values):
    ordered = sorted(values)
    points = (0.0, 0.25, 0.5, 0.75, 1.0)
    assert exact(spark, values) == [ordered[max(1, math.ceil(q * len(ordered))) - 1] for q in points]


def test_year_window_without_end(spark):
    days = [dt.datetime(y, 3, 1) for y in (2023, 2024, 2025, 2031)]
    df = spark.createDataFrame([(d, d) for d in days], "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")
    years = lambda *window: [r[0].year for r in clean.filter_year_window(df, *window).collect()]
    assert years(2024, None) == [2024, 2025, 2031]
    assert years(2024, 2025) == [2024, 2025]


def test_midpoint_of_decimal_labels(spark):
    given = ["[0.5|1.5)", "[-2.5|-0.5)", "[1|2)", "[a|2)", None]
    df = spark.createDataFrame([(v,) for v in given], "x string")
    assert [r[0] for r in df.select(labels.midpoint(F.col("x"))).collect()] == [1.0, -1.5, 1.5, None, None]


@pytest.mark.parametrize("start,width", [(0.5, 1.0), (-7.5, 1.25), (-3.0, 0.1), (2.0, 3.0)])
def test_merged_bins_keep_every_count(spark, start, width):
    rows = [("fee", f"[{start + i * width:.2f}|{start + (i + 1) * width:.2f})", "[0|5)", "[0|5)", i + 1) for i in range(20)]
    rows += [("flag", f"v{i}", "[0|5)", "[0|5)", 2) for i in range(20)]
    report = spark.createDataFrame(rows, "feature string, value string, cost_distance_label string, cost_time_label string, count bigint")
    merged = binning.merge_value_bins(report, max_values=6)
    assert merged.filter("value is null").count() == 0
    sums = {r[0]: r[1] for r in merged.groupBy("feature").agg(F.sum("count")).collect()}
    assert sums == {"fee": 210, "flag": 40}
    assert merged.filter("feature = 'fee'").count() <= 6
    assert merged.filter("feature = 'flag'").count() == 20


def test_averages_keep_fractions_of_a_cent(spark):
    df = spark.createDataFrame([(2024, 1, 0.004, 0.003)] * 10, "year int, month int, fare_amount double, tip_amount double")
    [row] = impact.monthly_pattern(df).collect()
    assert (row.avg_fare, row.avg_tip, row.total_trips) == (pytest.approx(0.004), pytest.approx(0.003), 10)


def test_weather_rows_that_cannot_be_read_are_left_out(spark, tmp_path):
    (tmp_path / "w.csv").write_text("time,code\n2024-03-01, 3 \nx,4\n2024-03-02,b\n2024-03-03,61\n")
    rows = {(r.date, r.wmo_code) for r in read_weather(spark, str(tmp_path / "w.csv")).collect()}
    assert rows == {(dt.date(2024, 3, 1), 3), (dt.date(2024, 3, 3), 61)}
    (tmp_path / "c.csv").write_text("code;text\n3;Overcast, dull\nq;none\n")
    assert [tuple(r) for r in read_wmo_lookup(spark, str(tmp_path / "c.csv")).collect()] == [(3, "Overcast, dull")]


def weather_file(spark, tmp_path):
    """Eight years of days with five columns, and a hundred codes with long texts."""
    first = dt.date(2016, 1, 1)
    days = [first + dt.timedelta(n) for n in range(2922)]
    (tmp_path / "w.csv").write_text("time,code,a,b,c\n" + "".join(f"{d},{n % 100},1.5,2.5,3.5\n" for n, d in enumerate(days)))
    (tmp_path / "c.csv").write_text("code;text\n" + "".join(f"{n};{'weather ' * 20}{n}\n" for n in range(100)))
    return weather.describe_weather(read_weather(spark, str(tmp_path / "w.csv")), read_wmo_lookup(spark, str(tmp_path / "c.csv")))


def many_trips(spark, n=4_000_000):
    return spark.range(n).selectExpr("timestampadd(HOUR, cast(id % 60000 as int), timestamp_ntz'2016-01-01 00:00:00') as pickup_datetime", "id")


@pytest.mark.parametrize("dedupe", [True, False])
def test_trips_are_not_shuffled_for_ordinary_weather(spark, tmp_path, dedupe):
    joined = weather.join_weather(many_trips(spark), weather_file(spark, tmp_path), dedupe)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_large_weather_is_joined_by_shuffle_with_a_hot_date_split(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 10 < 9, F.lit(dt.datetime(2017, 5, 5, 8))).otherwise(F.col("pickup_datetime"))
        trips = many_trips(spark, 400_000).withColumn("pickup_datetime", hot.cast("timestamp_ntz"))
        joined = weather.join_weather(trips, weather_file(spark, tmp_path), True, broadcast_bytes=0)
        rows = joined.groupBy("weather").count()
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_weather_of_dates_counts_as_weather_of_trips(spark, tmp_path):
    trips = many_trips(spark, 5000).selectExpr("pickup_datetime", "to_date(pickup_datetime) as pickup_date", "id % 7 as tip_percentage")
    daily = weather_file(spark, tmp_path)
    daily = daily.unionAll(daily.filter("wmo_code % 3 = 0").selectExpr("date", "wmo_code + 1", "description"))
    by_date = weather.attach_weather(impact.tip_cells(trips, ["pickup_date"]), daily, "pickup_date")
    got = {tuple(r) for r in impact.tip_by_weather(by_date, cells=True).collect()}
    whole = weather.join_weather(trips, daily, dedupe=False)
    assert got == {tuple(r) for r in impact.tip_by_weather(whole).collect()}


SF_DIR = "/root/testdata/sf0.001"


def test_default_quantiles_trim_nearly_the_same_trips(spark):
    """Each of the four approximate bounds may be off by one percent of the trips."""
    raw = fx.both_services(spark, SF_DIR)
    kept = {}
    for method in ("approx", "exact"):
        reports = tip_plan.tip_impact_df(raw, quantile_method=method)
        kept[method] = reports["monthlyPattern"].agg(F.sum("total_trips")).first()[0]
    everything = tip_plan.clean_tip_trips_df(raw).count()
    assert abs(kept["approx"] - kept["exact"]) <= 0.04 * everything + 4
    assert 0.9 * everything <= kept["approx"] <= everything


def test_default_quantiles_of_the_weather_form(spark):
    raw = fx.raw_trips(spark, SF_DIR, "yellow")
    tips = {}
    for method in ("approx", "exact"):
        reports = tip_plan.tip_impact_weather(raw, "yellow", fx.weather(spark, SF_DIR), fx.wmo_lookup(spark, SF_DIR), quantile_method=method)
        tips[method] = {r[0]: r[1] for r in reports["avg_tip_by_hour_bucket"].collect()}
    assert tips["approx"].keys() == tips["exact"].keys()
    assert all(abs(v - tips["exact"][k]) < 1.5 for k, v in tips["approx"].items())


def test_services_together_give_what_each_gives_alone(spark):
    """Averages, bounds, bins and shares of a service do not depend on the other one."""
    raw = fx.both_services(spark, SF_DIR)
    weather_inputs = fx.weather(spark, SF_DIR), fx.wmo_lookup(spark, SF_DIR)
    steps = price_plan.price_anomaly_services(raw, *fx.ALL_YEARS).collect()
    splits = price_plan.price_anomaly_df_services(raw).collect()
    tips = tip_plan.tip_impact_weather_services(raw, *weather_inputs, quantile_method="exact")["all_features"].collect()
    for service, df in raw.items():
        alone = {
            "steps": (steps, price_plan.price_anomaly(df, service, *fx.ALL_YEARS)),
            "splits": (splits, price_plan.price_anomaly_df(df, service)),
            "tips": (
                [(*r[:2], round(r[2], 9)) for r in tips],
                tip_plan.tip_impact_weather(df, service, *weather_inputs, quantile_method="exact")["all_features"],
            ),
        }
        for name, (together, single) in alone.items():
            rows = [tuple(r) if name != "tips" else (r[0], round(r[1], 9)) for r in single.collect()]
            assert sorted(map(str, rows)) == sorted(str(tuple(r)[1:]) for r in together if r[0] == service), name
            assert rows


def test_staged_tables_can_be_dropped(spark):
    assert stage(spark.range(3), "numbers").count() == 3
    folder = f"{shared_folder(spark)}/rideframe/{spark.sparkContext.applicationId}"
    assert path_exists(spark, folder)
    drop_stages(spark)
    assert not path_exists(spark, folder)
    assert shuffle_partitions_for(10**15, 8, most=1000) == 1000


def test_price_rows_of_every_year(spark):
    """The class and profile queries drop no trip for its year; the window of price_anomaly does."""
    raw = fx.raw_trips(spark, "/root/testdata/sf0.001", "yellow")
    good = price_plan.clean_price_trips(raw, "yellow", *fx.ALL_YEARS).limit(1)
    one = raw.join(good.selectExpr("pickup_datetime AS tpep_pickup_datetime", "dropoff_datetime AS tpep_dropoff_datetime"), ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "left_semi").limit(1)
    for year, inside in ((1992, False), (1996, True), (2030, False)):
        moved = one.withColumns(
            {"tpep_pickup_datetime": F.lit(dt.datetime(year, 3, 4, 10)).cast("timestamp_ntz"), "tpep_dropoff_datetime": F.lit(dt.datetime(year, 3, 4, 11)).cast("timestamp_ntz")}
        )
        assert price_plan.clean_price_trips(moved, "yellow", *fx.ALL_YEARS).count() == 1
        assert price_plan.clean_price_trips(moved, "yellow", fx.FIRST_YEAR, fx.LAST_YEAR).count() == int(inside)
        assert price_plan.clean_price_trips(moved, "yellow", fx.FIRST_YEAR, None).count() == int(year >= fx.FIRST_YEAR)
