"""The physical plans: no Python, filters and columns at the scan, few shuffles."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from rideframe.catalog import QUERIES
from rideframe.catalog import fixtures as fx
from rideframe.operators import classes, clean, impact, profile
from rideframe.plans import price_anomaly as price_plan
from rideframe.sources.trips import tip_trips, union_services

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    """The initial physical plan, with one line per operator."""
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> str:
    """The plan with the whole details of each scan."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def final_plan(df) -> str:
    """The plan after it has run, without the initial plan that follows it."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_no_query_runs_python_in_its_plan(spark):
    for name in ("price_anomaly", "zone_minutes", "impact_vs_first_bin", "bin_quantiles", "coarsen_labels"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert not re.search(r"PythonUDF|EvalPython|InPandas|InArrow", text), name


def test_no_plan_has_a_cross_join(spark):
    for name in ("price_anomaly", "pairwise_bin_diff", "rebin_equal_width", "weather_join"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_price_filters_reach_the_scan(spark):
    raw = fx.raw_trips(spark, SF_DIR, "yellow")
    text = scans(price_plan.clean_price_trips(raw, "yellow", 1996, 2001).select("fare_amount"))
    [pushed] = re.findall(r"PushedFilters: .*", text)
    for part in (
        "GreaterThanOrEqual(pickup_datetime,1996-01-01",
        "LessThan(dropoff_datetime,2002-01-01",
        "GreaterThanOrEqual(passenger_count,1.0)",
        "GreaterThan(trip_distance,0.0)",
        "In(store_and_fwd_flag, [N,Y])",
    ):
        assert part in pushed, (part, pushed)


def test_tip_report_reads_only_its_columns(spark):
    raw = fx.both_services(spark, SF_DIR)
    trips = union_services(*[tip_trips(df, s) for s, df in raw.items()])
    text = scans(clean.filter_vendor(trips).groupBy("payment_type").agg(F.sum("fare_amount")))
    assert text.count("ReadSchema") == 2
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        names = {field.split(":")[0] for field in schema.split(",")}
        assert names <= {"VendorID", "vendor_id", "fare_amount", "payment_type"}


def test_vendor_filter_is_folded_per_service(spark):
    raw = fx.both_services(spark, SF_DIR)
    trips = union_services(*[tip_trips(df, s) for s, df in raw.items()])
    text = scans(clean.filter_vendor(trips))
    assert "yellow =" not in text and "green =" not in text
    assert "In(vendor_id, [1,2,6,7])" in text and "In(vendor_id, [1,2,6])" in text


def test_price_cells_are_scanned_and_shuffled_once(spark):
    raw = fx.raw_trips(spark, SF_DIR, "yellow")
    text = final_plan(price_plan.price_anomaly(raw, "yellow", 1996, 2001))
    assert text.count("FileScan") == 1
    assert "ReusedExchange" in text


def test_services_share_one_shuffle_of_their_cells(spark):
    raw = fx.both_services(spark, SF_DIR)
    text = final_plan(price_plan.price_anomaly_services(raw, 1996, 2001))
    assert text.count("FileScan") == 2  # one for each service
    assert "ReusedExchange" in text
    assert len(re.findall(r"Union", text)) == 1


def test_profile_has_one_expand_over_combined_rows(spark):
    trips = fx.trips(spark, SF_DIR).withColumn("label", F.lit("[0|5)"))
    features = ["payment_type", "store_and_fwd_flag", "passenger_count"]
    text = final_plan(profile.feature_profile(trips, features, "label", "label"))
    assert text.count("Expand") == 1
    assert text.count("FileScan") == 1


def test_averages_are_partial_before_the_shuffle(spark):
    trips = fx.trips(spark, SF_DIR).selectExpr(
        "payment_type", "fare_amount as cost_per_distance", "fare_amount as cost_per_time"
    )
    text = plan(classes.class_averages(trips, ["payment_type"]))
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_monthly_pattern_needs_one_shuffle_and_a_sort(spark):
    trips = fx.trips(spark, SF_DIR).selectExpr(
        "year(pickup_datetime) as year", "month(pickup_datetime) as month", "tip_amount", "fare_amount"
    )
    text = plan(impact.monthly_pattern(trips))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange rangepartitioning") == 1


def test_top_amounts_keep_the_first_rows_of_each_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_amounts"](spark, SF_DIR))
