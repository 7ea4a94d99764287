"""What the price plans of the DataFrame form generate and move."""

import re

from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.operators import clean
from rideframe.operators.profile import feature_profile
from rideframe.plans import price_anomaly as price_plan
from tests.test_trip_files import line_items

#: The virtual machine leaves methods beyond this size uncompiled.
COMPILED_BYTES = 8000


def method_sizes(spark, make):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that is settled before it runs
    try:
        return sizes_of(spark, make())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def sizes_of(spark, df):
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    text = debug.codegenString(df._jdf.queryExecution().executedPlan())
    return [int(size) for size in re.findall(r"maxMethodCodeSize:\s*(\d+)", text)]


def test_the_scan_of_price_trips_is_short_enough_to_be_compiled(spark, tmp_path):
    folder = line_items(spark, tmp_path, lambda k: "OF"[k % 2])
    raw = fx.both_services(spark, folder)
    for service, df in raw.items():
        sizes = method_sizes(spark, lambda: price_plan._with_charges_df(price_plan.clean_price_trips_df(df, service)))
        assert 0 < max(sizes) < COMPILED_BYTES
    sizes = method_sizes(spark, lambda: price_plan._binned_cells_df(raw, "minute", 0)[0])
    assert 0 < max(sizes) < COMPILED_BYTES


def test_incomplete_rows_are_dropped_by_a_condition_per_column(spark):
    rows = [(1.0, "a", 1), (float("nan"), "a", 1), (None, "a", 1), (1.0, None, 1), (1.0, "a", None)]
    df = spark.createDataFrame(rows, "`x y` double, s string, n long")
    assert [tuple(r) for r in clean.drop_incomplete_nan(df).collect()] == [(1.0, "a", 1)]
    assert clean.drop_incomplete_nan(df, ["n"]).count() == 4


def test_profile_counts_numbers_and_labels_them_afterwards(spark):
    rows = spark.createDataFrame([(5, 0, -5), (5, 0, -5), (10, None, 0)], "f int, d int, t int")

    def label(counted):
        return counted.select(*[F.concat(F.lit("at "), F.col(c).cast("string")).alias(f"{c}_label") for c in "fdt"], "n_rows")

    out = feature_profile(rows, ["f_label"], "d_label", "t_label", numbers=["f", "d", "t"], label=label)
    plain = feature_profile(label(rows.withColumn("n_rows", F.lit(1))), ["f_label"], "d_label", "t_label")
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    assert out.count() == 2


def test_profile_counts_values_not_combinations_of_features(spark):
    rows = spark.range(1000).selectExpr(
        "id % 10 as a", "id div 10 % 10 as b", "if(id < 100, null, id div 100) as c", "'d' as d", "'t' as t"
    )
    seen = []

    def label(counted):
        seen.append(counted)
        return counted

    out = feature_profile(rows, ["a", "b", "c"], "d", "t", label=label)
    found = {(r["feature"], r["value"]): (r["count"], r["pcg"]) for r in out.collect()}
    values = [("a", str(i)) for i in range(10)] + [("b", str(i)) for i in range(10)]
    assert found == dict.fromkeys([*values, *[("c", str(i)) for i in range(1, 10)], ("c", None)], (100, 10.0))
    assert seen[0].count() == 30  # 1000 combinations of the three


def test_profile_reads_its_rows_once(spark):
    rows = spark.range(100).selectExpr("id % 3 as a", "id % 5 as b", "id % 2 as d", "'t' as t", "id as n", "id % 2 as k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = feature_profile(rows, ["a", "b"], "d", "t", weight="n", keys=["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ReusedExchange") == 1 and plan.count("Range (") == 1 and plan.count("Expand") == 1


def cells_of(rows):
    """Cells of two classes: nearly all in the first, which has no passenger count."""
    return rows.selectExpr(
        "'yellow' as service_type",
        "if(id % 500 = 0, 1D, null) as passenger_count",
        "'N' as store_and_fwd_flag",
        "1D as payment_type",
        *[f"0L as {c}" for c in price_plan.CELL_FEATURES if c.endswith("_start")],
        "2020 as year",
        "id / 100D as cost_per_distance",
        "(id % 97 + 1) / 100D as cost_per_time",
        "1L as n_trips",
    )


def test_cells_are_not_sorted_to_be_joined_with_their_averages(spark, tmp_path):
    folder = line_items(spark, tmp_path, lambda k: "OF"[k % 2])
    raw = fx.both_services(spark, folder)
    reports = (
        lambda: price_plan.price_anomaly_of_cells(cells_of(spark.range(1, 1001))),
        lambda: price_plan.price_anomaly_services(raw),
        lambda: price_plan.price_anomaly_df_services(raw),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for report in reports:
            plan = report()._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort [" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_class_with_most_cells_is_split_in_the_lookup_of_averages(spark):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        report = price_plan.price_anomaly_of_cells(cells_of(spark.range(1, 20001)))
        rows = [r for r in report.collect() if r["feature"] == "passenger_count"]
        plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for key in small:
            spark.conf.unset(key)
    counts = {}
    for r in rows:
        counts[r["value"]] = counts.get(r["value"], 0) + r["count"]
    assert counts == {None: 19960, "1.0": 40}
    assert "ShuffledHashJoin(skew=true)" in plan
