"""Hand-worked rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rideframe.functions import bins, dates, labels, money, rounding, weather, zones
from rideframe.operators import binning, classes, clean, impact, quantiles
from rideframe.spec import TIP_BINS, ZONES, BinSpec, ZoneSpec


def values(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return [row.asDict() for row in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def one(spark, values_in, schema, column):
    rows = [(v,) for v in values_in]
    return [r["out"] for r in values(spark, rows, schema, out=column)]


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_step_labels(spark):
    given = [-10.0, -7.5, -5.0, -0.3, 0.0, 4.99, 5.0, 12.3, float("nan"), None]
    labels_out = one(spark, given, "x double", bins.bin_step(F.col("x")))
    assert labels_out == [
        "[-10|-5)", "[-10|-5)", "[-5|0)", "[-5|0)", "[0|5)", "[0|5)", "[5|10)", "[10|15)", None, None,
    ]
    assert one(spark, [-7.5, -3.0, 3.0, 7.5], "x double", bins.bin_step_value(F.col("x"))) == [-5, 0, 0, 5]


def test_threshold_bins(spark):
    spec = BinSpec((1.0, 3.0, 6.0), ("0-1", "1-3", "3-6", "6+"))
    given = [0.99, 1.0, 2.99, 3.0, 6.0, None, float("nan"), float("inf")]
    out = one(spark, given, "x double", bins.bin_thresholds(F.col("x"), spec))
    assert out == ["0-1", "1-3", "1-3", "3-6", "6+", "6+", "6+", "6+"]


def test_bin_spec_checks_its_labels():
    with pytest.raises(ValueError):
        BinSpec((1.0, 2.0), ("a", "b"))
    with pytest.raises(ValueError):
        BinSpec((2.0, 1.0), ("a", "b", "c"))
    with pytest.raises(ValueError):
        ZoneSpec("none", 24, 6)


TRIPS = [
    ("2024-03-05T23:50:00", "2024-03-06T00:10:00", 20.0, 0.0, 19.9833),
    ("2024-03-05T19:50:00", "2024-03-05T20:10:00", 10.0, 10.0, 10.0),
    ("2024-03-05T05:00:00", "2024-03-06T11:00:00", 660.0, 1140.0, 659.9833),
    ("2024-03-05T12:00:00", "2024-03-08T12:00:00", 1800.0, 2520.0, 1799.9499),
    ("2024-03-05T12:00:00", "2024-03-05T11:00:00", 0.0, 0.0, 0.0),
]


def test_zone_minutes(spark):
    start, end = F.col("p"), F.col("d")
    rows = values(
        spark,
        [(ts(p), ts(d)) for p, d, *_ in TRIPS],
        "p timestamp_ntz, d timestamp_ntz",
        overnight=zones.zone_minutes(start, end, ZONES[0]),
        regular=zones.zone_minutes(start, end, ZONES[1]),
        gap=zones.zone_minutes(start, end, ZONES[0], midnight_gap_s=1),
    )
    for row, (_, _, overnight, regular, gap) in zip(rows, TRIPS):
        assert (row["overnight"], row["regular"]) == (overnight, regular)
        assert row["gap"] == pytest.approx(gap, abs=1e-9)


def test_zone_share_of_truncated_minutes(spark):
    minutes = zones.zone_minutes(F.col("p"), F.col("d"), ZONES[0], "minute_trunc", 1)
    [row] = values(
        spark,
        [(ts("2024-03-05T22:00:00"), ts("2024-03-05T22:10:30"))],
        "p timestamp_ntz, d timestamp_ntz",
        share=zones.zone_share(minutes, F.lit(10.5), 2),
    )
    assert row["share"] == 95.24


def test_holidays_and_weekends(spark):
    free = ["2024-01-01", "2024-07-04", "2024-12-25", "2024-09-02", "2024-11-28", "2024-03-09", "2024-03-10"]
    busy = ["2024-03-08", "2024-11-21", "2024-09-09", "2024-05-27"]
    stamps = [ts(day + "T08:00:00") for day in free + busy]
    out = one(spark, stamps, "x timestamp_ntz", dates.holiday_or_weekend(F.col("x")))
    assert out == [True] * len(free) + [False] * len(busy)
    surcharge = one(spark, stamps, "x timestamp_ntz", dates.weekday_surcharge(F.col("x")))
    assert surcharge == [0.0] * len(free) + [2.5] * len(busy)


def test_weekend_forms(spark):
    saturday = [ts("2024-03-09T10:00:00")]
    assert one(spark, saturday, "x timestamp_ntz", dates.weekend(F.col("x"))) == [1]
    assert one(spark, saturday, "x timestamp_ntz", dates.weekend(F.col("x"), "aligned")) == [0]


def test_timestamps_and_durations(spark):
    texts = [" 2024-03-09T10:20:30 ", "2024-03-09T10:20", "2024-03-09 10:20", "x", None]
    out = one(spark, texts, "x string", dates.parse_timestamp(F.col("x")))
    assert out == [ts("2024-03-09T10:20:30"), ts("2024-03-09T10:20:00"), None, None, None]
    [row] = values(
        spark,
        [(ts("2024-03-09T23:59:59.900000"), ts("2024-03-10T00:01:40.250000"))],
        "p timestamp_ntz, d timestamp_ntz",
        millis=dates.duration_minutes(F.col("p"), F.col("d")),
        seconds=dates.duration_minutes(F.col("p"), F.col("d"), "seconds"),
        exact=dates.duration_minutes(F.col("p"), F.col("d"), "exact"),
    )
    assert row == {"millis": 1.6725, "seconds": 1.68, "exact": 101 / 60}


def test_fees(spark):
    fees = [F.col(c) for c in "abcde"]
    [row] = values(
        spark,
        [(0.5, 0.5, 1.0, 2.5, 0.0)],
        "a double, b double, c double, d double, e double",
        plain=money.fee_total(fees),
        distinct=money.fee_total(fees, distinct=True),
    )
    assert row == {"plain": 4.5, "distinct": 4.0}


def test_rounding(spark):
    assert one(spark, [0.285, 1.005, 2.675], "x double", rounding.half_up(F.col("x"), 2)) == [0.29, 1.01, 2.68]
    assert one(spark, [1.005], "x double", rounding.half_up_binary(F.col("x"), 2)) == [1.0]


def test_division_by_zero_gives_null_or_zero(spark):
    row = values(
        spark,
        [(1.0, 0.0)],
        "a double, b double",
        price=money.unit_price(F.col("a"), F.col("b")),
        tip=money.tip_percentage(F.col("a"), F.col("b")),
        tip_null=money.tip_percentage(F.col("a"), F.col("b"), None),
        deviation=money.price_deviation_pct(F.col("a"), F.col("b")),
        speed=money.speed_mph(F.col("a"), F.col("b")),
        share=zones.zone_share(F.col("a"), F.col("b")),
    )[0]
    assert row == {
        "price": None, "tip": 0.0, "tip_null": None, "deviation": None, "speed": 0.0, "share": None,
    }


def test_weather_classes(spark):
    codes = [0, 4, 48, 50, 67, 70, 77, 80, 99, 5, 49, 68, 79]
    names = ["clear", "cloudy", "foggy", "rainy", "rainy", "snowy", "snowy", "stormy", "stormy"]
    assert one(spark, codes, "x int", weather.weather_class(F.col("x"))) == names + ["unknown"] * 4


def test_label_functions(spark):
    given = ["[-15|-10)", "[5|10)", "[100|105)", "abc", "", None]
    assert one(spark, given, "x string", labels.coarsen_label(F.col("x"))) == [
        "[-20|-10)", "[0|10)", ">= 100", "unknown", None, None,
    ]
    assert one(spark, ["[-5|0)", ">= 100", "<0", "abc"], "x string", labels.sort_key(F.col("x"))) == [
        -5.0, 1e6, -1e6, None,
    ]
    assert one(spark, ["[-5|0)", "[5|10)"], "x string", labels.midpoint(F.col("x"))) == [-2.5, 7.5]
    assert one(spark, ["[-5|0)"], "x string", labels.midpoint(F.col("x"), signed=False)) == [None]
    keys = one(spark, ["10-20", "none", None], "x string", labels.descending_key(F.col("x")))
    assert keys == [-10.0, 0.0, float("-inf")]


def test_feature_key_splits_at_the_first_underscore(spark):
    feature, label = labels.split_feature_key(F.col("x"))
    [row] = values(spark, [("tripDistanceBin_0-1_late",)], "x string", feature=feature, label=label)
    assert row == {"feature": "tripDistanceBin", "label": "0-1_late"}


def test_class_key_text(spark):
    key = labels.class_key(F.col("a"), F.col("b"), F.col("c"))
    [row] = values(spark, [(1.0, "N", 2024)], "a double, b string, c int", key=key)
    assert row == {"key": "1.0_N_2024"}


def test_exact_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")
    points = [0.0, 0.3, 0.5, 0.91, 1.0]
    assert quantiles.exact_quantiles(df, {"x": points})["x"] == [1.0, 3.0, 5.0, 10.0, 10.0]
    floor = quantiles.exact_quantiles(df, {"x": [0.5, 1.0]}, "floor")["x"]
    assert floor == [6.0, 1.0]


def test_exact_quantiles_of_skewed_values(spark):
    """One value holds most rows, others are far apart; null and NaN do not count."""
    raw = [0.0] * 500 + [1e-9, 1e-6, 1.0, 1e9] * 50 + [math.nan] * 7 + [None] * 7
    df = spark.createDataFrame([(v, 3.0) for v in raw], "x double, c double")
    points = [i / 20 for i in range(21)]
    found = quantiles.exact_quantiles(df, {"x": points, "c": [0.5]})
    real = sorted(v for v in raw if v is not None and not math.isnan(v))
    ranks = [max(1, math.ceil(round(q * len(real), 6))) for q in points]
    assert found["x"] == [real[r - 1] for r in ranks]
    assert found["c"] == [3.0]


def test_quantile_bins_of_a_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    splits = binning.quantile_splits(df, {"x": 10})
    rows = binning.with_quantile_bin(df, "x", splits["x"]).collect()
    assert {(r["x_bin"], r["x_bin_label"]) for r in rows} == {(0.0, "[2.0|2.0)")}


def test_quantile_bins_are_closed_at_the_end(spark):
    out = one(spark, [0.0, 1.0, 2.0, 3.0, None], "x double", bins.bucket_index(F.col("x"), [0.0, 1.0, 2.0]))
    assert out == [0.0, 1.0, 1.0, None, None]


def test_feature_ranges_reject_what_is_no_number(spark):
    rows = [("1", 1.0), ("0.9", 1.0), ("2.5", 1.0), ("1e3", 1.0), ("x", 1.0), ("3", math.nan)]
    df = spark.createDataFrame(rows, "passenger_count string, trip_distance double")
    kept = [r["passenger_count"] for r in clean.filter_feature_ranges(df).collect()]
    assert kept == ["1", "2.5"]


def test_null_and_nan_are_dropped_apart(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "x double")
    assert clean.drop_incomplete(df).count() == 2
    assert clean.drop_incomplete_nan(df).count() == 1


def test_class_of_one_deviates_by_zero(spark):
    rows = [("a", 1.11, 2.0), ("b", 1.0, 1.0), ("b", 3.0, 2.0), ("z", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, cost_per_distance double, cost_per_time double")
    averages = classes.class_averages(df, ["k"])
    joined = classes.with_price_deviation(classes.attach_class_averages(df, averages, ["k"]))
    out = {(r["k"], r["cost_per_distance"]): r["cost_per_distance_diff_pcg"] for r in joined.collect()}
    assert out == {("a", 1.11): 0.0, ("b", 1.0): -50.0, ("b", 3.0): 50.0}


def test_hot_class_collapses_into_few_cells(spark):
    """Half of the trips share one class and price; the weighted averages stay exact."""
    hot = spark.range(20000).selectExpr("'hot' as k", "2.5D as cost_per_distance", "0.5D as cost_per_time")
    rest = spark.range(20000).selectExpr(
        "concat('k', id % 50) as k",
        "(id % 700) / 100D as cost_per_distance",
        "(id % 300 + 1) / 100D as cost_per_time",
    )
    trips = hot.unionByName(rest)
    cells = classes.price_cells(trips, ["k"])
    assert cells.filter("k = 'hot'").count() == 1
    plain = classes.class_averages(trips, ["k"]).orderBy("k").collect()
    assert plain == classes.class_averages(cells, ["k"], weight="n_trips").orderBy("k").collect()
    assert len(plain) == 51


def test_left_join_matches_null_classes(spark):
    rows = [(None, 1.0, 2.0), ("b", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, cost_per_distance double, cost_per_time double")
    averages = classes.class_averages(df, ["k"], 2, positive_only=False)
    null_safe = classes.attach_class_averages(df, averages, ["k"], "left")
    assert null_safe.filter("avg_cost_per_time is null").count() == 0
    plain = classes.attach_class_averages(df, averages, ["k"], "left", null_safe=False)
    assert plain.filter("avg_cost_per_time is null").count() == 1


def test_change_against_the_first_bin(spark):
    rows = [("0-1", "morning", 2.0, 1), ("1-3", "morning", 3.0, 1), ("6+", "night", 5.0, 1)]
    df = spark.createDataFrame(rows, "d string, h string, avg_tip double, count_trips bigint")
    orders = {"d": TIP_BINS["trip_distance"].labels, "h": ("morning", "night")}
    out = {
        (r["feature"], r["others"], r["bin"]): r["change_pct"]
        for r in impact.impact_vs_first_bin(df, orders).collect()
    }
    assert out["d", "morning", "1-3"] == 50.0
    assert out["d", "morning", "0-1"] == 0.0
    assert out["d", "night", "6+"] == 0.0


def test_merged_value_bins_on_a_narrow_range(spark):
    rows = [("f", f"[{i}|{i + 1})", "[0|5)", "[0|5)", 1) for i in range(-8, 9)]
    rows += [("g", str(i), "[0|5)", "[0|5)", 1) for i in range(20)]
    df = spark.createDataFrame(
        rows, "feature string, value string, cost_distance_label string, cost_time_label string, count bigint"
    )
    merged = binning.merge_value_bins(df, max_values=15)
    out = {(r["feature"], r["value"]): r["count"] for r in merged.collect()}
    assert sum(n for (f, _), n in out.items() if f == "f") == 17
    assert len([1 for f, _ in out if f == "f"]) == 15
    assert ("f", ">=8") in out and ("f", "[-8|-6)") in out
    assert sum(1 for f, _ in out if f == "g") == 20


def test_rounding_of_doubles_is_that_of_their_text(spark):
    rows = spark.range(200_000).selectExpr(
        "(id - 100000) / 1000D as thousandths", "(id - 100000) / 7D as sevenths", "(id * 7919 % 1000003) / 64D as sixty_fourths"
    )
    odd = [0.0, -0.0, -0.001, 45e12 + 0.005, 4.5e11 + 0.125, 1.005, -1.005, 0.285, 2.675, 1e15 + 0.3, 123456789012.125, -1e300, 1e-9, math.inf, -math.inf, math.nan, None]
    rows = rows.unionAll(spark.createDataFrame([(x, x, x) for x in odd], rows.schema))
    for decimals in (2, 4):
        for name in rows.columns:
            fast, slow = (form(F.col(name), decimals) for form in (rounding.half_up_double, rounding.half_up))
            assert rows.filter(~fast.cast("string").eqNullSafe(slow.cast("string"))).isEmpty(), (name, decimals)
