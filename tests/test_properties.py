"""Properties that hold for any input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rideframe.catalog import fixtures as fx
from rideframe.functions import bins, dates, labels, zones
from rideframe.operators import compare, impact, profile
from rideframe.plans import price_anomaly as price_plan
from rideframe.spec import ZONES

SF_DIR = "/root/testdata/sf0.001"


def random_trips(n, seed=7):
    draw = random.Random(seed)
    first = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        start = first + dt.timedelta(milliseconds=draw.randrange(60 * 86_400_000))
        length = draw.choice([3_600_000, 86_400_000, 5 * 86_400_000])
        rows.append((start, start + dt.timedelta(milliseconds=draw.randrange(length))))
    return rows


def brute_force(start, end, zone, gap_s=0):
    """Minutes in a zone, day by day, each piece at four decimals."""
    total, day = 0, dt.datetime.combine(start.date(), dt.time())
    while day <= end:
        if zone.start_hour > zone.end_hour:
            pieces = [(zone.start_hour * 3600, 86400 - gap_s), (0, zone.end_hour * 3600)]
        else:
            pieces = [(zone.start_hour * 3600, zone.end_hour * 3600)]
        for low, high in pieces:
            a = max(start, day + dt.timedelta(seconds=low))
            b = min(end, day + dt.timedelta(seconds=high))
            ms = max(0, (b - a) // dt.timedelta(milliseconds=1))
            total += (ms + 3) // 6
        day += dt.timedelta(days=1)
    return total / 10000


@pytest.mark.parametrize("gap", [0, 1])
def test_zone_minutes_equal_a_day_by_day_count(spark, gap):
    rows = random_trips(2000)
    df = spark.createDataFrame(rows, "p timestamp_ntz, d timestamp_ntz")
    minutes = [
        zones.zone_minutes(F.col("p"), F.col("d"), z, midnight_gap_s=gap).alias(z.name) for z in ZONES
    ]
    for row in df.select("p", "d", *minutes).collect():
        for zone in ZONES:
            assert row[zone.name] == brute_force(row["p"], row["d"], zone, gap)


def test_zones_cover_the_whole_trip(spark):
    df = spark.createDataFrame(random_trips(2000, 8), "p timestamp_ntz, d timestamp_ntz")
    covered = sum(zones.zone_minutes(F.col("p"), F.col("d"), z) for z in ZONES)
    gap = F.abs(covered - dates.duration_minutes(F.col("p"), F.col("d")))
    # Each daily piece is rounded, half a unit at most.
    assert df.agg(F.max(gap)).first()[0] < 20 * 0.00005


def test_step_label_holds_its_value(spark):
    df = spark.range(20000).select(((F.rand(3) - 0.5) * 2000).alias("x"))
    label = bins.bin_step(F.col("x"), 5)
    low = labels.lower_bound(label)
    assert df.filter((F.col("x") < low) | (F.col("x") >= low + 5)).count() == 0


def test_profile_counts_every_row_once_per_feature(spark):
    raw = fx.raw_trips(spark, SF_DIR, "yellow")
    trips = price_plan.clean_price_trips(raw, "yellow", fx.FIRST_YEAR, fx.LAST_YEAR)
    report = price_plan.price_anomaly(raw, "yellow", fx.FIRST_YEAR, fx.LAST_YEAR)
    sums = report.groupBy("feature").agg(F.sum("count").alias("n"), F.sum("pcg").alias("p")).collect()
    rows = trips.count()
    assert len(sums) == 8
    # A class with an average price of zero would lose its trips; there is none here.
    assert {r["n"] for r in sums} == {rows}
    assert all(abs(r["p"] - 100) < 0.5 for r in sums)


def test_coarse_shares_sum_to_a_hundred(spark):
    raw = fx.raw_trips(spark, SF_DIR, "green")
    report = price_plan.price_anomaly(raw, "green", fx.FIRST_YEAR, fx.LAST_YEAR)
    shares = profile.share_within_value(report)
    sums = shares.groupBy("feature", "value", "metric").agg(F.sum("pcg").alias("p"))
    assert sums.filter(F.abs(F.col("p") - 100) > 1e-3).count() == 0


def test_differences_change_sign_with_their_sides(spark):
    tips = spark.createDataFrame(
        [("f", "a", 1.5), ("f", "b", 4.0), ("g", "c", 2.0)],
        "feature_type string, bin string, avg_tip_pct double",
    )
    diffs = {(r["binA"], r["binB"]): r["diff"] for r in compare.same_feature_diff(tips).collect()}
    assert len(diffs) == 5
    assert all(diffs[a, b] == -diffs[b, a] for a, b in diffs)
    pairs = compare.pairwise_bin_diff(tips, ["f", "g"]).collect()
    assert {(r["binA"], r["binB"], r["diff"]) for r in pairs} == {("a", "c", -0.5), ("b", "c", 2.0)}


def test_averages_do_not_depend_on_the_partitioning(spark):
    trips = impact.enrich_trips(
        fx.trips(spark, SF_DIR)
        .filter("dropoff_datetime > pickup_datetime")
        .withColumn(
            "trip_duration_min",
            dates.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"), "exact"),
        )
    )
    one, many = (impact.monthly_pattern(trips.repartition(n)).collect() for n in (1, 7))
    assert one == many
