"""Minutes in the zones of a calendar table: the closed form, a day-by-day count, odd calendars."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rideframe.functions import zones
from rideframe.operators.zone_calendar import calendar_minutes, zone_marks
from rideframe.session import stage
from rideframe.spec import ZONES

CALENDAR = "zone string, weekday int, start_minute int, end_minute int"
TRIPS = "id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz"
DAY = timedelta(days=1)


def random_trips(n, seed):
    """Trips from milliseconds to weeks long, some within a minute, some backwards, some without a time."""
    draw = random.Random(seed)
    trips = []
    for i in range(n):
        start = datetime(2024, 1, 1) + timedelta(milliseconds=draw.randrange(60 * 86_400_000))
        if draw.random() < 0.2:
            start = start.replace(second=0, microsecond=0)
        longest = draw.choice([1_000, 60_000, 7_200_000, 86_400_000, 30 * 86_400_000])
        end = start + timedelta(milliseconds=draw.randrange(longest) - longest // 20)
        if draw.random() < 0.1:
            end = datetime(end.year, end.month, end.day)
        trips.append((i, start, end))
    return [*trips, (n, None, start), (n + 1, start, None), (n + 2, start, start)]


def by_day(intervals, start, end):
    """Minutes of a zone counted day by day and piece by piece, each rounded to four decimals."""
    if start is None or end is None or end <= start:
        return 0.0
    units, day = 0, datetime(start.year, start.month, start.day)
    while day <= end:
        minutes = {m for w, low, high in intervals if w == day.weekday() for m in range(low, high)}
        pieces = []
        for m in sorted(minutes):
            if pieces and pieces[-1][1] == m:
                pieces[-1][1] = m + 1
            else:
                pieces.append([m, m + 1])
        for low, high in pieces:
            inside = min(end, day + timedelta(minutes=high)) - max(start, day + timedelta(minutes=low))
            units += int(max(inside / timedelta(milliseconds=1), 0) / 6 + 0.5)
        day += DAY
    return units / 10_000


def found(df):
    return {(r["id"], r["zone"]): r["zone_minutes"] for r in df.collect()}


def many_zones(n, seed=5):
    """Ragged zones, whose intervals overlap, touch, repeat and reach midnight."""
    draw = random.Random(seed)
    rows = []
    for z in range(n):
        for weekday in draw.sample(range(7), draw.randint(1, 7)):
            for _ in range(draw.randint(1, 3)):
                low = draw.choice([0, draw.randrange(1440)])
                high = draw.choice([1440, draw.randint(low + 1, 1440)])
                rows.append((f"z{z:02}", weekday, low, high))
                if draw.random() < 0.3 and high < 1440:
                    rows.append((f"z{z:02}", weekday, high, high + 1))
    return rows + rows[:3]


def test_equals_the_closed_form(spark):
    calendar = []
    for zone in ZONES:
        hours = [(zone.start_hour, zone.end_hour)]
        if zone.start_hour > zone.end_hour:
            hours = [(zone.start_hour, 24), (0, zone.end_hour)]
        calendar += [(zone.name, w, 60 * low, 60 * high) for w in range(7) for low, high in hours]
    trips = spark.createDataFrame(random_trips(3000, 1), TRIPS)
    result = calendar_minutes(trips, zone_marks(spark.createDataFrame(calendar, CALENDAR)))
    closed = F.lit(None).cast("double")
    for zone in ZONES:
        minutes = zones.zone_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"), zone)
        closed = F.when(F.col("zone") == zone.name, minutes).otherwise(closed)
    checked = result.withColumn("closed", closed)
    assert checked.count() == 3003 * len(ZONES)
    assert checked.filter(~F.col("zone_minutes").eqNullSafe(F.col("closed"))).collect() == []


def test_fifty_zones_equal_a_count_by_day_in_generated_code(spark):
    rows, trips = many_zones(50), random_trips(60, 2)
    marks = stage(zone_marks(spark.createDataFrame(rows, CALENDAR)), "marks")
    result = calendar_minutes(spark.createDataFrame(trips, TRIPS), marks)
    expected = {
        (i, zone): by_day([r[1:] for r in rows if r[0] == zone], start, end)
        for i, start, end in trips
        for zone in {r[0] for r in rows}
    }
    assert found(result) == expected
    text = result._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    work = re.findall(r"(\*\(\d+\) )?(Generate|Project|BroadcastHashJoin)\b", final)
    assert {name for _, name in work} == {"Generate", "Project", "BroadcastHashJoin"}
    assert all(star for star, name in work)
    assert not re.search(r"CartesianProduct|NestedLoop|Python", final)


def test_shuffled_marks_give_the_same(spark):
    rows, trips = many_zones(3), random_trips(40, 3)
    frames = spark.createDataFrame(trips, TRIPS), spark.createDataFrame(rows, CALENDAR)
    broadcast = found(calendar_minutes(frames[0], zone_marks(frames[1])))
    result = calendar_minutes(frames[0], zone_marks(frames[1]).hint("merge"))
    assert found(result) == broadcast
    assert "SortMergeJoin" in result._jdf.queryExecution().executedPlan().toString()


def test_faulty_intervals_count_for_nothing(spark):
    rows = [
        ("good", 0, 0, 60),
        ("good", 0, 30, 1441),
        ("good", 7, 0, 60),
        ("good", 0, 90, 90),
        ("good", 0, -5, 10),
        ("good", None, 0, 60),
        ("bad", 1, 100, 50),
        ("bad", 1, None, 50),
        (None, 0, 0, 60),
    ]
    monday = datetime(2024, 1, 1)
    trips = spark.createDataFrame([(1, monday, monday + DAY), (1, monday, monday + DAY)], TRIPS)
    result = calendar_minutes(trips, zone_marks(spark.createDataFrame(rows, CALENDAR)))
    assert sorted((r["zone"], r["zone_minutes"]) for r in result.collect()) == [
        ("bad", 0.0), ("bad", 0.0), ("good", 60.0), ("good", 60.0)
    ]


@pytest.mark.parametrize("empty", ["trips", "calendar"])
def test_empty_tables(spark, empty):
    trips = spark.createDataFrame([] if empty == "trips" else random_trips(5, 4), TRIPS)
    marks = zone_marks(spark.createDataFrame([] if empty == "calendar" else many_zones(2), CALENDAR))
    assert calendar_minutes(trips, marks).collect() == []


def test_other_columns_stay_and_clashing_ones_are_replaced(spark):
    monday = datetime(2024, 1, 1)
    trips = spark.createDataFrame(
        [("x", monday, monday + timedelta(hours=2), "old", 3, 4)],
        "zone string, p timestamp_ntz, q timestamp_ntz, Zone_Minutes string, minute int, marks int",
    )
    marks = zone_marks(spark.createDataFrame([("night", 0, 0, 60)], CALENDAR))
    result = calendar_minutes(trips, marks, "p", "q")
    assert result.columns == ["p", "q", "minute", "marks", "zone", "zone_minutes"]
    assert [tuple(r)[2:] for r in result.collect()] == [(3, 4, "night", 60.0)]
