"""Minutes of trips inside the zones of a weekly calendar, given as a table.

A zone is any set of intervals on any weekdays, in whole minutes. The calendar becomes a
table of marks, one row for each of the 10,080 minutes of a week, that holds for every zone
the minutes of the zone before this one, in the week, and the piece of the zone that the
minute lies in. Two look-ups, of the minutes in which a trip starts and ends, then give its
minutes in all zones by subtraction, however long the trip, many the zones or ragged their
intervals: the expressions are the same for two zones and for two thousand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideframe.functions.dates import millis_of_day

MINUTE_MS = 60_000
DAY_MINUTES = 1440
WEEK_MINUTES = 7 * DAY_MINUTES
DAY_MS, WEEK_MS = DAY_MINUTES * MINUTE_MS, WEEK_MINUTES * MINUTE_MS

# Minutes keep four decimals: 10,000 units each, of six milliseconds.
UNITS, UNIT_MS = 10_000, MINUTE_MS / 10_000


def zone_marks(calendar: DataFrame) -> DataFrame:
    """The marks of a calendar: ``minute`` of the week and ``marks``, an array with an entry per zone.

    ``calendar`` has a row per interval: ``zone``, ``weekday`` (0 is Monday), ``start_minute``
    and ``end_minute`` of that day, the end not included, 1440 at most. Intervals of a zone
    may touch, overlap or repeat: minutes count once. A zone over midnight has an interval on
    either day. Intervals that are empty, reach outside their day or hold a null count for
    nothing, but their zone is there, with no minutes; rows without a zone are left out.

    Entries hold zone, ``before`` (its minutes earlier in the week), ``piece`` (a number per
    run of minutes within a day, null outside the zone) and ``total`` (its minutes in a week),
    in the order of the zones' names. 10,080 rows, with some 30 bytes for each zone.
    """
    named = calendar.filter(F.col("zone").isNotNull())
    low, high = F.col("start_minute").cast("int"), F.col("end_minute").cast("int")
    sound = F.col("weekday").between(0, 6) & (low >= 0) & (low < high) & (high <= DAY_MINUTES)
    day = F.col("weekday").cast("int") * DAY_MINUTES
    inside = (
        named.filter(sound)
        .select("zone", F.explode(F.sequence(day + low, day + high - 1)).alias("minute"))
        .distinct()
        .withColumn("hit", F.lit(1))
    )
    week = named.select("zone").distinct().select(
        "zone", F.explode(F.sequence(F.lit(0), F.lit(WEEK_MINUTES - 1))).alias("minute")
    )
    # A window holds the 10,080 minutes of a zone.
    of_zone = Window.partitionBy("zone")
    in_order = of_zone.orderBy("minute")
    flagged = week.join(inside, ["zone", "minute"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    opened = (F.col("hit") == 1) & (
        (F.col("minute") % DAY_MINUTES == 0) | (F.lag("hit", 1, 0).over(in_order) == 0)
    )
    numbered = flagged.select("zone", "minute", "hit", opened.cast("int").alias("opened")).select(
        "minute",
        F.struct(
            "zone",
            (F.sum("hit").over(in_order) - F.col("hit")).alias("before"),
            F.when(F.col("hit") == 1, F.sum("opened").over(in_order)).alias("piece"),
            F.sum("hit").over(of_zone).alias("total"),
        ).alias("mark"),
    )
    return numbered.groupBy("minute").agg(F.array_sort(F.collect_list("mark")).alias("marks"))


def _units(millis: Column) -> Column:
    return F.floor(millis / UNIT_MS + 0.5)


def calendar_minutes(
    trips: DataFrame, marks: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime"
) -> DataFrame:
    """One row per trip and zone: the columns of the trip, ``zone`` and ``zone_minutes``.

    ``marks`` come from ``zone_marks``; write them (``session.stage``) where several tables of
    trips use one calendar. Each daily piece of a zone is rounded to four decimals and then
    added, as in ``functions.zones.zone_minutes``, which this equals for its zones. A trip that
    ends before it starts, or lacks a time, has 0 minutes of every zone. A calendar without
    zones gives no rows. Columns of the trips named ``zone`` or ``zone_minutes`` are replaced.

    Two equal joins on a minute of the week, without a hint: Spark broadcasts the marks if
    they are small and else shuffles, splitting minutes with too many trips. No zone, interval
    or day is a row of its own before the last step.
    """
    kept = [c for c in trips.columns if c.lower() not in ("zone", "zone_minutes")]
    start, end = F.col(pickup), F.col(dropoff)
    first_day, days = F.weekday(start), F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    timed = trips.select(
        *kept,
        (first_day * F.lit(DAY_MS) + millis_of_day(start)).alias("__from"),
        ((first_day + days) * F.lit(DAY_MS) + millis_of_day(end)).alias("__to"),
    ).withColumn("__known", F.coalesce(F.col("__to") > F.col("__from"), F.lit(False)))

    # Trips without minutes are looked up in minute 0, so that they keep their rows.
    def minute(column: str) -> Column:
        of_week = F.floor(F.pmod(F.col(column), F.lit(WEEK_MS)) / MINUTE_MS).cast("int")
        return F.when(F.col("__known"), of_week).otherwise(0)

    keyed = timed.select("*", minute("__from").alias("__first"), minute("__to").alias("__last"))
    first = marks.select(F.col("minute").alias("__first"), F.col("marks").alias("__first_marks"))
    last = marks.select(F.col("minute").alias("__last"), F.col("marks").alias("__last_marks"))
    looked_up = keyed.join(first, "__first").join(last, "__last")
    by_zone = looked_up.select(
        *kept, "__from", "__to", "__known", "__last_marks", F.posexplode("__first_marks").alias("__place", "__a")
    ).withColumn("__b", F.get("__last_marks", F.col("__place")))

    a, b = F.col("__a"), F.col("__b")
    span = F.col("__to") - F.col("__from")
    weeks = F.floor(F.col("__to") / WEEK_MS)
    # Of the minute of the start only its rest counts, of that of the end only its beginning.
    missed = F.when(a["piece"].isNotNull(), UNITS - _units(MINUTE_MS - F.col("__from") % MINUTE_MS)).otherwise(0)
    begun = F.when(b["piece"].isNotNull(), _units(F.col("__to") % MINUTE_MS)).otherwise(0)
    whole = (weeks * a["total"] + b["before"] - a["before"]) * UNITS
    within_one = (weeks == 0) & (a["piece"] == b["piece"])
    units = (
        F.when(~F.col("__known"), F.lit(0))
        .when(within_one, _units(span))
        .otherwise(whole - missed + begun)
    )
    return by_zone.select(*kept, a["zone"].alias("zone"), (units / float(UNITS)).alias("zone_minutes"))
