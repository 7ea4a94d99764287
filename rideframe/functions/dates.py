"""Times, durations and calendar flags. Wall-clock times, so no session time zone is used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rideframe.functions.rounding import half_up_double
from rideframe.spec import HOUR_BUCKETS, RUSH_HOURS, WEEKDAY_SURCHARGE

ISO_MINUTES = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?$"


def parse_timestamp(text: Column) -> Column:
    """ISO text with optional seconds to a timestamp; null if the text has another form."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(ISO_MINUTES), trimmed.try_cast("timestamp_ntz"))


def millis_between(start: Column, end: Column) -> Column:
    """Milliseconds from start to end, sub-millisecond parts cut off.

    The difference is an interval; a thousand of it, in seconds, is its milliseconds.
    """
    return ((end - start) * 1000).cast("interval second").cast("bigint")


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Seconds between two times, each taken at its whole second."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    return days * 86400 + second_of_day(end) - second_of_day(start)


def midnight(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def millis_of_day(ts: Column) -> Column:
    return millis_between(midnight(ts), ts)


def minutes_of_millis(millis: Column, decimals: int = 4) -> Column:
    """Milliseconds as minutes, rounded half up without decimal arithmetic.

    The divisor is a whole number for up to four decimals, so a tie is exact in a double.
    """
    units = F.abs(millis) / (60000.0 / 10**decimals)
    return F.signum(millis) * F.floor(units + 0.5) / float(10**decimals)


def duration_minutes(pickup: Column, dropoff: Column, form: str = "millis") -> Column:
    """Trip duration in minutes.

    ``millis``: from milliseconds, 4 decimals. ``seconds``: from whole seconds, 2
    decimals. ``exact``: from whole seconds, not rounded. ``exact_millis``: from
    milliseconds, not rounded.
    """
    if form == "millis":
        return minutes_of_millis(millis_between(pickup, dropoff), 4)
    if form == "seconds":
        return half_up_double(whole_seconds_between(pickup, dropoff) / 60.0, 2)
    if form == "exact":
        return whole_seconds_between(pickup, dropoff) / 60.0
    if form == "exact_millis":
        return millis_between(pickup, dropoff) / 60000.0
    raise ValueError(f"unknown duration form {form!r}")


def weekend(ts: Column, form: str = "weekday") -> Column:
    """1 on weekends. ``aligned`` counts days in weeks that start on the first of the month."""
    if form == "weekday":
        flag = F.weekday(ts) >= 5
    elif form == "aligned":
        flag = ((F.dayofmonth(ts) - 1) % 7 + 1).isin(6, 7)
    else:
        raise ValueError(f"unknown weekend form {form!r}")
    return flag.cast("int")


def holiday_or_weekend(ts: Column) -> Column:
    """Saturdays, Sundays and five holidays of the United States.

    Fixed values: 1 January, 4 July, 25 December, the first Monday of September and the
    fourth Thursday of November.
    """
    month, day, weekday = F.month(ts), F.dayofmonth(ts), F.weekday(ts)
    fixed_day = (month * 100 + day).isin(101, 704, 1225)
    labor_day = (month == 9) & (weekday == 0) & (day <= 7)
    thanksgiving = (month == 11) & (weekday == 3) & day.between(22, 28)
    return fixed_day | labor_day | thanksgiving | (weekday >= 5)


def weekday_surcharge(ts: Column, amount: float = WEEKDAY_SURCHARGE) -> Column:
    return F.when(holiday_or_weekend(ts), F.lit(0.0)).otherwise(F.lit(float(amount)))


def hour_bucket(hour: Column) -> Column:
    first, last, name = HOUR_BUCKETS[0]
    bucket = F.when(hour.between(first, last), name)
    for first, last, name in HOUR_BUCKETS[1:]:
        bucket = bucket.when(hour.between(first, last), name)
    return bucket.otherwise("night")


def rush_hour(hour: Column) -> Column:
    return hour.isin(*RUSH_HOURS).cast("int")
