"""Columns derived from the time of an accident."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display names in the order of ``dayofweek`` (1 = Sunday).
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
SHORT_DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

# First and last hour of each named band; every other hour is Night.
TIME_BANDS = {"Morning Rush": (6, 9), "Midday": (10, 15), "Evening Rush": (16, 19)}
NIGHT = "Night"
RUSH_HOURS = ((7, 9), (16, 18))
RUSH, OFF_PEAK = "Rush Hour", "Off Peak"


def moment(time: dt.datetime) -> Column:
    """A zone-less literal; ``lit`` of a datetime would read it in the session time zone."""
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def lenient_timestamp(text: Column) -> Column:
    """Parse a zone-less timestamp; text that is no timestamp becomes null."""
    return text.try_cast("timestamp_ntz")


def hour_of_day(time: Column) -> Column:
    return F.hour(time)


def month_of_year(time: Column) -> Column:
    return F.month(time)


def calendar_year(time: Column) -> Column:
    return F.year(time)


def weekday_from_sunday(time: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(time)


def weekday_from_monday(time: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(time)


def weekday_from_sunday_zero(time: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(time) - 1


def weekday_name(time: Column, short: bool = False) -> Column:
    names = F.array(*[F.lit(n) for n in (SHORT_DAY_NAMES if short else DAY_NAMES)])
    # element_at() declares its result non-null here and would turn a null day into a name.
    return F.when(time.isNotNull(), F.element_at(names, F.dayofweek(time)))


def time_band(time: Column) -> Column:
    """Name of the time-of-day band; a null time falls to Night."""
    hour = F.hour(time)
    first, *others = TIME_BANDS
    band = F.when(hour.between(*TIME_BANDS[first]), F.lit(first))
    for name in others:
        band = band.when(hour.between(*TIME_BANDS[name]), F.lit(name))
    return band.otherwise(F.lit(NIGHT))


def rush_period(time: Column) -> Column:
    """Rush Hour or Off Peak; a null time falls to Off Peak."""
    hour = F.hour(time)
    (a, b), (c, d) = RUSH_HOURS
    return F.when(hour.between(a, b) | hour.between(c, d), F.lit(RUSH)).otherwise(F.lit(OFF_PEAK))


def epoch_seconds(time: Column) -> Column:
    """Whole seconds from 1970-01-01 on the clock the time was read from, in any session time zone."""
    days = F.unix_date(F.to_date(time)).cast("bigint")
    return days * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def as_instant(time: Column) -> Column:
    """The TIMESTAMP, to the second, that reads the same in UTC; a cast would depend on the session time zone."""
    return F.timestamp_seconds(epoch_seconds(time))


def from_instant(instant: Column) -> Column:
    """The zone-less time that ``as_instant`` came from."""
    return moment(dt.datetime(1970, 1, 1)) + F.make_dt_interval(secs=F.unix_seconds(instant))
