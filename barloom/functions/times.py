"""Column helpers for time-zone-free UTC timestamps (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NY = "America/New_York"
HOUR = 3600


def ntz(column: Column) -> Column:
    return column.cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", start, end)


def micros_of(column: Column) -> Column:
    """Microseconds since 1970 of a UTC time, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", ntz(F.lit("1970-01-01")), column)


def time_of(micros: Column) -> Column:
    return ntz(F.timestamp_add("MICROSECOND", micros, ntz(F.lit("1970-01-01"))))


def plus_seconds(column: Column, seconds: Column) -> Column:
    return ntz(F.timestamp_add("SECOND", seconds.cast("long"), column))


def plus_hours(column: Column, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return ntz(F.timestamp_add("HOUR", hours.cast("long"), column))


def hour_of(column: Column) -> Column:
    return ntz(F.date_trunc("hour", column))


def new_york(column: Column) -> Column:
    """Local time in New York of a UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(NY), column)


def from_new_york(column: Column) -> Column:
    return F.convert_timezone(F.lit(NY), F.lit("UTC"), column)
