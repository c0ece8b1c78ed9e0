"""Date and time expressions. All of them give the same answer in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayblotter.fixed_values import TIME_OF_DAY, TIME_OF_DAY_MISSING


def month_label(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def weekday_label(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def weekday_number(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def parse_long_date(text: Column) -> Column:
    """'Monday, January 2, 2023' -> date. The weekday is cut off: Spark formats but never parses it."""
    return F.to_date(F.substring_index(text, ", ", -2), "MMMM d, yyyy")


def long_date_text(date: Column) -> Column:
    return F.date_format(date, "EEEE, MMMM d, yyyy")


def parse_wall_clock(text: Column) -> Column:
    """ISO text without offset -> timestamp_ntz."""
    return text.cast("timestamp_ntz")


def parse_instant(text: Column) -> Column:
    """ISO text with offset or Z -> timestamp."""
    return text.cast("timestamp")


def millisecond_text(ts: Column) -> Column:
    """ISO text cut (not rounded) to milliseconds, read off the wall clock of a timestamp_ntz."""
    text = ts.cast("timestamp_ntz").cast("string")
    return F.concat(
        F.substring(text, 1, 10),
        F.lit("T"),
        F.substring(text, 12, 8),
        F.lit("."),
        F.rpad(F.substring(text, 21, 3), 3, "0"),
    )


def utc_wall_clock(instant: Column) -> Column:
    """timestamp -> timestamp_ntz reading UTC, counted from the epoch so that no zone is involved."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def time_of_day(ts: Column) -> Column:
    """Label of the six-hour part of the day, 'unknown' when there is no time."""
    hour = F.hour(ts)
    label = F.when(hour.isNull(), TIME_OF_DAY_MISSING)
    for _, after, name in TIME_OF_DAY:
        label = label.when(hour < after, name)
    return label
