"""The calendar dimension: a row per day with its names and holiday."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter.fixed_values import HOLIDAYS
from dayblotter.functions import dates
from dayblotter.schemas import CALENDAR


def known_holidays(spark: SparkSession) -> DataFrame:
    """The fixed holidays, as literals so that Spark knows how small they are."""
    rows = [F.struct(F.lit(name).alias("name"), F.lit(date).alias("date")) for name, date in HOLIDAYS]
    raw = spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
    return raw.select(
        dates.parse_long_date(F.col("date")).alias("date"), F.col("name").alias("holiday_name")
    )


def parse_holidays(raw: DataFrame) -> DataFrame:
    """(name, long date text) -> (date, holiday_name).

    A day carries one name, so that joining cannot repeat days; of two names the first in the
    alphabet stays.
    """
    return raw.groupBy(dates.parse_long_date(F.col("date")).alias("date")).agg(
        F.min("name").alias("holiday_name")
    )


def days_between(bounds: DataFrame, begin: str, end: str) -> DataFrame:
    """One row per day from `begin` to `end`, both included. Fails when begin is after end.

    Spark's dates end with the year 9999, so there are at most 3.7 million days, whatever the data.
    """
    every_day = F.sequence(F.to_date(begin), F.to_date(end), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(every_day).alias("date"))


def calendar(days: DataFrame, holidays: DataFrame) -> DataFrame:
    day = F.col("date")
    return (
        days.join(holidays, "date", "left")
        .select(
            day,
            F.day(day).alias("day"),
            F.month(day).alias("month"),
            dates.month_label(day).alias("month_name"),
            F.year(day).alias("year"),
            dates.weekday_number(day).alias("day_of_week"),
            dates.weekday_label(day).alias("day_of_week_name"),
            F.col("holiday_name"),
        )
        .select(*CALENDAR.names)
    )


def calendar_for(spark: SparkSession, begin: str, end: str, holidays: DataFrame) -> DataFrame:
    bounds = spark.range(0, 1, 1, 1).select(F.lit(begin).alias("begin"), F.lit(end).alias("end"))
    return calendar(days_between(bounds, "begin", "end"), holidays)
