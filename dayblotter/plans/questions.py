"""Short questions on the views, each answered with counts, greatest first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayblotter.functions import dates, numbers
from dayblotter.operators.ranking import count_by, most_first
from dayblotter.plans.views import OCCURRED, TYPE, daily_counts


def _days_with_counts(incidents: DataFrame, calendar: DataFrame, how: str = "left") -> DataFrame:
    return daily_counts(incidents).join(calendar, "date", how)


def busiest_weekday(incidents: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        _days_with_counts(incidents, calendar)
        .groupBy("day_of_week", "day_of_week_name")
        .agg(F.sum("n").alias("crimes"))
        .orderBy(*most_first("crimes", "day_of_week"))
    )


def busiest_month(incidents: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        _days_with_counts(incidents, calendar)
        .groupBy("month", "month_name")
        .agg(F.sum("n").alias("crimes"))
        .orderBy(*most_first("crimes", "month"))
    )


def busiest_time_of_day(incidents: DataFrame) -> DataFrame:
    label = dates.time_of_day(F.col(OCCURRED)).alias("time_of_day")
    return count_by(incidents, [label], "crime_id", "crimes").orderBy(*most_first("crimes", "time_of_day"))


def holidays_by_count(incidents: DataFrame, calendar: DataFrame) -> DataFrame:
    holidays = calendar.where(F.col("holiday_name").isNotNull())
    return (
        _days_with_counts(incidents, holidays, "inner")
        .groupBy("holiday_name")
        .agg(F.sum("n").alias("crimes"))
        .orderBy(*most_first("crimes", "holiday_name"))
    )


def beats_by_type(incidents: DataFrame, types: Sequence[str]) -> DataFrame:
    """Beats by incidents of the given types; which types are violent is the caller's to say."""
    chosen = incidents.where(F.col(TYPE).isin(*types))
    return count_by(chosen, ["beat"], "crime_id", "crimes").orderBy(*most_first("crimes", "beat"))


def districts_by_type(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    counts = count_by(
        incidents, [numbers.hundreds(F.col("beat")).alias("_hundreds"), TYPE], "crime_id", "crimes"
    ).withColumn("district", F.col("_hundreds").cast("string"))
    return (
        stations.select("district", "district_name")
        .join(counts, "district")
        .select("district", "district_name", TYPE, "crimes")
        .orderBy(F.col("crimes").desc(), "district", TYPE)
    )
