"""The six views over incidents, calendar, stations and wards.

Each takes frames and returns a frame. Incidents are reduced to counts before anything is joined
to them, except in the two views that return every incident.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayblotter.functions import dates, numbers
from dayblotter.operators import ranking

OCCURRED = "date_of_occurrence"
TYPE = "primary_description"


def incident_calendar(
    incidents: DataFrame, calendar: DataFrame, weekday_as_month_name: bool = False
) -> DataFrame:
    """Every incident with the attributes of its day, NULL outside the calendar.

    `weekday_as_month_name` gives the older shape of this view, in which the column month_name
    holds the name of the weekday and day_of_week_name is absent.
    """
    if weekday_as_month_name:
        names = [F.col("day_of_week_name").alias("month_name")]
    else:
        names = [F.col("day_of_week_name"), F.col("month_name")]
    return incidents.join(calendar, F.to_date(OCCURRED) == calendar["date"], "left").select(
        *[incidents[name] for name in incidents.columns],
        "year",
        "day",
        "month",
        *names,
        "day_of_week",
        "holiday_name",
    )


def incident_time_of_day(incidents: DataFrame) -> DataFrame:
    """Every incident with the part of the day it happened in."""
    return incidents.withColumn("time_of_day", dates.time_of_day(F.col(OCCURRED)))


def daily_counts(incidents: DataFrame) -> DataFrame:
    """Incidents per day: all that the calendar questions need to know about incidents."""
    day = F.to_date(OCCURRED).alias("date")
    return ranking.count_by(incidents, [day], "crime_id")


def monthly_growth(incidents: DataFrame, calendar: DataFrame) -> DataFrame:
    """Incidents per month inside the calendar, against the month before that has any."""
    months = (
        daily_counts(incidents)
        .where(F.col("date").isNotNull())
        .join(calendar.select("date", "month", "year"), "date")
        .groupBy(F.col("year").alias("calendar_year"), F.col("month").alias("calendar_month"))
        .agg(F.sum("n").alias("crime_amount"))
    )
    growth = ranking.lag_change(months, ["calendar_year", "calendar_month"], "crime_amount")
    points = numbers.basis_points(F.col("diff"), F.col("prev_crime_amount"))
    return growth.select(
        "calendar_month",
        "calendar_year",
        "crime_amount",
        F.col("prev_crime_amount").alias("prev_month_crime_amount"),
        "diff",
        numbers.percent_text(points).alias("crime_growth"),
        numbers.hundredths(points).cast("double").alias("crime_growth_percent"),
    ).orderBy("calendar_year", "calendar_month")


def holiday_mean(
    incidents: DataFrame, calendar: DataFrame, include_zero_days: bool = False
) -> DataFrame:
    """Mean incidents a day, holidays against other days.

    Days without any incident do not count as 0 unless asked for.
    """
    side = "right" if include_zero_days else "inner"
    per_day = daily_counts(incidents).join(calendar.select("date", "holiday_name"), "date", side)
    flag = F.when(F.col("holiday_name").isNotNull(), "Y").otherwise("N")
    return (
        per_day.groupBy(flag.alias("holiday"))
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("total"), F.count("*").alias("days"))
        .select(
            numbers.rounded_mean(F.col("total"), F.col("days"))
            .cast("double")
            .alias("average_crimes_count"),
            "holiday",
        )
    )


def district_of(beat: Column) -> Column:
    """Stations are keyed by text, which need not be a number."""
    return numbers.hundreds(beat).cast("string")


def station_rank(incidents: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations by share of incidents that led to an arrest.

    One pass counts incidents and arrests together. Stations without an arrest are left out, and
    so are incidents of no station. The ratio is ranked from the top, the two totals from the
    bottom; ratios are equal when they agree to a hundredth of a percent, cut off.
    """
    arrested = F.when(F.col("arrest") == "Y", F.col("crime_id"))
    totals = (
        incidents.groupBy(numbers.hundreds(F.col("beat")).alias("_hundreds"))
        .agg(F.count(arrested).alias("total_arrests"), F.count("crime_id").alias("total_crimes"))
        .where(F.col("total_arrests") > 0)
        .select(F.col("_hundreds").cast("string").alias("district"), "total_arrests", "total_crimes")
    )
    arrests, crimes = F.col("total_arrests"), F.col("total_crimes")
    share = numbers.truncated_quotient(F.lit(10000) * arrests, crimes)
    points = numbers.basis_points(arrests, crimes)
    return stations.join(totals, "district").select(
        "district",
        "district_name",
        "address",
        "zip",
        "phone",
        "total_arrests",
        "total_crimes",
        numbers.percent_text(points).alias("arrest_percentage"),
        ranking.dense_rank_by(share.desc()).alias("arrest_ratio_rank"),
        ranking.dense_rank_by(arrests.asc()).alias("arrest_total_rank"),
        ranking.dense_rank_by(crimes.asc()).alias("total_crimes_rank"),
    )


def ward_summary(incidents: DataFrame, wards: DataFrame) -> DataFrame:
    """The two leading incident types of every ward, its total, and its place by total."""
    return summarise_wards(ranking.count_by(incidents, ["ward", TYPE], "crime_id"), wards)


def summarise_wards(counts: DataFrame, wards: DataFrame) -> DataFrame:
    """`ward_summary` from incidents already counted into (ward, primary_description, n)."""
    totals = counts.groupBy("ward").agg(F.sum("n").alias("dist_total_crimes"))
    return (
        wards.select("ward", "alderman")
        .join(totals, "ward")
        .join(ranking.top_two(counts, "ward", TYPE, "n"), "ward")
        .select(
            "ward",
            "alderman",
            F.col("first_label").alias("dist_most_popular_crime"),
            F.col("second_label").alias("dist_second_most_popular_crime"),
            "dist_total_crimes",
            ranking.dense_rank_by(F.col("dist_total_crimes").desc()).alias("dist_total_crimes_rank"),
        )
        .orderBy("ward")
    )
