"""Named views: the built-in ones, and any SQL text a user puts in a folder."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from dayblotter.functions.columns import quoted
from dayblotter.plans import views
from dayblotter.session import text_files
from dayblotter.sinks.declare import create_view

# The names of the four tables and of the six views over them.
TABLES = ["crime_data", "date", "police_stations", "ward_offices"]
VIEWS = [
    "crime_data_with_calendar_days_holidays",
    "crime_data_with_time_of_day",
    "crime_growth_by_month",
    "holiday_vs_non_holiday_crimes",
    "police_rank_by_arrest",
    "ward_crimes_summary",
]
_CATALOG_SQL = Path(__file__).parent / "catalog_sql"


def register_views(
    incidents: DataFrame, calendar: DataFrame, stations: DataFrame, wards: DataFrame
) -> dict[str, DataFrame]:
    """The four tables and the six views as temporary views of this session."""
    frames = [
        incidents,
        calendar,
        stations,
        wards,
        views.incident_calendar(incidents, calendar),
        views.incident_time_of_day(incidents),
        views.monthly_growth(incidents, calendar),
        views.holiday_mean(incidents, calendar),
        views.station_rank(incidents, stations),
        views.ward_summary(incidents, wards),
    ]
    named = dict(zip([*TABLES, *VIEWS], frames, strict=True))
    for name, frame in named.items():
        frame.createOrReplaceTempView(name)
    return named


def has_view(spark: SparkSession, name: str) -> bool:
    """Whether there is a table or view of that name, in the catalog or in the session."""
    return spark.catalog.tableExists(name)


def create_catalog_views(spark: SparkSession) -> list[str]:
    """The six views in the catalog, over the four tables, which must be there by name."""
    for name in TABLES:
        spark.catalog.dropTempView(name)
    missing = [name for name in TABLES if not has_view(spark, name)]
    if missing:
        raise ValueError(f"not in the catalog: {missing}")
    for name in VIEWS:
        create_view(spark, name, (_CATALOG_SQL / f"{name}.sql").read_text())
    return list(VIEWS)


def register_sql_folder(spark: SparkSession, folder: str | Path, persist: bool = False) -> list[str]:
    """One view per .sql file, named after the file; a changed file replaces its view.

    The folder may be in any store that Spark reads. Views last for the session; with `persist` they
    go to the catalog, which takes them only over tables it has.
    """
    names = []
    for file, text in text_files(spark, str(folder), ".sql").items():
        name = file.removesuffix(".sql")
        if persist:
            create_view(spark, name, text)
        else:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted(name)} AS {text.strip().rstrip(';')}")
        names.append(name)
    return names
