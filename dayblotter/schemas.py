"""Declared tables: Spark schema, key, and the columns that say which of two records is newer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: str) -> T.StructType:
    """'name type, name type' as a schema, without a session to parse it."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


INCIDENTS = struct(
    "crime_id string, created_at timestamp, updated_at timestamp, version string, case string, "
    "date_of_occurrence timestamp_ntz, block string, iucr string, primary_description string, "
    "secondary_description string, location_description string, arrest string, domestic string, "
    "beat int, ward int, fbi_cd string, x_coordinate int, y_coordinate int, "
    "latitude double, longitude double"
)

CALENDAR = struct(
    "date date, day int, month int, month_name string, year int, "
    "day_of_week int, day_of_week_name string, holiday_name string"
)

STATIONS = struct(
    "district string, district_name string, address string, city string, state string, zip int, "
    "website string, phone string, fax string, tty string, x_coordinate double, "
    "y_coordinate double, latitude double, longitude double, location string"
)

WARDS = struct(
    "ward int, alderman string, address string, city string, state string, zipcode string, "
    "ward_phone string, ward_fax string, email string, website string, location string, "
    "city_hall_address string, city_hall_city string, city_hall_state string, "
    "city_hall_zipcode int, city_hall_phone string, photo_link string"
)

RUNS = struct(
    "run_id int, status string, pipeline_name string, timestamp timestamp, "
    "config string, logs string"
)

HOLIDAY_FILE = struct("name string, date string")

# The feed as it arrives: every value is text, coordinates repeat inside `location`.
RAW_FEED = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in [
            ":id", ":created_at", ":updated_at", ":version",
            ":@computed_region_awaf_s7ux", ":@computed_region_6mkv_f3dw",
            ":@computed_region_vrxf_vc4k", ":@computed_region_bdys_3d7i",
            ":@computed_region_43wa_7qmu", ":@computed_region_rpca_8um6",
            "case_", "date_of_occurrence", "block", "_iucr", "_primary_decsription",
            "_secondary_description", "_location_description", "arrest", "domestic", "beat",
            "ward", "fbi_cd", "x_coordinate", "y_coordinate", "latitude", "longitude",
        ]
    ]
    + [
        T.StructField(
            "location",
            struct("latitude string, longitude string, human_address string"),
        )
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """A declared table. Without `buckets` the cluster's shuffle setting decides when it is made.

    Rows of a bucket lie in the order of `laid_out_by`, a time, in row groups of `row_group_bytes`: a window
    of that time then leaves most row groups out.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    newest: tuple[str, ...] = ()
    buckets: int | None = None
    laid_out_by: str | None = None
    row_group_bytes: int = 32 << 20


INCIDENT_TABLE = TableSpec(
    "crime_data", INCIDENTS, ("crime_id",), ("updated_at", "version"), laid_out_by="date_of_occurrence"
)
CALENDAR_TABLE = TableSpec("date", CALENDAR, ("date",))
STATION_TABLE = TableSpec("police_stations", STATIONS, ("district",))
WARD_TABLE = TableSpec("ward_offices", WARDS, ("ward",))
RUN_TABLE = TableSpec("logs", RUNS, ("run_id", "status"), ("timestamp",))
