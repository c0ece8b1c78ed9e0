"""Fixed values that results depend on: names, labels, column maps and the holiday list."""

# --- fixed values: incident feed ---------------------------------------------------------
# Feed columns that are not kept.
FEED_DROPPED = [
    ":@computed_region_awaf_s7ux",
    ":@computed_region_6mkv_f3dw",
    ":@computed_region_vrxf_vc4k",
    ":@computed_region_bdys_3d7i",
    ":@computed_region_43wa_7qmu",
    ":@computed_region_rpca_8um6",
    "location.latitude",
    "location.longitude",
    "location.human_address",
]

# Feed columns that are kept under another name ("decsription" is how the feed spells it).
FEED_RENAMED = {
    ":id": "crime_id",
    ":created_at": "created_at",
    ":updated_at": "updated_at",
    ":version": "version",
    "case_": "case",
    "_iucr": "iucr",
    "_primary_decsription": "primary_description",
    "_secondary_description": "secondary_description",
    "_location_description": "location_description",
}

# --- fixed values: hours of the day -------------------------------------------------------
# (first hour, hour after the last, label); a missing time gets TIME_OF_DAY_MISSING.
TIME_OF_DAY = [
    (0, 6, "night"),
    (6, 12, "morning"),
    (12, 18, "afternoon"),
    (18, 24, "evening"),
]
TIME_OF_DAY_MISSING = "unknown"

# --- fixed values: run settings -----------------------------------------------------------
CALENDAR_BEGIN = "2023-01-01"
CALENDAR_END = "2024-12-31"
BACKFILL_DAYS = 7
PAGE_ROWS = 1000
WRITE_BATCH_ROWS = 1000
POLL_INTERVAL = "30 minutes"
RUN_STATUSES = ("start", "success", "fail")

# --- fixed values: words a CSV cell may hold for "missing" --------------------------------
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: city holidays of 2023 and 2024 (name, observed date) -------------------
HOLIDAYS = [
    ("New Year's Day", "Monday, January 2, 2023"),
    ("Dr. Martin Luther King Jr.'s Birthday", "Monday, January 16, 2023"),
    ("Lincoln's Birthday", "Monday, February 13, 2023"),
    ("Washington's Birthday", "Monday, February 20, 2023"),
    ("Pulaski Day", "Monday, March 6, 2023"),
    ("Memorial Day", "Monday, May 29, 2023"),
    ("Juneteenth Day", "Monday, June 19, 2023"),
    ("Independence Day", "Tuesday, July 4, 2023"),
    ("Labor Day", "Monday, September 4, 2023"),
    ("Columbus Day", "Monday, October 9, 2023"),
    ("Veterans Day", "Friday, November 10, 2023"),
    ("Thanksgiving Day", "Thursday, November 23, 2023"),
    ("Christmas Day", "Monday, December 25, 2023"),
    ("New Year's Day", "Monday, January 1, 2024"),
    ("Dr. Martin Luther King Jr.'s Birthday", "Monday, January 15, 2024"),
    ("Lincoln's Birthday", "Monday, February 12, 2024"),
    ("Washington's Birthday", "Monday, February 19, 2024"),
    ("Pulaski Day", "Monday, March 4, 2024"),
    ("Memorial Day", "Monday, May 27, 2024"),
    ("Juneteenth Day", "Wednesday, June 19, 2024"),
    ("Independence Day", "Thursday, July 4, 2024"),
    ("Labor Day", "Monday, September 2, 2024"),
    ("Columbus Day", "Monday, October 14, 2024"),
    ("Veterans Day", "Monday, November 11, 2024"),
    ("Thanksgiving Day", "Thursday, November 28, 2024"),
    ("Christmas Day", "Wednesday, December 25, 2024"),
]
