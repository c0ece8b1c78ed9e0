"""A whole run over files: dimensions, incidents, views and the record of runs."""

import json

import pytest

from dayblotter.plans.registry import TABLES, VIEWS, has_view, register_sql_folder
from dayblotter.schemas import RAW_FEED, RUNS, TableSpec, struct
from dayblotter.session import new_folder, shared_folder
from dayblotter.sinks.audit import RunLog
from dayblotter.sinks.declare import create_view, declare_table, forget
from dayblotter.sources.feed import LandedFeed
from dayblotter.sources.files import read_pages
from dayblotter.streaming.runs import IncidentStore

from test_sources import record

WARD_HEADER = (
    "WARD,ALDERMAN,ADDRESS,CITY,STATE,ZIPCODE,WARD PHONE,WARD FAX,EMAIL,WEBSITE,LOCATION,CITY HALL ADDRESS,"
    "CITY HALL CITY,CITY HALL STATE,CITY HALL ZIPCODE,CITY HALL PHONE,PHOTO LINK"
)
STATION_HEADER = (
    "DISTRICT,DISTRICT NAME,ADDRESS,CITY,STATE,ZIP,WEBSITE,PHONE,FAX,TTY,X COORDINATE,Y COORDINATE,"
    "LATITUDE,LONGITUDE,LOCATION"
)


@pytest.fixture
def config(tmp_path):
    (tmp_path / "wards.csv").write_text(
        f'{WARD_HEADER}\n9,"Doe, J.",1 St,Town,IL,60601; 60602,1,,e,w,"(1, 2)",a,b,IL,60600,p,l\n'
    )
    (tmp_path / "stations.csv").write_text(
        f'{STATION_HEADER}\n5,Fifth,1 St,Town,IL,60601,w,1,2,3,1,2,41,-87,"(41, -87)"\n'
    )
    (tmp_path / "holidays.csv").write_text('Name,Date\n"Kite Day","Friday, May 2, 2031"\n')
    return {
        "wards_csv": str(tmp_path / "wards.csv"),
        "stations_csv": str(tmp_path / "stations.csv"),
        "holiday_csvs": [str(tmp_path / "holidays.csv")],
        "begin": "2031-05-01",
        "end": "2031-05-31",
    }


def landed(spark, folder, *records):
    folder.mkdir(exist_ok=True)
    (folder / f"page-{len(list(folder.iterdir()))}.json").write_text(json.dumps(records))
    return LandedFeed(read_pages(spark, str(folder), RAW_FEED))


def test_two_runs(spark, tmp_path, config):
    pages = tmp_path / "pages"
    store = IncidentStore(spark, new_folder(spark, "store"), expected_bytes=1)
    feed = landed(spark, pages, record(1, arrest="Y"), record(2, date_of_occurrence="2031-05-05T13:00:00.000"))
    assert store.run(feed, "incidents", config) == "backfill"
    assert spark.table("crime_data").count() == 2
    assert spark.table("police_rank_by_arrest").first().arrest_percentage == "  50.00%"
    assert tuple(spark.table("ward_crimes_summary").first()) == (9, "Doe, J.", "LOST KITE", None, 2, 1)
    assert {tuple(r) for r in spark.table("holiday_vs_non_holiday_crimes").collect()} == {(1.0, "Y"), (1.0, "N")}
    assert has_view(spark, "crime_growth_by_month")
    days = spark.table("crime_data_with_calendar_days_holidays")
    assert len(days.columns) == 27 and days.where("holiday_name = 'Kite Day'").count() == 1
    parts = spark.table("crime_data_with_time_of_day").select("crime_id", "time_of_day").collect()
    assert {tuple(r) for r in parts} == {("row-1", "night"), ("row-2", "afternoon")}

    # Dimensions stay as they are; new and changed incidents come in.
    (tmp_path / "wards.csv").write_text(f"{WARD_HEADER}\n")
    feed = landed(spark, pages, record(2, arrest="Y", **{":updated_at": "2031-05-10T00:00:00.000Z"}))
    assert store.run(feed, "incidents", config) == "changes"
    assert spark.table("ward_offices").count() == 1
    assert spark.table("police_rank_by_arrest").first().arrest_percentage == " 100.00%"
    (tmp_path / "arrests.sql").write_text("select count(*) as n from crime_data where arrest = 'Y'")
    assert store.run(feed, "incidents", config, str(tmp_path)) == "nothing new"
    assert spark.table("arrests").first().n == 2

    log = spark.read.schema(RUNS).parquet(f"{store.root}/logs").orderBy("run_id", "status")
    assert [(r.run_id, r.status, r.logs and r.logs.split(": ")[3].split("\n")[0]) for r in log.collect()] == [
        (1, "start", None), (1, "success", "backfill"),
        (2, "start", None), (2, "success", "changes"),
        (3, "start", None), (3, "success", "nothing new"),
    ]
    assert json.loads(log.first().config) == config


def test_failed_run_is_recorded_and_raised(spark, tmp_path, config):
    store = IncidentStore(spark, new_folder(spark, "store"), expected_bytes=1)
    feed = landed(spark, tmp_path / "pages", record(1))
    with pytest.raises(Exception):
        store.run(feed, "incidents", {**config, "wards_csv": str(tmp_path / "absent.csv")})
    log = spark.read.schema(RUNS).parquet(f"{store.root}/logs")
    assert {(r.run_id, r.status) for r in log.collect()} == {(1, "start"), (1, "fail")}
    # The next run starts over and loses nothing.
    assert store.run(feed, "incidents", config) == "backfill"
    assert spark.table("crime_data").count() == 1


def test_tables_and_views_are_there_for_another_session(spark, tmp_path, config):
    store = IncidentStore(spark, new_folder(spark, "store"), expected_bytes=1)
    feed = landed(spark, tmp_path / "pages", record(1, arrest="Y"), record(2))
    store.run(feed, "incidents", config)
    other = spark.newSession()
    for name in (*TABLES, *VIEWS):
        assert has_view(other, name) and other.table(name).count() > 0
    assert not any(table.isTemporary for table in other.catalog.listTables() if table.name in VIEWS)
    feed = landed(spark, tmp_path / "pages", record(3, **{":updated_at": "2031-05-10T00:00:00.000Z"}))
    store.run(feed, "incidents", config)
    assert other.table("crime_data").count() == 3
    assert create_view(spark, "crime_growth_by_month", "select 1 as x", replace=False) is False


def test_run_numbers(spark):
    log = RunLog(spark, new_folder(spark, "log"), "p", {"a": 1})
    assert log.next_run_id() == 1
    log.record(1, "start")
    log.record(1, "fail", "text")
    assert log.next_run_id() == 2
    with pytest.raises(ValueError):
        log.record(2, "done")


def test_changed_sql_replaces_its_view(spark, tmp_path):
    file = tmp_path / "one_row.sql"
    file.write_text("select 1 as a;\n")
    (tmp_path / "notes.txt").write_text("not a view")
    assert register_sql_folder(spark, tmp_path) == ["one_row"]
    file.write_text("-- changed\nselect 2 as a")
    register_sql_folder(spark, tmp_path)
    assert spark.table("one_row").first().a == 2


def test_views_in_the_catalog(spark, tmp_path):
    spec = TableSpec("kept", struct("k string, n int"), ("k",))
    declare_table(spark, spec, new_folder(spark, "kept"))
    spark.sql("insert into kept values ('a', 1), ('a', 2)")
    (tmp_path / "kept_totals.sql").write_text("select k, sum(n) as total from kept group by k;")
    assert register_sql_folder(spark, tmp_path, persist=True) == ["kept_totals"]
    assert [t.isTemporary for t in spark.catalog.listTables() if t.name == "kept_totals"] == [False]
    assert tuple(spark.table("kept_totals").first()) == ("a", 3)


def test_a_managed_table_does_not_give_way(spark):
    spark.sql("create table managed_rows as select 1 as a")
    with pytest.raises(ValueError, match="managed"):
        forget(spark, "managed_rows")
    with pytest.raises(ValueError, match="managed"):
        create_view(spark, "managed_rows", "select 2 as a")
    assert spark.table("managed_rows").first().a == 1


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
