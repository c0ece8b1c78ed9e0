"""What the plans must look like to hold at a thousand times the data."""

import contextlib
import io
import os
import re
from dataclasses import replace

import pyarrow.parquet as pq
import pytest

from conftest import SF_DIR
from dayblotter import bindings
from dayblotter.operators.upsert import latest_per_key
from dayblotter.operators.reshape import incidents_from_feed
from dayblotter.schemas import INCIDENT_TABLE, TableSpec
from dayblotter.session import new_folder
from dayblotter.sinks.keyed import KeyedTable
from dayblotter.sources.feed import LandedFeed


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue().split("== Initial Plan ==")[0]


def of(spark, name, mode="simple"):
    return plan(bindings.QUERIES[name](spark, SF_DIR), mode)


def shuffles(text):
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (hash|range|Round|Single|shuffle)", text))


ROW_LEVEL = [
    "time_of_day", "window_scan", "date_parts", "time_text", "percent_text", "json_flatten", "feed_reshape",
    "missing_to_null", "incremental_since",
]


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_row_queries_never_shuffle(spark, name):
    text = of(spark, name)
    assert shuffles(text) == 0
    assert "Python" not in text


@pytest.mark.parametrize("name", ["incident_calendar", "incident_calendar_older_shape"])
def test_every_incident_meets_the_calendar_without_a_shuffle(spark, name):
    text = of(spark, name)
    assert "BroadcastHashJoin" in text and shuffles(text) == 0
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["window_scan", "incremental_since"])
def test_time_tests_reach_the_scan(spark, name):
    pushed = re.search(r"PushedFilters: (.*)", of(spark, name, "formatted")).group(1)
    assert "IsNotNull(ts), GreaterThan" in pushed


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("station_rank", "orders", "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string"),
        ("q_weekday", "orders", "o_orderkey:bigint,o_orderdate:timestamp_ntz"),
        ("ward_summary", "customer", "c_custkey:bigint,c_nationkey:int"),
        ("holiday_mean", "events", "event_id:bigint,ts:timestamp_ntz"),
        ("feed_bounds", "events", "ts:timestamp_ntz"),
    ],
)
def test_scans_read_only_what_they_need(spark, name, table, columns):
    scans = [line for line in of(spark, name).splitlines() if f"{table}.parquet" in line]
    assert any(f"ReadSchema: struct<{columns}" in line for line in scans)


def test_stations_are_ranked_from_one_scan(spark):
    text = of(spark, "station_rank")
    assert text.count("orders.parquet") == 1 and "SortMergeJoin" not in text


def test_incidents_are_counted_before_they_are_joined(spark):
    text = of(spark, "monthly_growth").splitlines()
    join = next(i for i, line in enumerate(text) if "BroadcastHashJoin" in line)
    below = "\n".join(text[join:])
    assert "partial_count(crime_id" in below


def test_wards_are_cut_to_two_types_before_the_shuffle_and_counted_once(spark):
    df = bindings.QUERIES["ward_summary"](spark, SF_DIR)
    df.collect()
    text = plan(df)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "ReusedExchange" in text
    assert text.count("orders.parquet") == 1


def test_latest_per_key_combines_on_the_map_side(spark):
    events = bindings.table(spark, SF_DIR, "events")
    text = plan(latest_per_key(events, ["user_id"], ["ts"]))
    assert text.index("partial_max") > text.index("Exchange hashpartitioning") and shuffles(text) == 1


def stored_orders(spark):
    orders = bindings.table(spark, SF_DIR, "orders")
    spec = TableSpec("orders", orders.schema, ("o_orderkey",), ("o_orderdate",), buckets=8)
    stored = KeyedTable(spark, new_folder(spark, "orders"), spec, compact_share=1e9).create()
    return orders, stored


def writes_of(spark, monkeypatch, work):
    """The plans of what a keyed table writes."""
    plans, write = [], KeyedTable._written

    def seen(table, rows, state):
        plans.append(plan(rows))
        return write(table, rows, state)

    monkeypatch.setattr(KeyedTable, "_written", seen)
    work()
    return plans


def test_changes_are_shuffled_once_and_nothing_stored_is_read(spark, monkeypatch):
    orders, stored = stored_orders(spark)
    beside, write = [], KeyedTable._beside
    monkeypatch.setattr(KeyedTable, "_beside", lambda table, rows, state: beside.append(plan(rows)) or write(table, rows, state))
    plans = writes_of(spark, monkeypatch, lambda: [stored.upsert(orders), stored.upsert(orders.where("o_orderkey < 100"))])
    (first,) = plans
    assert shuffles(first) == 1 and "hashpartitioning(o_orderkey" in first and ", 8), REPARTITION_BY_NUM" in first
    (later,) = beside
    assert "keyed_" not in later and shuffles(later) == 1


def test_stored_rows_are_merged_without_a_shuffle(spark, monkeypatch):
    orders, stored = stored_orders(spark)
    stored.upsert(orders)
    stored.upsert(orders.where("o_orderstatus = 'P'"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # Whether there are more buckets than a shuffle has partitions, or fewer.
        for partitions in ("4", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            text = plan(stored.read())
            assert shuffles(text) == 1 and "8), REPARTITION_BY_NUM" in text and "Bucketed: true" in text
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    (compacted,) = writes_of(spark, monkeypatch, stored.compact)
    assert shuffles(compacted) == 1 and "8), REPARTITION_BY_NUM" in compacted


def test_numbering_rows_is_one_shuffle_and_writes_nothing(spark):
    text = of(spark, "paged_scan")
    assert shuffles(text) == 1 and text.count("Scan parquet") == 1 and "events.parquet" in text


@pytest.mark.parametrize("name", ["monthly_growth", "q_weekday", "q_month"])
def test_orders_are_scanned_once_for_counts_and_calendar(spark, name):
    df = bindings.QUERIES[name](spark, SF_DIR)
    df.collect()
    text = plan(df)
    assert text.count("orders.parquet") == 1 and "ReusedExchange" in text


def test_landed_pages_are_parsed_once(spark):
    folder = new_folder(spark, "pages")
    bindings.raw_feed(bindings.table(spark, SF_DIR, "events"), corrected=False).write.json(folder)
    feed = LandedFeed.landed(spark, folder, arrays=False)
    text = plan(feed.between("date_of_occurrence", "2024-01-01T00:00:00.000", "2024-02-01T00:00:00.000", "2024-02-01T00:00:00.000"))
    assert "json" not in text.lower().replace(folder.lower(), "") and "parquet" in text


def test_change_times_have_statistics(spark):
    stored = KeyedTable(spark, new_folder(spark, "t"), replace(INCIDENT_TABLE, buckets=2)).create()
    stored.upsert(incidents_from_feed(bindings.raw_feed(bindings.table(spark, SF_DIR, "events"), corrected=False)))
    folder = f"{stored.path}/{stored._state()['generation']}"
    files = [f"{folder}/{name}" for name in os.listdir(folder) if name.endswith(".parquet")]
    meta = pq.ParquetFile(files[0]).metadata
    column = next(c for c in map(meta.row_group(0).column, range(meta.num_columns)) if c.path_in_schema == "updated_at")
    assert column.physical_type == "INT64" and column.statistics.has_min_max
    pushed = plan(stored.read().where("updated_at > timestamp '2024-01-15 00:00:00'"), "formatted")
    assert "GreaterThan(updated_at" in pushed
