import os
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayblotter.operators.upsert import latest_per_key, merge_latest
from dayblotter.schemas import TableSpec, struct
from dayblotter.session import new_folder, publish, published
from dayblotter.sinks.keyed import KeyedTable, buckets_for
from dayblotter.streaming.upserts import stream_upserts

SCHEMA = struct("k string, updated_at timestamp_ntz, version string, payload double")
SPEC = TableSpec("t", SCHEMA, ("k",), ("updated_at", "version"), buckets=4)


def at(day):
    return datetime(2024, 1, day)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def table(spark, spec=SPEC):
    return KeyedTable(spark, new_folder(spark, "t"), spec).create()


def test_new_changed_and_repeated_keys(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(1), "1", 1.0), ("b", at(1), "1", 2.0)]))
    stored.upsert(
        frame(
            spark,
            [
                ("b", at(3), "1", 3.0), ("b", at(2), "9", 4.0),  # the later of two wins
                ("c", at(2), "1", 5.0), ("c", at(2), "2", 6.0),  # the later version of equal times
                ("a", at(1), "1", 7.0),  # as new as what is stored: the change wins
            ],
        )
    )
    assert rows(stored.read()) == [("a", at(1), "1", 7.0), ("b", at(3), "1", 3.0), ("c", at(2), "2", 6.0)]


def test_stale_change(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(5), "1", 1.0)]))
    stored.upsert(frame(spark, [("a", at(4), "1", 2.0)]))
    assert rows(stored.read()) == [("a", at(5), "1", 1.0)]
    stored.upsert(frame(spark, [("a", at(4), "1", 2.0)]), stale="replace")
    assert rows(stored.read()) == [("a", at(4), "1", 2.0)]
    with pytest.raises(ValueError):
        stored.upsert(frame(spark, [("a", at(4), "1", 2.0)]), stale="never")


def test_nothing_to_do(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, []))
    assert stored.read().count() == 0
    stored.upsert(frame(spark, [("a", at(1), "1", 1.0)]))
    stored.upsert(frame(spark, []))
    assert rows(stored.read()) == [("a", at(1), "1", 1.0)]


def test_absent_and_unknown_columns(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(1), "1", float("nan")), ("b", at(1), "1", 1.0)]))
    stored.upsert(frame(spark, [("b", at(2), "1")], struct("k string, updated_at timestamp_ntz, version string")))
    assert rows(stored.read()) == [("a", at(1), "1", None), ("b", at(2), "1", None)]
    with pytest.raises(ValueError):
        stored.upsert(frame(spark, [("a", 1)], struct("k string, other int")))


def test_key_of_two_columns(spark, rows):
    spec = TableSpec("runs", struct("run_id int, status string, note string"), ("run_id", "status"), (), 2)
    stored = table(spark, spec)
    stored.upsert(frame(spark, [(1, "start", "x"), (1, "fail", "y")], spec.schema))
    stored.upsert(frame(spark, [(1, "fail", "z"), (2, "start", "x")], spec.schema))
    assert rows(stored.read()) == [(1, "fail", "z"), (1, "start", "x"), (2, "start", "x")]


def test_a_moved_row_leaves_no_copy(spark):
    """A change may alter any column but the key; the bucket depends on the key alone."""
    stored = table(spark)
    stored.upsert(frame(spark, [(f"k{i}", at(1), "1", float(i)) for i in range(50)]))
    stored.upsert(frame(spark, [(f"k{i}", at(2), "2", -1.0) for i in range(0, 50, 7)]))
    assert stored.read().count() == 50 == stored.read().select("k").distinct().count()
    assert stored.read().where("payload = -1").count() == 8


def files(stored):
    folder = f"{stored.path}/{stored._state()['generation']}"
    return {name: os.path.getmtime(f"{folder}/{name}") for name in os.listdir(folder) if name.startswith("part-")}


def beside(stored):
    """Files of the changes beside a table."""
    folder = stored._changes_folder(stored._state())
    return sum(name.startswith("part-") for _, _, names in os.walk(folder) for name in names)


def test_changes_to_many_buckets_are_few_files(spark):
    """Two thousand changes in four hundred buckets: a file, and not four hundred; a later one adds its own."""
    spec = TableSpec("t", SCHEMA, ("k",), ("updated_at", "version"), buckets=400)
    stored = KeyedTable(spark, new_folder(spark, "many"), spec, compact_share=1e9).create()
    stored.upsert(frame(spark, [(f"k{i}", at(1), "1", float(i)) for i in range(10_000)]))
    before = files(stored)
    changes = frame(spark, [(f"k{i}", at(2), "1", -1.0) for i in range(9_000, 11_000)])
    for number in (1, 2):
        stored.upsert(changes)
        assert files(stored) == before and beside(stored) == number
    got = stored.read()
    assert got.count() == 11_000 and got.where("payload = -1").count() == 2_000
    stored.compact()
    assert beside(stored) == 0 and stored._state()["changes"] == {}
    assert stored.read().count() == 11_000 and stored.read().where("payload = -1").count() == 2_000


def test_changes_without_a_column_that_says_which_is_newer(spark):
    spec = TableSpec("t", SCHEMA, ("k", "version"), buckets=3)
    stored = KeyedTable(spark, new_folder(spark, "unordered"), spec, compact_share=1e9).create()
    stored.upsert(frame(spark, [("a", at(2), "1", 1.0), ("b", at(2), "1", 1.0)]))
    stored.upsert(frame(spark, [("a", at(1), "1", 2.0), ("a", at(1), "2", 2.0)]))
    stored.upsert(frame(spark, [("c", at(1), "1", 3.0)]))
    assert sorted((r.k, r.version, r.payload) for r in stored.read().collect()) == [
        ("a", "1", 2.0), ("a", "2", 2.0), ("b", "1", 1.0), ("c", "1", 3.0)
    ]


def test_a_change_without_a_time_does_not_win(spark):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(2), "1", 1.0), ("b", None, "1", 1.0)]))
    stored.upsert(frame(spark, [("a", None, "9", 2.0), ("b", None, "2", 2.0)]))
    assert {r.k: r.payload for r in stored.read().collect()} == {"a": 1.0, "b": 2.0}


def test_a_change_in_every_bucket_rewrites_no_file(spark):
    stored = table(spark)
    stored.upsert(frame(spark, [(f"k{i}", at(1), "1", float(i)) for i in range(5000)]))
    before = files(stored)
    assert len(before) == 4
    stored.upsert(frame(spark, [(f"k{i}", at(2), "1", -1.0) for i in range(40)]))
    assert files(stored) == before and beside(stored) == 1
    assert len(stored._state()["writes"]) == len(stored._state()["changes"]) == 1
    assert stored.read().where("payload = -1").count() == 40 and stored.read().count() == 5000


def test_a_table_needs_a_size(spark):
    spec = TableSpec("t", SCHEMA, ("k",), ("updated_at", "version"))
    with pytest.raises(ValueError, match="buckets"):
        table(spark, spec)
    stored = KeyedTable(spark, new_folder(spark, "t"), spec).create(expected_bytes=10 << 30)
    assert stored.buckets == 40
    with pytest.raises(ValueError):
        KeyedTable(spark, new_folder(spark, "t"), SPEC).read()


def test_buckets_grow_with_the_table():
    assert [buckets_for(n) for n in (0, 1 << 30, 10 << 40, 100 << 40)] == [8, 8, 40960, 409600]
    assert buckets_for(100 << 40, 1 << 30) == 102400


def test_rebucket_and_compact_keep_the_rows(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, [(f"k{i}", at(1), "1", float(i)) for i in range(50)]))
    stored.upsert(frame(spark, [("k1", at(2), "1", 7.0)]))
    before, reading = rows(stored.read()), stored.read()
    stored.rebucket(7)
    assert stored.buckets == 7 and len(files(stored)) <= 7 and rows(stored.read()) == before
    stored.upsert(frame(spark, [("k1", at(3), "1", 8.0), ("new", at(1), "1", 0.0)]))
    stored.compact()
    assert len(stored._state()["writes"]) == 1
    assert stored.read().where("k = 'k1'").first().payload == 8.0 and stored.read().count() == 51
    # A generation stays until there is a newer one than its successor; who reads it is not disturbed.
    stored.compact()
    assert len([name for name in os.listdir(stored.path) if name.startswith("data-")]) == 2
    with pytest.raises(Exception):
        reading.collect()


def test_changes_are_folded_in_when_they_are_a_share_of_the_table(spark):
    stored = KeyedTable(spark, new_folder(spark, "t"), SPEC, compact_share=1e9, most_writes=3).create()
    for day in range(1, 6):
        stored.upsert(frame(spark, [("a", at(day), "1", float(day)), (f"k{day}", at(day), "1", 0.0)]))
        assert len(stored._state()["writes"]) <= 3
    assert stored.read().count() == 6 and stored.read().where("k = 'a'").first().payload == 5.0
    eager = KeyedTable(spark, new_folder(spark, "t"), SPEC, compact_share=0.1).create()
    for day in (1, 2):
        eager.upsert(frame(spark, [("a", at(day), "1", float(day))]))
    assert len(eager._state()["writes"]) == 1 and eager.read().first().payload == 2.0


@pytest.mark.parametrize("known", [0, 1])
def test_a_refused_rename_loses_nothing(spark, rows, monkeypatch, known):
    stored = table(spark)
    first = [("a", at(1), "1", 1.0), ("b", at(1), "1", 2.0)]
    if known:
        stored.upsert(frame(spark, first))
    with monkeypatch.context() as broken:
        broken.setattr("dayblotter.session._rename", lambda *_: False)
        for stale in ("keep", "replace"):
            with pytest.raises(RuntimeError, match="published"):
                stored.upsert(frame(spark, [("a", at(2), "1", 3.0)]), stale)
    assert rows(stored.read()) == (first if known else [])
    stored.upsert(frame(spark, [("a", at(2), "1", 3.0)]))
    assert rows(stored.read()) == [("a", at(2), "1", 3.0), *first[1:]] if known else [("a", at(2), "1", 3.0)]


def test_a_writer_that_died_left_nothing_to_read(spark, rows, monkeypatch):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(1), "1", 1.0)]))
    with monkeypatch.context() as broken:

        def die(*_):
            raise OSError("gone")

        broken.setattr("dayblotter.sinks.keyed.publish", die)
        with pytest.raises(OSError):
            stored.upsert(frame(spark, [("a", at(2), "1", 3.0), ("b", at(2), "1", 3.0)]))
    assert rows(stored.read()) == [("a", at(1), "1", 1.0)]
    stored.upsert(frame(spark, [("c", at(1), "1", 2.0)]))
    stored.compact()
    assert rows(stored.read()) == [("a", at(1), "1", 1.0), ("c", at(1), "1", 2.0)]


def test_success_marks_are_not_needed(spark, rows):
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        stored = table(spark)
        stored.upsert(frame(spark, [("a", at(1), "1", 1.0)]))
        stored.upsert(frame(spark, [("a", at(2), "1", 2.0), ("b", at(1), "1", 1.0)]))
        stored.compact()
        assert rows(stored.read()) == [("a", at(2), "1", 2.0), ("b", at(1), "1", 1.0)]
    finally:
        settings.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_null_key_is_an_error_and_stores_nothing(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(1), "1", 1.0)]))
    for stale in ("keep", "replace"):
        with pytest.raises(Exception, match="NULL in a key"):
            stored.upsert(frame(spark, [("b", at(1), "1", 1.0), (None, at(1), "1", 2.0), (None, at(2), "1", 3.0)]), stale)
    assert rows(stored.read()) == [("a", at(1), "1", 1.0)]


def test_a_reader_keeps_what_it_began_with(spark, rows):
    stored = table(spark)
    stored.upsert(frame(spark, [("a", at(1), "1", 1.0)]))
    reading = stored.read()
    stored.upsert(frame(spark, [("a", at(2), "1", 2.0), ("b", at(1), "1", 1.0)]))
    assert rows(reading) == [("a", at(1), "1", 1.0)]
    stored.compact()
    assert rows(reading) == [("a", at(1), "1", 1.0)]
    assert rows(stored.read()) == [("a", at(2), "1", 2.0), ("b", at(1), "1", 1.0)]


def test_two_writers_do_not_both_publish(spark):
    folder = new_folder(spark, "states")
    first = publish(spark, folder, {"n": 0})
    assert publish(spark, folder, {**first, "n": 1})["version"] == 2
    with pytest.raises(RuntimeError, match="another writer"):
        publish(spark, folder, {**first, "n": 2})
    assert published(spark, folder) == {"n": 1, "version": 2}
    assert published(spark, new_folder(spark, "states")) is None


change = st.tuples(
    st.sampled_from("abc"),
    st.integers(1, 3).map(at),
    st.sampled_from("12"),
    st.sampled_from([1.0, 2.0, None]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, max_size=8), st.lists(change, min_size=1, max_size=8))
def test_merging_again_or_in_another_order_is_the_same(spark, rows, stored, changes):
    target = latest_per_key(frame(spark, stored), SPEC.keys, SPEC.newest)
    incoming = frame(spark, changes)
    once = merge_latest(target, incoming, SPEC.keys, SPEC.newest)
    twice = merge_latest(once, incoming, SPEC.keys, SPEC.newest)
    backwards = merge_latest(target, frame(spark, changes[::-1]), SPEC.keys, SPEC.newest)
    assert rows(once) == rows(twice) == rows(backwards)
    newest = {}
    for row in changes:
        order = (row[1], row[2], 1, row[3] is not None, row[3] or 0.0)
        newest[row[0]] = max(newest.get(row[0], order), order)
    for key, found in {r[0]: r for r in rows(once)}.items():
        if key in newest:
            assert (found[1], found[2]) >= newest[key][:2]


def test_ties_do_not_depend_on_order(spark, rows):
    same = [("a", at(1), "1", 1.0), ("a", at(1), "1", 2.0), ("a", None, "1", 9.0)]
    results = {tuple(rows(latest_per_key(frame(spark, list(p)), SPEC.keys, SPEC.newest))) for p in permutations(same)}
    assert results == {(("a", at(1), "1", 2.0),)}


def test_one_key_with_a_third_of_all_changes(spark):
    changes = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"),
        (F.lit(at(1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("updated_at"),
        F.lit("1").alias("version"),
        F.col("id").cast("double").alias("payload"),
    )
    stored = table(spark)
    stored.upsert(changes)
    expected = {}
    for i in range(30000):
        expected["hot" if i % 3 == 0 else f"k{i % 1000}"] = float(i)
    assert {r.k: r.payload for r in stored.read().collect()} == expected


def test_stream_into_a_table(spark, rows):
    folder = new_folder(spark, "stream")
    files, checkpoint = f"{folder}/files", f"{folder}/checkpoint"
    stored = KeyedTable(spark, f"{folder}/t", SPEC)

    def arrive(*records):
        frame(spark, list(records)).coalesce(1).write.mode("append").parquet(files)
        changes = spark.readStream.schema(SCHEMA).parquet(files)
        stream_upserts(changes, stored, checkpoint, interval=None).awaitTermination()

    arrive(("a", at(1), "1", 1.0), ("b", at(1), "1", 1.0))
    arrive(("a", at(2), "1", 2.0), ("c", at(1) - timedelta(days=400), "1", 3.0))
    assert rows(stored.read()) == [
        ("a", at(2), "1", 2.0), ("b", at(1), "1", 1.0), ("c", at(1) - timedelta(days=400), "1", 3.0)
    ]
