"""The paged feed, against a service that answers from a list. No network is used."""

from __future__ import annotations

import io
import json
import re
import sys
from dataclasses import replace
from datetime import datetime, timedelta
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import SF_DIR
from dayblotter import bindings
from dayblotter.functions import dates
from dayblotter.operators.reshape import incidents_from_feed
from dayblotter.operators.timeranges import millisecond_windows, split_span
from dayblotter.schemas import INCIDENT_TABLE, RAW_FEED, struct
from dayblotter.session import new_folder
from dayblotter.sinks.keyed import KeyedTable
from dayblotter.sources.feed import FLAT_FEED, FeedReader, HttpTransport, LandedFeed, PagedFeed, Windows
from dayblotter.streaming.runs import IncidentStore
from dayblotter.streaming.upserts import stream_upserts, take_changes

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Service:
    """Stands in for urlopen: takes a URL, gives a reply."""

    def __init__(self, records, status=200):
        self.records, self.status, self.tokens = records, status, set()

    def __call__(self, request, timeout=None):
        assert "token" not in request.full_url
        self.tokens.add(request.get_header("X-app-token"))
        reply = io.BytesIO(json.dumps(self.answer(parse_qs(urlparse(request.full_url).query))).encode())
        reply.status = self.status
        return reply

    def answer(self, query):
        select, records = query["$select"][0], self.records
        if "$where" in query:
            column, low, high, ceiling, after = re.fullmatch(
                r"(\S+) between '(.*)' and '(.*)' and :updated_at <= '(.*?)'(?: and :id > '(.*)')?", query["$where"][0]
            ).groups()
            records = [
                r for r in records
                if low <= r[column].removesuffix("Z") <= high
                and r[":updated_at"].removesuffix("Z") <= ceiling
                and (after is None or r[":id"] > after)
            ]
        if select.startswith("count"):
            return [{"value": str(len(records))}]
        if select[:3] in ("min", "max"):
            column = select[4 : select.index(")")]
            found = [r[column] for r in records]
            return [{"value": (min if select[:3] == "min" else max)(found)} if found else {}]
        assert query["$order"] == [":id"] and select == ":*,*"
        return sorted(records, key=lambda r: r[":id"])[: int(query["$limit"][0])]


def stamp(moment):
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3]


def record(number, occurred, updated, **changes):
    row = {
        ":id": f"row-{number:05}", ":created_at": stamp(occurred) + "Z", ":updated_at": stamp(updated) + "Z",
        ":version": "rv-1", "date_of_occurrence": stamp(occurred), "arrest": "N", "beat": str(number),
        "latitude": "41.5", "location": {"latitude": "41.5", "human_address": "none"},
    }
    return {**row, **changes}


BEGIN = datetime(2024, 1, 1)
NEVER = "2099-01-01T00:00:00.000"


def records(count):
    """A third of all incidents fall into one hour."""
    made = []
    for i in range(count):
        occurred = BEGIN + (timedelta(seconds=i) if i % 3 == 0 else timedelta(hours=2 * i))
        made.append(record(i, occurred, occurred + timedelta(days=1)))
    return made


def transport(found, **more):
    return HttpTransport("https://feed.invalid/incidents.json", "token", Service(found, **more))


def test_whole_feed_through_many_small_pages(spark):
    made = records(300)
    feed = PagedFeed(spark, transport(made), "feed_small", days=7, limit=10, task_rows=30)
    start, end = feed.bounds("date_of_occurrence")
    assert (start, end) == (min(r["date_of_occurrence"] for r in made), max(r["date_of_occurrence"] for r in made))
    df = feed.between("date_of_occurrence", start, end, NEVER)
    assert df.rdd.getNumPartitions() >= 4
    assert sorted(r[0] for r in df.select("`:id`").collect()) == [r[":id"] for r in made]
    got = incidents_from_feed(df).where("crime_id = 'row-00007'").first()
    assert (got.beat, got.latitude, got.ward) == (7, 41.5, None)


def test_both_ends_of_a_window_are_inside(spark):
    made = [record(i, BEGIN + timedelta(hours=i), BEGIN) for i in range(5)]
    feed = PagedFeed(spark, transport(made), "feed_window", limit=2)
    df = feed.between("date_of_occurrence", stamp(BEGIN + timedelta(hours=1)), stamp(BEGIN + timedelta(hours=3)), NEVER)
    assert sorted(r[0] for r in df.select("`:id`").collect()) == ["row-00001", "row-00002", "row-00003"]
    only = stamp(BEGIN + timedelta(hours=2))
    assert [r[0] for r in feed.between("date_of_occurrence", only, only, NEVER).select("`:id`").collect()] == ["row-00002"]


def test_windows_are_those_of_the_splitter(spark):
    for length in (timedelta(days=14), timedelta(days=20, hours=1), timedelta(milliseconds=1), timedelta(days=7)):
        ends = spark.createDataFrame([(BEGIN, BEGIN + length)], struct("a timestamp_ntz, b timestamp_ntz"))
        pieces = split_span(ends, "a", "b", 7).orderBy("piece").collect()
        cut = list(millisecond_windows(stamp(BEGIN), stamp(BEGIN + length), 7))
        assert cut == [(stamp(p.start_time), stamp(p.end_time)) for p in pieces]
    with pytest.raises(ValueError):
        list(millisecond_windows(stamp(BEGIN), stamp(BEGIN), 0))


def ids(reader, tasks):
    return [i for task in tasks for batch in reader.fetch(task) for i in batch.column(0).to_pylist()]


def test_hot_window_is_split_and_every_row_is_read_once():
    reader = FeedReader(transport(records(300)), FLAT_FEED, 10, 20)
    tasks = reader.plan("date_of_occurrence", millisecond_windows(stamp(BEGIN), stamp(BEGIN + timedelta(days=28)), 7), NEVER)
    for task in tasks:
        assert sum(reader.transport.count(task.column, *span, NEVER) for span in task.spans) <= 20
    found = ids(reader, tasks)
    assert len(found) == len(set(found)) == 300


def test_requests_are_bounded():
    reader = FeedReader(transport(records(300)), FLAT_FEED, 10, 20, max_requests=3)
    tasks = reader.plan("date_of_occurrence", [(stamp(BEGIN), NEVER)], NEVER)
    assert len(tasks) == 3 and len(set(ids(reader, tasks))) == 300


def test_rows_that_change_or_come_after_planning_move_no_others():
    made = records(60)
    service = Service(made)
    reader = FeedReader(HttpTransport("https://x.invalid", None, service), FLAT_FEED, 10, 1000)
    ceiling = stamp(BEGIN + timedelta(days=10))
    (task,) = reader.plan(":updated_at", [(stamp(BEGIN), ceiling)], ceiling)
    batches = reader.fetch(task)
    found = next(batches).column(0).to_pylist()
    later = (BEGIN + timedelta(days=400))
    service.records = [record(0, BEGIN, later), *made[1:], record(61, BEGIN, later), record(-1, BEGIN, later)]
    found += [i for batch in batches for i in batch.column(0).to_pylist()]
    assert found == [r[":id"] for r in made]


def test_empty_window_and_empty_page():
    reader = FeedReader(transport([]), FLAT_FEED)
    assert reader.plan("date_of_occurrence", [(stamp(BEGIN), stamp(BEGIN + timedelta(days=1)))], NEVER) == []
    assert list(reader.fetch(Windows("date_of_occurrence", NEVER, [(stamp(BEGIN), NEVER)]))) == []


def test_limit_on_pages_is_an_error_not_a_cut():
    at_once = [record(i, BEGIN, BEGIN) for i in range(31)]
    span = (stamp(BEGIN), stamp(BEGIN))
    assert FeedReader(transport(at_once[:30]), FLAT_FEED, 10, 20, 3).plan("date_of_occurrence", [span], NEVER)
    with pytest.raises(RuntimeError, match="pages"):
        FeedReader(transport(at_once), FLAT_FEED, 10, 20, 3).plan("date_of_occurrence", [span], NEVER)


def test_refused_request_is_an_error():
    with pytest.raises(OSError, match="500"):
        transport([], status=500).count(":updated_at", "a", "b", NEVER)


def test_the_token_is_a_header_and_not_shown():
    service = Service(records(3))
    one = HttpTransport("https://x.invalid", "secret-token", service)
    assert one.extreme("min", ":updated_at") and service.tokens == {"secret-token"}
    assert "secret-token" not in repr(one)


def test_scan_of_an_hour_with_more_rows_than_a_task(spark, monkeypatch):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").limit(20)
    number = F.monotonically_increasing_id()
    hot = events.crossJoin(spark.range(1200)).withColumn("event_id", number.cast(events.schema["event_id"].dataType))
    hot = hot.withColumn("ts", F.lit("2024-01-05 10:15:00").cast(events.schema["ts"].dataType)).drop("id")
    path = new_folder(spark, "hot")
    hot.write.parquet(path)
    hot = spark.read.parquet(path)
    monkeypatch.setattr(bindings, "table", lambda spark, sf_dir, name: hot)
    # Planned as windows, it would come down to every millisecond of the hour.
    monkeypatch.setattr(FeedReader, "plan", None)
    monkeypatch.setattr("dayblotter.sources.feed.PagedFeed.between", None)
    got = bindings.feed_scan(spark, "")
    below = bindings.raw_feed(hot, corrected=True).where("rtrim('Z', `:updated_at`) <= '2024-01-21T00:00:00.000'")
    assert got.count() == got.distinct().count() == below.count() > 16_000


class Counted(Service):
    """A service that writes down, in a file, what it is asked, by whichever process."""

    def __init__(self, records, log):
        super().__init__(records)
        self.log = log

    def answer(self, query):
        found = super().answer(query)
        kind = query["$select"][0].split("(")[0]
        with open(self.log, "a") as out:
            out.write(json.dumps([kind, query.get("$where", [""])[0], len(found)]) + "\n")
        return found


def asked(log, kind=None):
    lines = [json.loads(line) for line in log.read_text().splitlines()] if log.exists() else []
    return [line for line in lines if kind is None or line[0] == kind]


def spread(count):
    """One incident an hour, each changed a day later."""
    return [record(i, BEGIN + timedelta(hours=i), BEGIN + timedelta(hours=i, days=1)) for i in range(count)]


OCCURRED = "date_of_occurrence"


@pytest.mark.parametrize(
    "test, passes, column, most",
    [
        (f"{OCCURRED} >= '2024-01-11' and {OCCURRED} < '2024-01-12'", lambda r: "2024-01-11" <= r[OCCURRED] < "2024-01-12", OCCURRED, 25),
        (f"{OCCURRED} between '2024-01-11T05:00:00.000' and '2024-01-11T07:00:00.000'", lambda r: "2024-01-11T05" <= r[OCCURRED] <= "2024-01-11T07:00:00.000", OCCURRED, 3),
        (f"{OCCURRED} = '2024-01-11T05:00:00.000' and arrest = 'N'", lambda r: r[OCCURRED] == "2024-01-11T05:00:00.000", OCCURRED, 1),
        (f"{OCCURRED} in ('2024-01-11T05:00:00.000', '2024-01-11T09:00:00.000')", lambda r: r[OCCURRED][:13] in ("2024-01-11T05", "2024-01-11T09"), OCCURRED, 5),
        ("`:updated_at` > '2024-01-30T05:00:00.000Z'", lambda r: r[":updated_at"] > "2024-01-30T05:00:00.000Z", ":updated_at", 24),
        ("`:updated_at` <= '2024-01-03'", lambda r: r[":updated_at"] <= "2024-01-03", ":updated_at", 25),
        (f"{OCCURRED} < '2024-01-02' and `:updated_at` < '2024-01-02T03'", lambda r: r[":updated_at"] < "2024-01-02T03", OCCURRED, 4),
        (f"{OCCURRED} > '2024-01-05' and {OCCURRED} < '2024-01-04'", lambda r: False, OCCURRED, 0),
        (f"{OCCURRED} > '2024-1-5'", lambda r: r[OCCURRED] > "2024-1-5", ":updated_at", 700),
        (f"{OCCURRED} > '2024-01-29' or arrest = 'N'", lambda r: True, ":updated_at", 700),
        (f"{OCCURRED} > '2024-13-45'", lambda r: False, ":updated_at", 700),
    ],
)
def test_a_test_on_time_becomes_the_window(spark, tmp_path, test, passes, column, most):
    made, log = spread(700), tmp_path / "log"
    service = HttpTransport("https://x.invalid", None, Counted(made, str(log)))
    feed = PagedFeed(spark, service, f"feed_{abs(hash(test))}", limit=10)
    got = feed.rows().where(test)
    assert sorted(r[0] for r in got.select("`:id`").collect()) == sorted(r[":id"] for r in made if passes(r))
    pages = asked(log, ":*,*")
    assert sum(line[2] for line in pages) <= most
    assert all(line[1].startswith(f"{column} between") for line in pages)


def test_pushed_tests_show_in_the_plan_and_spare_requests(spark, tmp_path):
    made = spread(700)
    counts = {}
    for name, test in (("all", "true"), ("day", f"{OCCURRED} >= '2024-01-11' and {OCCURRED} < '2024-01-12'")):
        log = tmp_path / name
        feed = PagedFeed(spark, HttpTransport("https://x.invalid", None, Counted(made, str(log))), f"feed_plan_{name}", limit=10)
        rows = feed.rows().where(test)
        rows.collect()
        counts[name] = len(asked(log))
    assert counts["day"] * 10 < counts["all"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "BatchScan feed_plan_day" in plan


def test_a_feed_without_rows_is_read_with_filters(spark):
    feed = PagedFeed(spark, transport([]), "feed_none")
    assert feed.rows().where(f"{OCCURRED} > '2024-01-01'").collect() == []


@pytest.mark.parametrize("rows, limit", [(25, 10), (20, 10), (7, 10), (9, 1)])
def test_changes_come_in_bounded_batches(spark, rows, limit):
    """After an outage: N rows in ceil(N / limit) batches, none lost, none twice."""
    folder = new_folder(spark, "bounded")
    feed = PagedFeed(spark, transport(spread(rows)), f"feed_bounded_{rows}_{limit}", limit=4, batch_rows=limit)
    seen = []

    def note(batch, number):
        seen.append(sorted(row[0] for row in batch.select("`:id`").collect()))

    query = feed.changes().writeStream.option("checkpointLocation", folder).foreachBatch(note).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert [len(ids) for ids in seen] == [limit] * (rows // limit) + [rows % limit] * bool(rows % limit)
    assert sorted(sum(seen, [])) == [r[":id"] for r in spread(rows)]


def test_bounded_batches_go_on_after_a_restart(spark):
    folder, made, seen = new_folder(spark, "restart"), spread(12), []
    service = Service(made)

    def run(name, stop_after):
        feed = PagedFeed(spark, HttpTransport("https://x.invalid", None, service), name, limit=4, batch_rows=3)

        def note(batch, number):
            if stop_after is not None and len(seen) >= stop_after:
                raise RuntimeError("gone")
            seen.append(sorted(row[0] for row in batch.select("`:id`").collect()))

        query = feed.changes().writeStream.option("checkpointLocation", folder).foreachBatch(note).start()
        try:
            query.processAllAvailable()
        except Exception:  # the batch that failed is asked for again
            assert stop_after is not None
        finally:
            query.stop()

    run("feed_restart", 2)
    run("feed_restart", None)
    service.records = made + [record(50 + i, BEGIN, BEGIN + timedelta(days=90, hours=i)) for i in range(4)]
    run("feed_restart_later", None)
    assert [len(ids) for ids in seen] == [3, 3, 3, 3, 3, 1]
    assert sorted(sum(seen, [])) == sorted(r[":id"] for r in service.records)


def test_changes_of_one_millisecond_stay_together(spark):
    made = [record(i, BEGIN, BEGIN + timedelta(hours=1 if i < 8 else i)) for i in range(11)]
    folder, seen = new_folder(spark, "together"), []
    feed = PagedFeed(spark, transport(made), "feed_together", limit=4, batch_rows=2)
    query = feed.changes().writeStream.option("checkpointLocation", folder).foreachBatch(lambda batch, _: seen.append(batch.count())).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen == [8, 2, 1]


def test_taking_all_changes_in_bounded_batches(spark, tmp_path):
    log = tmp_path / "log"
    folder = new_folder(spark, "taken")
    feed = PagedFeed(spark, HttpTransport("https://x.invalid", None, Counted(spread(50), str(log))), "feed_taken", limit=10, batch_rows=20)
    stored = KeyedTable(spark, f"{folder}/incidents", replace(INCIDENT_TABLE, buckets=2))
    assert take_changes(feed, stored, f"{folder}/checkpoint") == 3
    assert stored.read().count() == 50
    assert len(asked(log, "count")) < 3 * 60
    assert take_changes(feed, stored, f"{folder}/checkpoint") == 0


class Moving:
    """A feed in which something changes after each read."""

    def __init__(self, spark, made):
        self.spark, self.records, self.reads, self.after_read = spark, {r[":id"]: r for r in made}, 0, None

    def _pages(self):
        texts = [json.dumps(r) for r in self.records.values()]
        return self.spark.read.schema(RAW_FEED).json(self.spark.sparkContext.parallelize(texts, 2))

    def bounds(self, column):
        return LandedFeed(self._pages()).bounds(column)

    def between(self, column, start, end, ceiling):
        rows = LandedFeed(self._pages()).between(column, start, end, ceiling)
        frozen = self.spark.createDataFrame(rows.collect(), RAW_FEED)
        self.reads += 1
        if self.after_read:
            self.after_read(self)
        return frozen


def contents(store):
    return {r.crime_id: r.arrest for r in store.incidents.read().collect()}


def test_corrections_during_a_backfill_are_fetched_afterwards(spark):
    made = [record(i, BEGIN + timedelta(days=7 * i), BEGIN + timedelta(days=7 * i + 1)) for i in range(6)]
    feed = Moving(spark, made)

    def correct(feed):
        # One row that was read, then one that was not, each newer than all before.
        number = {1: 0, 2: 5}.get(feed.reads)
        if number is not None:
            changed = BEGIN + timedelta(days=300 + feed.reads)
            feed.records[made[number][":id"]] = {**made[number], ":updated_at": stamp(changed) + "Z", "arrest": "Y"}

    feed.after_read = correct
    store = IncidentStore(spark, new_folder(spark, "store"), expected_bytes=1, windows_per_commit=1)
    assert store.refresh(feed) == "backfill"
    assert store.refresh(feed) == "changes"
    assert contents(store) == {r[":id"]: r["arrest"] for r in feed.records.values()}
    assert store.refresh(feed) == "nothing new"


def test_a_backfill_that_broke_off_goes_on(spark):
    made = [record(i, BEGIN + timedelta(days=7 * i), BEGIN + timedelta(days=7 * i + 1)) for i in range(6)]
    feed = Moving(spark, made)

    def fail(feed):
        if feed.reads == 3:
            raise OSError("gone")

    feed.after_read = fail
    root = new_folder(spark, "store")
    with pytest.raises(OSError):
        IncidentStore(spark, root, expected_bytes=1, windows_per_commit=1).refresh(feed)
    store = IncidentStore(spark, root, expected_bytes=1, windows_per_commit=1)
    assert len(contents(store)) == 2
    newer = stamp(BEGIN + timedelta(days=200)) + "Z"
    feed.records["row-00001"] = {**made[1], ":updated_at": newer, "arrest": "Y"}
    feed.records["row-00099"] = record(99, BEGIN, BEGIN + timedelta(days=200))
    assert store.refresh(feed) == "backfill"
    assert feed.reads == 3 + 3  # five windows, of which two had been committed
    assert contents(store) == {r[":id"]: "N" for r in made}
    assert store.refresh(feed) == "changes"
    assert contents(store) == {**{r[":id"]: "N" for r in made}, "row-00001": "Y", "row-00099": "N"}


def test_the_mark_is_not_looked_for_in_the_incidents(spark, monkeypatch):
    feed = Moving(spark, [record(i, BEGIN + timedelta(hours=i), BEGIN + timedelta(hours=i)) for i in range(5)])
    store = IncidentStore(spark, new_folder(spark, "store"), expected_bytes=1)
    store.refresh(feed)
    again = IncidentStore(spark, store.root)
    monkeypatch.setattr(KeyedTable, "read_sql", lambda _: pytest.fail("incidents were read"))
    assert again.refresh(feed) == "nothing new"


def test_backfill_then_changes(spark, rows):
    made = records(40)
    service = Service(made)
    store = IncidentStore(spark, new_folder(spark, "store"), expected_bytes=1)
    feed = PagedFeed(spark, HttpTransport("https://x.invalid", None, service), "feed_store", limit=7)
    assert store.refresh(feed) == "backfill"
    assert store.refresh(feed) == "nothing new"
    later = max(r[":updated_at"] for r in made)
    after = stamp(datetime.strptime(later, "%Y-%m-%dT%H:%M:%S.%fZ") + timedelta(milliseconds=1)) + "Z"
    changed = {**made[3], ":updated_at": after, "arrest": "Y", "date_of_occurrence": stamp(BEGIN - timedelta(days=90))}
    service.records = [*made[:3], changed, *made[4:], record(99, BEGIN, BEGIN + timedelta(days=99))]
    fresh = PagedFeed(spark, HttpTransport("https://x.invalid", None, service), "feed_store_2", limit=7)
    assert store.refresh(fresh) == "changes"
    got = store.incidents.read()
    assert got.count() == 41
    assert got.where("arrest = 'Y'").select("crime_id", "date_of_occurrence").first() == (
        "row-00003", BEGIN - timedelta(days=90)
    )


def test_changes_as_a_stream(spark):
    made = records(25)
    folder = new_folder(spark, "stream")
    stored = KeyedTable(spark, f"{folder}/incidents", replace(INCIDENT_TABLE, buckets=4))

    def run(found, name):
        feed = PagedFeed(spark, transport(found), name, limit=4)
        query = stream_upserts(incidents_from_feed(feed.changes()), stored, f"{folder}/{name}", interval="1 second")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return feed

    run(made, "feed_stream")
    assert stored.read().count() == 25
    mark = max(r[":updated_at"] for r in made).removesuffix("Z")
    newer = [
        {**made[0], ":updated_at": "2025-01-01T00:00:00.000Z", "arrest": "Y"},
        {**made[1], "arrest": "Y"},  # not newer than the mark: not sent again
    ]
    feed = PagedFeed(spark, transport([*newer, *made[2:]]), "feed_since", limit=4)
    stream = feed.changes(since=mark)
    query = stream_upserts(incidents_from_feed(stream), stored, f"{folder}/since", interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert [r[0] for r in stored.read().where("arrest = 'Y'").select("crime_id").collect()] == ["row-00000"]
    newest = stored.read().select(dates.utc_wall_clock(F.max("updated_at"))).first()[0]
    assert newest == datetime(2025, 1, 1)
