"""One run of the incident store: dimensions once, then a backfill or the changes since."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from dayblotter import schemas
from dayblotter.fixed_values import BACKFILL_DAYS, CALENDAR_BEGIN, CALENDAR_END
from dayblotter.functions.columns import conform, missing_to_null
from dayblotter.operators.calendar import calendar_for, parse_holidays
from dayblotter.operators.reshape import incidents_from_feed
from dayblotter.operators.timeranges import millisecond_windows, next_millisecond
from dayblotter.plans.registry import create_catalog_views, register_sql_folder
from dayblotter.session import publish, published
from dayblotter.sinks.audit import RunLog
from dayblotter.sinks.declare import create_view, declare_table
from dayblotter.sinks.keyed import KeyedTable
from dayblotter.sources.files import read_csv

OCCURRED, UPDATED = "date_of_occurrence", ":updated_at"


class Feed(Protocol):
    def bounds(self, column: str) -> tuple[str | None, str | None]: ...

    def between(self, column: str, start: str, end: str, ceiling: str) -> DataFrame: ...


class IncidentStore:
    """The tables under one folder.

    `expected_bytes` sizes the incident table when it is made, unless its spec declares buckets. A
    backfill commits after every `windows_per_commit` windows.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        incidents: schemas.TableSpec = schemas.INCIDENT_TABLE,
        expected_bytes: int | None = None,
        windows_per_commit: int = 8,
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.incidents = KeyedTable(spark, f"{self.root}/{incidents.name}", incidents)
        self.expected_bytes, self.windows_per_commit = expected_bytes, windows_per_commit
        self.progress = f"{self.root}/progress"

    def load_once(self, spec: schemas.TableSpec, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored dimension; built and written only when it is not there yet.

        It is there once a whole write of it has been published.
        """
        return self.spark.read.schema(spec.schema).parquet(self._loaded(spec, build))

    def _loaded(self, spec: schemas.TableSpec, build: Callable[[], DataFrame]) -> str:
        states = f"{self.root}/{spec.name}/states"
        state = published(self.spark, states)
        if state is None:
            folder = f"{self.root}/{spec.name}/data-{time.time_ns()}"
            missing_to_null(conform(build(), spec.schema)).write.parquet(folder)
            state = publish(self.spark, states, {"folder": folder})
        return state["folder"]

    def load_dimensions(
        self,
        wards_csv: str,
        stations_csv: str,
        holiday_csvs: Sequence[str],
        begin: str = CALENDAR_BEGIN,
        end: str = CALENDAR_END,
    ) -> list[str]:
        """Wards, stations and the calendar as tables of the catalog; their names."""
        spark = self.spark

        def calendar() -> DataFrame:
            holidays = parse_holidays(read_csv(spark, holiday_csvs, schemas.HOLIDAY_FILE))
            return calendar_for(spark, begin, end, holidays)

        builds = {
            schemas.WARD_TABLE: lambda: read_csv(spark, wards_csv),
            schemas.STATION_TABLE: lambda: read_csv(spark, stations_csv),
            schemas.CALENDAR_TABLE: calendar,
        }
        for spec, build in builds.items():
            declare_table(spark, spec, self._loaded(spec, build), replace=True)
        return [spec.name for spec in builds]

    def refresh(self, feed: Feed) -> str:
        """Fill an empty table by occurrence time, or merge what changed since the mark.

        The newest change time of the feed is fixed before anything is read, and nothing newer is
        read: it becomes the mark, so whatever changes meanwhile belongs to the next refresh. What
        has been committed is published, windows and mark; a backfill that broke off goes on from
        there, below the same ceiling.
        """
        self.incidents.create(self.expected_bytes)
        state = published(self.spark, self.progress) or {}
        if "mark" in state:
            return self._fetch_changes(feed, state["mark"])
        if "ceiling" not in state:
            start, end = feed.bounds(OCCURRED)
            ceiling = feed.bounds(UPDATED)[1]
            if not start or not end or not ceiling:
                return "nothing new"
            state = {"ceiling": ceiling, "start": start, "end": end, "done": 0}
            publish(self.spark, self.progress, state)
        windows = list(millisecond_windows(state["start"], state["end"], BACKFILL_DAYS))
        for first in range(state["done"], len(windows), self.windows_per_commit):
            part = windows[first : first + self.windows_per_commit]
            rows = feed.between(OCCURRED, part[0][0], part[-1][1], state["ceiling"])
            self.incidents.upsert(incidents_from_feed(rows))
            done = {"ceiling": state["ceiling"], "start": state["start"], "end": state["end"]}
            publish(self.spark, self.progress, {**done, "done": first + len(part)})
        publish(self.spark, self.progress, {"mark": state["ceiling"]})
        return "backfill"

    def _fetch_changes(self, feed: Feed, mark: str) -> str:
        ceiling = feed.bounds(UPDATED)[1]
        if not ceiling or ceiling <= mark:
            return "nothing new"
        rows = feed.between(UPDATED, next_millisecond(mark), ceiling, ceiling)
        self.incidents.upsert(incidents_from_feed(rows))
        publish(self.spark, self.progress, {"mark": ceiling})
        return "changes"

    def create_views(self, sql_folder: str | None = None) -> list[str]:
        """The incidents as they are now, the six views, and a user's own, for every session."""
        create_view(self.spark, self.incidents.spec.name, self.incidents.read_sql())
        named = create_catalog_views(self.spark)
        return named + (register_sql_folder(self.spark, sql_folder, persist=True) if sql_folder else [])

    def run(
        self, feed: Feed, name: str, config: dict, sql_folder: str | None = None
    ) -> str:
        """Dimensions, incidents and views, with a record of the start and of the end.

        `config` holds the arguments of `load_dimensions`; views of the user's own come from
        `sql_folder`. A failure is recorded and raised.
        """
        log = RunLog(self.spark, f"{self.root}/{schemas.RUN_TABLE.name}", name, config)
        run_id = log.next_run_id()
        log.record(run_id, "start")
        began, steps = time.monotonic(), []

        def done(step: str) -> None:
            steps.append(f"{time.monotonic() - began:.1f} s: {step}")

        try:
            self.load_dimensions(**config)
            done("dimensions")
            kind = self.refresh(feed)
            done(f"incidents: {kind}")
            done(f"views: {', '.join(self.create_views(sql_folder))}")
        except BaseException as error:
            done(f"{type(error).__name__}: {error}")
            log.record(run_id, "fail", "\n".join(steps))
            raise
        log.record(run_id, "success", "\n".join(steps))
        return kind
