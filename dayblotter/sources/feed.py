"""A paged feed as a Spark data source, for batch and for streaming reads.

The driver asks the service for bounds and counts, to lay out who reads what: windows with too many
rows are cut in two until each is little enough for one task. Tasks fetch the pages of a window by
key, each after the last row of the page before. Every request has a ceiling of change time, fixed
before the first: rows that change meanwhile leave what is read here without moving others, and
belong to the next read.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Protocol
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StringType, StructField, StructType

from dayblotter.fixed_values import BACKFILL_DAYS, PAGE_ROWS
from dayblotter.functions.columns import quoted
from dayblotter.operators import timeranges
from dayblotter.operators.timeranges import before_millisecond, halves, is_moment, middle, millisecond_windows, next_millisecond
from dayblotter.schemas import RAW_FEED
from dayblotter.session import new_folder
from dayblotter.sources.files import read_pages

# Tasks get what they run with the job, so executors need not have this package installed.
for _module in (sys.modules[__name__], timeranges):
    cloudpickle.register_pickle_by_value(_module)

UPDATED, KEY = ":updated_at", ":id"
TIMES = ("date_of_occurrence", UPDATED, ":created_at")
_LEAST = "0001-01-01T00:00:00.000"
_STAMP = re.compile(r"\d{4}-\d\d-\d\d(T\d\d(:\d\d(:\d\d(\.\d{1,3})?)?)?)?Z?")
TASK_ROWS = 16 * PAGE_ROWS


class Transport(Protocol):
    """What a service has to answer. Instances travel to executors.

    Rows asked for lie in start <= column <= end and have a change time up to `ceiling`.
    """

    def extreme(self, which: str, column: str) -> str | None:
        """The min or max of a column."""

    def count(self, column: str, start: str, end: str, ceiling: str) -> int:
        """How many rows there are."""

    def page(self, column: str, start: str, end: str, ceiling: str, limit: int, after: str | None) -> list[dict]:
        """The first `limit` rows by key that come after a key."""


def _clause(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class HttpTransport:
    """A service that takes its query as $select, $where, $order and $limit, and its token as a header."""

    url: str
    token: str | None = field(default=None, repr=False)
    opener: Callable[..., Any] = urlopen
    timeout: float = 60.0

    def _get(self, **clauses: Any) -> list[dict]:
        query = urlencode({f"${name}": value for name, value in clauses.items()})
        headers = {"X-App-Token": self.token} if self.token else {}
        with self.opener(Request(f"{self.url}?{query}", headers=headers), timeout=self.timeout) as reply:
            if reply.status != 200:
                raise OSError(f"feed answered {reply.status}")
            return json.load(reply)

    @staticmethod
    def _where(column: str, start: str, end: str, ceiling: str) -> str:
        window = f"{column} between {_clause(start)} and {_clause(end)}"
        return f"{window} and {UPDATED} <= {_clause(ceiling)}"

    def extreme(self, which: str, column: str) -> str | None:
        return self._get(select=f"{which}({column}) as value")[0].get("value")

    def count(self, column: str, start: str, end: str, ceiling: str) -> int:
        where = self._where(column, start, end, ceiling)
        return int(self._get(select="count(*) as value", where=where)[0]["value"])

    def page(self, column: str, start: str, end: str, ceiling: str, limit: int, after: str | None) -> list[dict]:
        where = self._where(column, start, end, ceiling)
        if after is not None:
            where += f" and {KEY} > {_clause(after)}"
        return self._get(select=":*,*", where=where, order=KEY, limit=limit)


@dataclass
class Windows(InputPartition):
    """Windows that one task reads, one after another."""

    column: str
    ceiling: str
    spans: list[tuple[str, str]]


@dataclass(frozen=True)
class FeedReader:
    """Planning and fetching, shared by the batch and the streaming reader.

    A task gets windows of up to `task_rows` rows together. `max_requests` bounds the tasks, and so
    the requests that a service gets at once; `max_pages` is an error for a window that would take
    more and cannot be cut.
    """

    transport: Transport
    schema: StructType
    limit: int = PAGE_ROWS
    task_rows: int = TASK_ROWS
    max_pages: int | None = None
    max_requests: int | None = None

    def plan(self, column: str, windows: Iterator[tuple[str, str]], ceiling: str) -> list[Windows]:
        sized: list[tuple[str, str, int]] = []
        # Counts are asked for side by side, as many at once as tasks may read.
        with ThreadPoolExecutor(min(self.max_requests or 8, 8)) as pool:
            left = list(windows)
            while left:
                counts = pool.map(lambda span: self.transport.count(column, *span, ceiling), left)
                cut = []
                for span, rows in zip(left, list(counts)):
                    parts = halves(*span) if rows > self.task_rows else [span]
                    if len(parts) > 1:
                        cut += parts
                        continue
                    if self.max_pages is not None and rows > self.max_pages * self.limit:
                        raise RuntimeError(f"more than {self.max_pages} pages from {span[0]} to {span[1]}")
                    if rows:
                        sized.append((*span, rows))
                left = cut
        tasks: list[tuple[list[tuple[str, str]], int]] = []
        for start, end, rows in sorted(sized):
            if tasks and tasks[-1][1] + rows <= self.task_rows:
                tasks[-1] = ([*tasks[-1][0], (start, end)], tasks[-1][1] + rows)
            else:
                tasks.append(([(start, end)], rows))
        groups = min(len(tasks), self.max_requests or len(tasks))
        dealt = [[span for spans, _ in tasks[place::groups] for span in spans] for place in range(groups)]
        return [Windows(column, ceiling, spans) for spans in dealt]

    def fetch(self, windows: Windows | None) -> Iterator[pa.RecordBatch]:
        """The rows of a task; Spark reads a plan without tasks by one task without windows."""
        for start, end in windows.spans if windows else []:
            after = None
            while True:
                rows = self.transport.page(windows.column, start, end, windows.ceiling, self.limit, after)
                if rows:
                    yield self._batch(rows)
                    after = rows[-1][KEY]
                if len(rows) < self.limit:
                    break

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        def value(row: dict, path: str) -> str | None:
            parent, dot, child = path.partition(".")
            found = (row.get(parent) or {}).get(child) if dot else row.get(path)
            return found if found is None or isinstance(found, str) else json.dumps(found)

        names = self.schema.names
        columns = [pa.array([value(row, name) for row in rows], pa.string()) for name in names]
        return pa.RecordBatch.from_arrays(columns, names=names)


class _BatchReader(DataSourceReader):
    def __init__(self, feed: FeedReader, options: dict) -> None:
        self.feed, self.options = feed, options

    def partitions(self) -> list[Windows]:
        o = self.options
        spans = millisecond_windows(o["start"], o["end"], int(o.get("days", BACKFILL_DAYS)))
        return self.feed.plan(o["column"], spans, o["ceiling"])

    def read(self, partition: Windows) -> Iterator[pa.RecordBatch]:
        return self.feed.fetch(partition)


def _stamp(value: object) -> str | None:
    """A text that sorts among stamps as the stamp given here does, or None.

    Stamps are ISO texts to the millisecond. A part of one, such as a day, stands for its first
    millisecond: at or after it, and before it, mean the same for both.
    """
    if not isinstance(value, str) or not _STAMP.fullmatch(value):
        return None
    text = value.removesuffix("Z")
    text += _LEAST[len(text) :]
    return text if is_moment(text) else None


class _FilteredReader(DataSourceReader):
    """The feed under the tests of a query: those on time columns become the window that is asked for.

    A window holds all rows that pass, and may hold some that do not, so Spark tests rows again.
    """

    def __init__(self, feed: FeedReader, options: dict) -> None:
        self.feed, self.options = feed, options
        self.least: dict[str, str] = {}
        self.greatest: dict[str, str] = {}

    def pushFilters(self, filters: list[Filter]) -> list[Filter]:
        for one in filters:
            column = getattr(one, "attribute", ("",))[0]
            if column in TIMES:
                values = list(one.value) if isinstance(one, In) else [getattr(one, "value", None)]
                stamps = [_stamp(value) for value in values]
                if stamps and None not in stamps:
                    self._bound(column, one, min(stamps), max(stamps))
        return filters

    def _bound(self, column: str, one: Filter, least: str, greatest: str) -> None:
        if isinstance(one, (EqualTo, In, GreaterThan, GreaterThanOrEqual)):
            self.least[column] = max(least, self.least.get(column, least))
        if isinstance(one, (EqualTo, In, LessThan, LessThanOrEqual)):
            self.greatest[column] = min(greatest, self.greatest.get(column, greatest))

    def _column(self) -> str:
        """The column with both ends bounded, else with one; change times, which every row has, if none is."""
        known = [column for column in TIMES if column in self.least or column in self.greatest]
        both = [column for column in known if column in self.least and column in self.greatest]
        return (both or known or [UPDATED])[0]

    def partitions(self) -> list[Windows]:
        transport, column = self.feed.transport, self._column()
        newest = transport.extreme("max", UPDATED)
        if newest is None:
            return []
        ceiling = min(newest.removesuffix("Z"), self.greatest.get(UPDATED, newest))
        ends = [self.least.get(column), self.greatest.get(column)]
        for place, which in enumerate(("min", "max")):
            if ends[place] is None:
                found = ceiling if (which, column) == ("max", UPDATED) else transport.extreme(which, column)
                if found is None:
                    return []
                ends[place] = found.removesuffix("Z")
        if ends[0] > ends[1]:
            return []
        spans = millisecond_windows(ends[0], ends[1], int(self.options.get("days", BACKFILL_DAYS)))
        return self.feed.plan(column, spans, ceiling)

    def read(self, partition: Windows) -> Iterator[pa.RecordBatch]:
        return self.feed.fetch(partition)


class _ChangeReader(DataSourceStreamReader):
    """Rows by change time. The offset is a change time, and the ceiling of the batch that ends there.

    With `batch_rows` a batch ends at the last change time up to which there are no more rows than
    that, found by some forty counts; changes of one millisecond stay together. `until` is a change
    time beyond which nothing is read.
    """

    def __init__(self, feed: FeedReader, options: dict) -> None:
        self.feed, self.options = feed, options
        self.batch_rows = int(options.get("batch_rows", 0))
        self.position: str | None = None

    def initialOffset(self) -> dict:
        return {"mark": self.options.get("since", "")}

    def latestOffset(self) -> dict:
        position = self.options.get("since", "") if self.position is None else self.position
        newest = self.feed.transport.extreme("max", UPDATED)
        if not newest:
            return {"mark": position}
        newest = min(newest.removesuffix("Z"), self.options.get("until") or newest)
        if not self.batch_rows or newest <= position:
            return {"mark": max(newest, position)}
        return {"mark": self._reached(self._begin(position), newest)}

    def _begin(self, mark: str) -> str:
        """The first change time after a mark."""
        return next_millisecond(mark) if mark else self.feed.transport.extreme("min", UPDATED).removesuffix("Z")

    def _reached(self, begin: str, newest: str) -> str:
        def fits(end: str) -> bool:
            return self.feed.transport.count(UPDATED, begin, end, end) <= self.batch_rows

        if begin >= newest or fits(newest):
            return newest
        # Up to `low` all is taken; up to `high` there are too many.
        low, high = before_millisecond(begin), newest
        while next_millisecond(low) < high:
            between = middle(low, high)
            low, high = (between, high) if fits(between) else (low, between)
        taken = low >= begin and self.feed.transport.count(UPDATED, begin, low, low)
        return low if taken else high

    def partitions(self, start: dict, end: dict) -> list[Windows]:
        """Spark asks for (offset, offset) when it goes on from a checkpoint, and so tells the offset."""
        mark, ceiling = start["mark"], end["mark"]
        self.position = ceiling
        if not ceiling or (mark and ceiling <= mark):
            return []
        days = int(self.options.get("days", BACKFILL_DAYS))
        return self.feed.plan(UPDATED, millisecond_windows(self._begin(mark), ceiling, days), ceiling)

    def read(self, partition: Windows) -> Iterator[pa.RecordBatch]:
        return self.feed.fetch(partition)


def feed_source(transport: Transport, name: str = "incident_feed") -> type[DataSource]:
    """A data source class bound to a transport, to be registered with `spark.dataSource`."""

    class FeedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return FLAT_FEED

        def _feed(self, schema: StructType) -> FeedReader:
            given = {
                name: int(self.options[name])
                for name in ("limit", "task_rows", "max_pages", "max_requests")
                if self.options.get(name)
            }
            return FeedReader(transport, schema, **given)

        def reader(self, schema: StructType) -> DataSourceReader:
            kind = _BatchReader if self.options.get("column") else _FilteredReader
            return kind(self._feed(schema), dict(self.options))

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _ChangeReader(self._feed(schema), dict(self.options))

    return FeedSource


def _flat(schema: StructType) -> StructType:
    """Nested fields under dotted names, all text."""
    fields = []
    for field in schema.fields:
        if isinstance(field.dataType, StructType):
            fields += [f"{field.name}.{name}" for name in field.dataType.names]
        else:
            fields.append(field.name)
    return StructType([StructField(name, StringType()) for name in fields])


FLAT_FEED = _flat(RAW_FEED)


@dataclass(frozen=True)
class PagedFeed:
    """A feed behind a transport, read page by page on the executors; see `FeedReader`."""

    spark: SparkSession
    transport: Transport
    name: str = "incident_feed"
    days: int = BACKFILL_DAYS
    limit: int = PAGE_ROWS
    task_rows: int = TASK_ROWS
    max_pages: int | None = None
    max_requests: int | None = None
    batch_rows: int | None = None

    def __post_init__(self) -> None:
        self.spark.dataSource.register(feed_source(self.transport, self.name))

    def _options(self, **more: str) -> dict:
        names = ("days", "limit", "task_rows", "max_pages", "max_requests", "batch_rows")
        own = {name: getattr(self, name) for name in names}
        return {name: value for name, value in {**own, **more}.items() if value is not None}

    def bounds(self, column: str) -> tuple[str | None, str | None]:
        least, greatest = (self.transport.extreme(which, column) for which in ("min", "max"))
        return least and least.removesuffix("Z"), greatest and greatest.removesuffix("Z")

    def between(self, column: str, start: str, end: str, ceiling: str) -> DataFrame:
        options = self._options(column=column, start=start, end=end, ceiling=ceiling)
        return self.spark.read.format(self.name).options(**options).load()

    def rows(self) -> DataFrame:
        """The feed as it is when a query on it is planned.

        What a query asks of the time columns, compared as texts, reaches the service as the window of
        the read and the ceiling of change times. For that, filter push-down to Python sources is
        turned on in the session; Spark has no such option for one read.
        """
        self.spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        return self.spark.read.format(self.name).options(**self._options()).load()

    def changes(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """The feed as a stream of changed rows, after `since` and up to `until`, `batch_rows` at a time."""
        options = self._options(since=since or "", until=until)
        return self.spark.readStream.format(self.name).options(**options).load()


@dataclass(frozen=True)
class LandedFeed:
    """A feed whose pages already lie in files, as read by `sources.files.read_pages`."""

    pages: DataFrame

    @classmethod
    def landed(cls, spark: SparkSession, path: str, arrays: bool = True) -> LandedFeed:
        """Pages parsed once, and kept as Parquet in the shared folder for the reads that follow."""
        folder = new_folder(spark, "landed")
        read_pages(spark, path, RAW_FEED, arrays).write.parquet(folder)
        return cls(spark.read.schema(RAW_FEED).parquet(folder))

    @staticmethod
    def _text(column: str) -> Column:
        """ISO text sorts as time does; a trailing Z is cut before comparing."""
        return F.rtrim(F.col(quoted(column)), F.lit("Z"))

    def bounds(self, column: str) -> tuple[str | None, str | None]:
        text = self._text(column)
        return tuple(self.pages.agg(F.min(text), F.max(text)).first())

    def between(self, column: str, start: str, end: str, ceiling: str) -> DataFrame:
        return self.pages.where(self._text(column).between(start, end) & (self._text(UPDATED) <= ceiling))
