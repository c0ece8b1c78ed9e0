"""Cutting a span of time into pieces of a fixed number of days."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _days(count: int) -> Column:
    if count <= 0:
        raise ValueError("a piece must be at least one day long")
    return F.make_dt_interval(F.lit(count))


def split_span(bounds: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """One row per piece of [start, end], which `bounds` holds in one row.

    `end_time` closes a piece one millisecond before the next begins, the form a source with an
    inclusive BETWEEN and millisecond stamps wants. `next_start` is the open end, for stamps that
    are finer than that. The last piece ends at `end`. No piece when start is not before end.
    """
    step = _days(days)
    first, last = F.col(start), F.col(end)
    pieces = F.when(first < last, F.sequence(F.lit(0), F.call_function("div", last - first, step).cast("int")))
    begin = (first + F.col("piece") * step).alias("start_time")
    is_last = F.col("start_time") + step >= last
    return (
        bounds.select(start, end, F.explode(pieces).alias("piece"))
        .select(start, end, "piece", begin)
        .where(F.col("start_time") < last)
        .select(
            F.col("piece"),
            F.col("start_time"),
            F.when(is_last, last)
            .otherwise(F.col("start_time") + step - F.expr("INTERVAL '0.001' SECOND"))
            .alias("end_time"),
            F.when(~is_last, F.col("start_time") + step).alias("next_start"),
        )
    )


def piece_number(ts: Column, first: Column, last: Column, days: int) -> Column:
    """Which piece of `split_span` a time falls in, by arithmetic instead of a range join."""
    piece = F.call_function("div", ts - first, _days(days))
    # A span that is a whole number of pieces ends inside the last one.
    final = F.call_function("div", last - first - F.expr("INTERVAL '0.000001' SECOND"), _days(days))
    return F.least(piece, final).cast("int")


def within(column: Column, start, end) -> Column:
    """Inclusive at both ends; reaches the Parquet scan as two pushed filters."""
    return column.between(start, end)


_ISO = "%Y-%m-%dT%H:%M:%S.%f"


def _text(moment: datetime) -> str:
    return moment.strftime(_ISO)[:-3]


def _moment(text: str) -> datetime:
    return datetime.strptime(text.removesuffix("Z"), _ISO)


def next_millisecond(text: str) -> str:
    return _text(_moment(text) + timedelta(milliseconds=1))


def before_millisecond(text: str) -> str:
    return _text(_moment(text) - timedelta(milliseconds=1))


def middle(start: str, end: str) -> str:
    """The millisecond halfway between two, rounded down."""
    first = _moment(start)
    return _text(first + (_moment(end) - first) // 2)


def is_moment(text: str) -> bool:
    try:
        return _moment(text) is not None
    except ValueError:
        return False


def millisecond_windows(start: str, end: str, days: int) -> Iterator[tuple[str, str]]:
    """The pieces of `split_span` as texts, for requests; one when start is end."""
    if days <= 0:
        raise ValueError("a window must be at least one day long")
    first, last, step = _moment(start), _moment(end), timedelta(days=days)
    count = max(-((first - last) // step), 1)
    begins = [first + number * step for number in range(count)]
    closes = [begin - timedelta(milliseconds=1) for begin in begins[1:]]
    yield from zip(map(_text, begins), map(_text, [*closes, last]))


def halves(start: str, end: str) -> list[tuple[str, str]]:
    """A window cut in two; itself when it is a single millisecond."""
    if _moment(end) <= _moment(start):
        return [(start, end)]
    half = middle(start, end)
    return [(start, half), (next_millisecond(half), end)]
