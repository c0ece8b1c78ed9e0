"""Row numbers and pages over a whole table, without one task holding the table."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayblotter.functions.columns import quoted, sql_literal

_ERROR = 0.0001
_LEAST_RANGES = 8
INDEX_RANGES = 4096


def number_rows(df: DataFrame, key: str, name: str = "row_number") -> DataFrame:
    """Rows numbered from 0 in the order of a unique key.

    Limits of as many ranges of the key as a shuffle has partitions are drawn up first, by an
    approximate pass over the key, and counted exactly in a second: both send a number for each range
    to the driver. With the limits as literals a row knows its range and how many rows come before
    it, and is numbered within; one shuffle, of whole rows, nothing written, no range in two tasks.
    """
    placed, limits = in_ranges(df, key)
    before = _rows_before(placed, len(limits))
    starts = F.expr(_array(before))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return placed.withColumn(name, F.get(starts, F.col("_range")) + within).drop("_range")


def in_ranges(df: DataFrame, key: str) -> tuple[DataFrame, list]:
    """The rows with `_range`, the number of their key's range, and the limits between ranges.

    There are as many ranges as a shuffle has partitions, of about as many rows each.
    """
    ranges = max(_LEAST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    limits = _limits(df, key, ranges)
    return df.withColumn("_range", _place(F.col(key), limits)), limits


def _rows_before(placed: DataFrame, limits: int) -> list[int]:
    """The rows before each of the ranges, and all of them at the end."""
    counts = {row[0]: row[1] for row in placed.groupBy("_range").count().collect()}
    return list(accumulate((counts.get(number, 0) for number in range(limits + 1)), initial=0))


def _place(key: Column, limits: list) -> Column:
    """How many limits lie below the key. Looks at groups of limits first and then into one: twice the
    square root of their number, not all of them."""
    if not limits:
        return F.lit(0)
    width = math.isqrt(len(limits) - 1) + 1
    groups = [limits[first : first + width] for first in range(0, len(limits), width)]

    def below(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda limit: limit < key))

    heads = F.expr(_array(group[-1] for group in groups))
    whole = below(heads)
    inside = F.expr(f"array({', '.join(map(_array, groups))})")
    within = F.when(whole < len(groups), below(F.get(inside, whole))).otherwise(0)
    return F.when(whole < len(groups), whole * width + within).otherwise(len(limits))


def _array(limits: Iterable) -> str:
    """Limits as one text of SQL: thousands of them would take long to build one by one."""

    def text(limit: Any) -> str:
        if isinstance(limit, str):
            return sql_literal(limit)
        if isinstance(limit, bool) or not isinstance(limit, (int, float, Decimal, date)):
            raise TypeError(f"keys of type {type(limit).__name__} are not dealt into ranges")
        if isinstance(limit, datetime):
            return f"timestamp_{'ntz' if limit.tzinfo is None else 'ltz'}'{limit.isoformat(sep=' ')}'"
        kinds = {int: f"{limit}L", float: f"double('{limit!r}')", Decimal: f"{limit:f}BD", date: f"date'{limit}'"}
        return kinds[type(limit)]

    return f"array({', '.join(map(text, limits))})"


def _limits(df: DataFrame, key: str, ranges: int) -> list:
    shares = [number / ranges for number in range(1, ranges)]
    kind = df.schema[key].dataType.typeName()
    if kind in ("string", "varchar", "char"):
        # No quantiles of texts: those of an evenly spread sample of keys, ranges * 100 of them.
        keys = df.select(F.col(key).alias("_key")).where("_key is not null")
        sample = keys.orderBy(F.xxhash64("_key")).limit(ranges * 100).collect()
        found = sorted(row[0] for row in sample)
        return sorted({found[int(share * len(found))] for share in shares}) if found else []
    asked = f"percentile_approx({quoted(key)}, {_array(shares)}, {int(1 / _ERROR)})"
    found = df.agg(F.expr(asked)).first()[0]
    return sorted(set(found or []))


def assign_pages(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Each row with the page of `limit` rows it is on, pages in key order from 0."""
    numbered = number_rows(df, key, "_row")
    return numbered.withColumn("page", F.call_function("div", F.col("_row"), F.lit(limit))).drop("_row")


def read_page(df: DataFrame, key: str, limit: int, page: int) -> DataFrame:
    """One page, for a reader who wants just that one: its rows, found by number, in order."""
    first = page * limit
    numbered = number_rows(df, key, "_row").where((F.col("_row") >= first) & (F.col("_row") < first + limit))
    return numbered.orderBy("_row").drop("_row")


@dataclass(frozen=True)
class PageIndex:
    """Limits between ranges of a key and how many rows come before each, the total last.

    It holds for the rows it was made of, in `INDEX_RANGES` ranges at most: a few kilobytes, which can be
    stored beside a table and read again.
    """

    limits: list[Any]
    before: list[int]

    @classmethod
    def of(cls, df: DataFrame, key: str, ranges: int = INDEX_RANGES) -> PageIndex:
        """Two passes over the key alone."""
        limits = _limits(df, key, ranges)
        return cls(limits, _rows_before(df.select(_place(F.col(key), limits).alias("_range")), len(limits)))

    def store(self, df: DataFrame, key: str, folder: str) -> PageIndex:
        fields = [T.StructField("place", T.IntegerType()), T.StructField("upto", df.schema[key].dataType), T.StructField("before", T.LongType())]
        rows = [(place, limit, rows) for place, (limit, rows) in enumerate(zip([*self.limits, None, None], self.before))]
        df.sparkSession.createDataFrame(rows, T.StructType(fields)).coalesce(1).write.parquet(folder)
        return self

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> PageIndex:
        rows = sorted(spark.read.parquet(folder).collect(), key=lambda row: row["place"])
        return cls([row["upto"] for row in rows[:-2]], [row["before"] for row in rows])

    @property
    def rows(self) -> int:
        return self.before[-1]

    def page(self, df: DataFrame, key: str, limit: int, page: int) -> DataFrame:
        """One page in the order of a unique key, from the ranges it lies in.

        The ends of these ranges are tests on the key, which reach the scan; what passes is numbered by
        itself, from the rows that come before. A page beyond the last is empty.
        """
        first, last = page * limit, min((page + 1) * limit, self.rows)
        if first < 0 or first >= last:
            return df.where("false")
        # Ranges without rows begin where the next one does.
        low = max(place for place, rows in enumerate(self.before[:-1]) if rows <= first)
        high = min(place for place, rows in enumerate(self.before) if rows >= last) - 1
        column = F.col(key)
        inside = F.lit(True)
        if low > 0:
            inside = inside & (column > F.lit(self.limits[low - 1]))
        if high < len(self.limits):
            below = column <= F.lit(self.limits[high])
            inside = inside & (below if low > 0 else below | column.isNull())
        some = df.where(inside).withColumn("_range", _place(column, self.limits[low:high]))
        starts = F.expr(_array(self.before[low : high + 1]))
        within = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
        row = F.get(starts, F.col("_range")) + within
        wanted = some.withColumn("_row", row).where((F.col("_row") >= first) & (F.col("_row") < last))
        return wanted.orderBy("_row").drop("_row", "_range")
