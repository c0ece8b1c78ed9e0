"""High-water marks: what is stored, and what has changed since."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounds(df: DataFrame, occurred: str, updated: str) -> DataFrame:
    """First and last occurrence and the newest change, in one pass over two columns."""
    return df.agg(
        F.min(occurred).alias("min_occurred"),
        F.max(occurred).alias("max_occurred"),
        F.max(updated).alias("max_updated"),
    )


def high_water(stored: DataFrame, column: str) -> Any | None:
    """The greatest stored value, None when nothing is stored."""
    return stored.agg(F.max(column)).first()[0]


def changed_since(feed: DataFrame, column: str, mark: Any | None) -> DataFrame:
    """Rows strictly after the mark; all rows when there is none. The test reaches the scan."""
    return feed if mark is None else feed.where(F.col(column) > F.lit(mark))


def next_number(df: DataFrame, column: str, name: str) -> DataFrame:
    """Greatest value plus one; 1 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias(name))
