"""Counts by key, and the windows that rank them.

Windows without a partition run on one task. They are applied to counts only, whose rows are as
many as there are groups, never to incidents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str | Column], counted: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def dense_rank_by(*order: Column) -> Column:
    return F.dense_rank().over(Window.orderBy(*order)).cast("bigint")


def most_first(count: str, label: str) -> list[Column]:
    """Greatest count first, the label in the alphabet between equals."""
    return [F.col(count).desc(), F.col(label).asc_nulls_last()]


def lag_change(counts: DataFrame, order: Sequence[str], count: str) -> DataFrame:
    """Each count beside the one of the group before it, and the difference."""
    previous = F.lag(count).over(Window.orderBy(*order))
    return counts.withColumn(f"prev_{count}", previous).withColumn(
        "diff", F.col(count) - F.col(f"prev_{count}")
    )


def top_two(counts: DataFrame, group: str, label: str, count: str) -> DataFrame:
    """The labels with the greatest and second greatest count of every group.

    `row_number() <= 2` lets Spark cut each group to two rows before the shuffle, so a group with
    many labels does not have to fit one task.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(*most_first(count, label)))
    return (
        counts.withColumn("_place", place)
        .where(F.col("_place") <= 2)
        .groupBy(group)
        .agg(
            F.max(F.when(F.col("_place") == 1, F.col(label))).alias("first_label"),
            F.max(F.when(F.col("_place") == 2, F.col(label))).alias("second_label"),
        )
    )


def first_and_second_value(counts: DataFrame, group: str, label: str, count: str) -> DataFrame:
    """As `top_two`, spelled with first_value and nth_value over the whole group.

    Every row of a group sits in one task here; meant for groups of a few labels.
    """
    whole = (
        Window.partitionBy(group)
        .orderBy(*most_first(count, label))
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return counts.select(
        group,
        F.first(label).over(whole).alias("first_label"),
        F.nth_value(label, 2).over(whole).alias("second_label"),
    ).distinct()
