"""Keyed merge of change records, as one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayblotter.functions.columns import quoted


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest record of every key.

    The greatest struct (newest columns first, then the rest) is taken per key. Taking a maximum
    combines on the map side, so a key with a third of all records costs one row per task in the
    shuffle, and the answer does not depend on the order of arrival.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    ranked = [*newest, *[name for name in others if name not in newest]]
    best = F.expr(f"max(struct({', '.join(quoted(name) for name in ranked)}))").alias("_best")
    return (
        df.groupBy(*[quoted(name) for name in keys])
        .agg(best)
        .selectExpr(
            *[
                quoted(name) if name in keys else f"{quoted('_best', name)} as {quoted(name)}"
                for name in df.columns
            ]
        )
    )


def stack_changes(
    target: DataFrame, changes: DataFrame, newest: Sequence[str], stale: str = "keep"
) -> tuple[DataFrame, list[str]]:
    """Target and changes in one frame, and the columns that decide between two records of a key.

    stale="keep" leaves a stored record that is newer than its change; of equally new ones the
    change wins. stale="replace" lets the newest change win whatever is stored.
    """
    if stale not in ("keep", "replace"):
        raise ValueError("stale is 'keep' or 'replace'")
    both = target.withColumn("_incoming", F.lit(0)).unionByName(
        changes.withColumn("_incoming", F.lit(1)), allowMissingColumns=True
    )
    return both, [*newest, "_incoming"] if stale == "keep" else ["_incoming", *newest]


def merge_latest(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    stale: str = "keep",
) -> DataFrame:
    """Target with changes merged in by key."""
    both, order = stack_changes(target, changes, newest, stale)
    return latest_per_key(both, keys, order).drop("_incoming")
