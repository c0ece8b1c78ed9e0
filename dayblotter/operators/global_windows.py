"""Windows over all rows of a table, in as many tasks as a shuffle has partitions.

`operators.ranking` ranks counts, which one task can hold. Here are the same windows for rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayblotter.operators.paging import in_ranges, number_rows
from dayblotter.session import new_folder


def dense_rank_rows(df: DataFrame, column: str, ascending: str | None = None, descending: str | None = None) -> DataFrame:
    """Rows with the dense rank of a column's value, from 1, under the names given.

    Distinct values are found with a combine before the shuffle and numbered by ranges; their number is
    the rank. They are stored and joined back, so a value that a third of all rows share is one row
    until then, and its rows are split by Spark as a skewed join. NULL comes first when ascending and
    last when descending, as in Spark's own window.
    """
    spark = df.sparkSession
    values, ranks = new_folder(spark, "values"), new_folder(spark, "ranks")
    df.select(F.col(column).alias("_value")).distinct().write.parquet(values)
    distinct = spark.read.parquet(values)
    number_rows(distinct, "_value", "_number").write.parquet(ranks)
    total = distinct.count()
    names = {ascending: F.col("_number") + 1, descending: F.lit(total) - F.col("_number")}
    ranked = spark.read.parquet(ranks).select("_value", *[rank.alias(name) for name, rank in names.items() if name])
    return df.join(ranked, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def previous_rows(df: DataFrame, key: str, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Rows beside the values that the row before them has, in the order of a unique key without NULL.

    Rows are dealt into ranges of the key, a task each. The last row of every range, one a range, goes
    by way of the driver to the first row of the next range that has rows.
    """
    placed, limits = in_ranges(df, key)
    last = F.max_by(F.struct(*columns), key).alias("last")
    ends = {row["_range"]: row["last"] for row in placed.groupBy("_range").agg(last).collect()}
    handed, before = [], None
    for number in range(len(limits) + 1):
        handed.append((number, *(before or [None] * len(columns))))
        before = ends.get(number, before)
    names = [f"_before_{place}" for place in range(len(columns))]
    fields = [T.StructField(name, df.schema[column].dataType) for name, column in zip(names, columns)]
    edges = df.sparkSession.createDataFrame(handed, T.StructType([T.StructField("_edge", T.IntegerType()), *fields]))
    order = Window.partitionBy("_range").orderBy(key)
    within = placed.withColumn("_first", F.row_number().over(order) == 1)
    for place, column in enumerate(columns):
        within = within.withColumn(f"_lag_{place}", F.lag(column).over(order))
    # The edges have a row for each range, as many as a shuffle has partitions.
    joined = within.join(F.broadcast(edges), F.col("_range") == F.col("_edge"))
    found = [
        F.when(F.col("_first"), F.col(name)).otherwise(F.col(f"_lag_{place}")).alias(f"{prefix}{column}")
        for place, (name, column) in enumerate(zip(names, columns))
    ]
    return joined.select(*[F.col(f"`{name}`") for name in df.columns], *found)
