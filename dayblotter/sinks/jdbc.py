"""Writing to a relational database through Spark's JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dayblotter.fixed_values import WRITE_BATCH_ROWS
from dayblotter.functions.columns import missing_to_null


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    batch_rows: int = WRITE_BATCH_ROWS,
    connections: int = 8,
) -> dict[str, str]:
    """`batch_rows` go in one statement, `connections` tasks write at a time."""
    if batch_rows <= 0:
        raise ValueError("a batch holds at least one row")
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    missing_to_null(df).write.format("jdbc").options(**options).mode("append").save()
