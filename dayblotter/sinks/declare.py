"""Declaring catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayblotter.functions.columns import quoted, sql_literal
from dayblotter.schemas import TableSpec


def described(spark: SparkSession, name: str) -> dict[str, str] | None:
    """What the catalog says of a table or view, None if it has none of that name."""
    if not spark.catalog.tableExists(name):
        return None
    return {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {quoted(name)}").collect()}


def forget(spark: SparkSession, name: str) -> None:
    """Take a view, or a table over files that stay, out of the catalog.

    A managed table would go with its rows: that is an error.
    """
    known = described(spark, name)
    if known and known.get("Type") not in ("VIEW", "EXTERNAL"):
        raise ValueError(f"{name} is a managed table")
    if known:
        spark.sql(f"DROP {'VIEW' if known['Type'] == 'VIEW' else 'TABLE'} {quoted(name)}")


def create_view(spark: SparkSession, name: str, text: str, replace: bool = True) -> bool:
    """A view in the catalog, for every session; whether it was written.

    A temporary view of that name would hide it from this session, and is dropped; a declared table
    of that name gives way.
    """
    spark.catalog.dropTempView(name)
    known = described(spark, name)
    if known and not replace:
        return False
    if known and known.get("Type") != "VIEW":
        forget(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {text.strip().rstrip(';')}")
    return True


def declare_table(spark: SparkSession, spec: TableSpec, path: str, replace: bool = False) -> DataFrame:
    """The table over `path`, created with the declared columns when the catalog lacks it.

    A table that is there is left as it is; with `replace` it is declared anew, over `path`, if it
    lies elsewhere. Its files stay. Spark does not enforce keys; the key is kept as a table property
    for those who write.
    """
    name = quoted(spec.name)
    if replace:
        spark.catalog.dropTempView(spec.name)
        known = described(spark, spec.name)
        if known and known.get("Location", "").removeprefix("file:") != path.removeprefix("file:"):
            forget(spark, spec.name)
    if not spark.catalog.tableExists(spec.name):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spec.schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"LOCATION {sql_literal(path)} TBLPROPERTIES ('key' = {sql_literal(','.join(spec.keys))})"
        )
    return spark.table(spec.name)
