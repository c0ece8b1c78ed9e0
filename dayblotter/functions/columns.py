"""Whole-frame column helpers: headers, nested structs, declared schemas, missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayblotter.functions.numbers import nan_to_null


def quoted(*parts: str) -> str:
    """Column path whose parts may hold dots, colons or at signs."""
    return ".".join(f"`{part}`" for part in parts)


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def plain_header(name: str) -> str:
    return name.lower().replace(" ", "_")


def with_plain_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[plain_header(name) for name in df.columns])


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Struct fields become columns named parent.child; a missing struct gives NULL fields."""

    def leaves(fields, parents=()):
        for field in fields:
            path = (*parents, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType.fields, path)
            else:
                yield f"{quoted(*path)} as {quoted(separator.join(path))}"

    return df.selectExpr(*leaves(df.schema.fields))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and cast. Absent ones are NULL, unknown ones an error."""
    present = set(df.columns)
    unknown = present - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in the declared schema: {sorted(unknown)}")
    return df.selectExpr(
        *[
            f"cast({quoted(f.name) if f.name in present else 'null'} as {f.dataType.simpleString()})"
            f" as {quoted(f.name)}"
            for f in schema.fields
        ]
    )


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({name: nan_to_null(F.col(quoted(name))) for name in floats})
