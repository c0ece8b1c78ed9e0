"""File sources: CSV dimensions and landed pages of the feed."""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayblotter.fixed_values import MISSING_WORDS
from dayblotter.functions.columns import conform, quoted, with_plain_headers
from dayblotter.sources.large_csv import RANGE_BYTES, header_of, read_split

# The first line, line breaks within quotes included.
_HEADER = r'^\x{FEFF}?((?:[^"\r\n]|"[^"]*")*)'


def _by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the columns their header names. One row for each file reaches the driver."""
    if not paths:
        return {}
    text = spark.read.text(list(paths), wholetext=True)
    headers = text.select(
        F.col("_metadata.file_path"), F.regexp_extract("value", _HEADER, 1).alias("header")
    ).where("header <> ''")
    files = defaultdict(list)
    for path, header in headers.collect():
        files[tuple(next(csv.reader(io.StringIO(header))))].append(path)
    return files


def _by_size(spark: SparkSession, paths: Sequence[str], range_bytes: int) -> tuple[list[str], list[str]]:
    """The files that fit a range and those that do not, from a listing."""
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", "length").collect()
    small = [row["path"] for row in listed if 0 < row["length"] <= range_bytes]
    return small, [row["path"] for row in listed if row["length"] > range_bytes]


def _in_one_task(spark: SparkSession, files: Sequence[str], header: Sequence[str]) -> DataFrame:
    return (
        spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(list(files))
    )


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    missing: Sequence[str] = MISSING_WORDS,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One or many CSV files, each under its own header, stacked by name.

    Headers become lower case with underscores; a column that some files lack is NULL for them.
    Values are read as text, words for "missing" become NULL, and a declared schema casts the rest;
    nothing is inferred. A row with more or fewer cells than its header is an error. Empty files have
    no rows. Quoted values may hold line breaks: a file of up to `range_bytes` is read by one task, a
    larger one by a task for each range of that size, see `large_csv.read_split`.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    small, large = _by_size(spark, given, range_bytes)
    frames = [
        with_plain_headers(_in_one_task(spark, files, header))
        for header, files in sorted(_by_header(spark, small).items())
    ]
    alike = defaultdict(list)
    for path in large:
        header, separator = header_of(spark, path)
        alike[tuple(header), separator].append(path)
    for (header, separator), files in sorted(alike.items()):
        frames.append(with_plain_headers(read_split(spark, files, header, separator, range_bytes)))
    if not frames:
        if schema is None:
            raise ValueError(f"no header in {given}")
        return spark.createDataFrame([], schema)
    plain = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    known = plain.select(
        *[
            F.when(~F.col(quoted(name)).isin(*missing), F.col(quoted(name))).alias(name)
            for name in plain.columns
        ]
    )
    return known if schema is None else conform(known, schema)


def read_pages(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, arrays: bool = True
) -> DataFrame:
    """Landed pages of a JSON feed under a declared schema, one partition's worth of files a task.

    `arrays` pages hold one JSON array a file, as a paged service returns them; otherwise a page
    holds a record a line, which Spark can also split within a file. A page that is cut off, or is no
    JSON, is an error.
    """
    reader = spark.read.schema(schema).option("multiLine", arrays).option("mode", "FAILFAST")
    return reader.json(path)
