"""CSV files of any size, read by as many tasks as Spark has ranges of bytes for them.

Quoted values may hold line breaks, so a range does not know whether it begins within a value. A first
pass counts the quotes of every range; a range begins within a value if the ranges before it hold an odd
number. With that known, a second pass cuts every range into records, from its first true start of a
record to its last end. What is left at its two ends are pieces of records that lie in several ranges:
one or two rows a range, which are put together by themselves.
"""

from __future__ import annotations

import csv
import io
import sys
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayblotter.session import first_characters, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 128 << 20
HEADER_CHARACTERS = 1 << 16
MOST_HEADER = 1 << 26
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3
_VALUE = r'(?:"(?:[^"]++|"")*+"|[^",\r\n]*+)'
_RECORD = rf"\A{_VALUE}(?:,{_VALUE})*+\z"
_PIECES = "range long, piece int, header boolean, record string"


def header_of(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """A file's column names and its line separator, from its first characters; no names for an empty file."""
    wanted = HEADER_CHARACTERS
    while True:
        text = first_characters(spark, path, wanted)
        end = _first_end(text)
        if end < len(text) or len(text) < wanted:
            break
        if wanted >= MOST_HEADER:
            raise ValueError(f"no end of the header in the first {wanted} characters of {path}")
        wanted *= 16
    names = next(csv.reader(io.StringIO(text[:end].removeprefix("﻿"), newline="")), [])
    return names, "\r" if text[end : end + 1] == "\r" and text[end : end + 2] != "\r\n" else "\n"


def _first_end(text: str) -> int:
    """Where the first line break outside quotes is, or the end."""
    within = False
    for place, one in enumerate(text):
        if one == '"':
            within = not within
        elif one in "\r\n" and not within:
            # A lone carriage return at the very end may be half of a line break.
            return len(text) if place == len(text) - 1 and one == "\r" else place
    return len(text)


def read_split(spark: SparkSession, paths: Sequence[str], names: Sequence[str], separator: str = "\n", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Files under one header as text columns, a range of `range_bytes` a task.

    Records are cut once and kept in the shared folder, so that both passes see the same ranges; each
    byte is read twice, no line is shuffled, and the driver gets one row a range. Values are read as by
    Spark's reader: quotes are doubled within quotes, empty lines are skipped, empty values are NULL. A row
    with more or fewer cells than the header is an error. So are an odd number of quotes in a file, and a
    quote within an unquoted value of a record of several lines, as it hides where records begin.
    """
    # Ranges follow from settings, which here are those of a session for this read alone.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    value = F.col("value")
    lines = own.read.option("lineSep", separator).text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), value
    )
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    number = F.xxhash64("path", "start").alias("range")
    counts = lines.groupBy("path", "start", number).agg(F.sum(quotes).alias("quotes")).collect()
    within = _within(counts)
    firsts = {row["range"] for row in counts if row["start"] == 0}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut_records(batches, within, firsts, separator)

    folder = new_folder(spark, "csv-records")
    lines.select(number, "value").mapInArrow(cut, _PIECES).write.parquet(folder)
    pieces = spark.read.schema(_PIECES).parquet(folder)
    places = spark.createDataFrame([(row["range"], row["path"], row["start"]) for row in counts], "range long, path string, start long")
    whole = pieces.where((F.col("piece") == WHOLE) & ~F.col("header")).select("record")
    return _parsed(whole.unionByName(_joined(pieces.where(F.col("piece") != WHOLE), places, separator)), names)


def _within(counts: Sequence) -> dict[int, bool]:
    """Whether each range begins within a quoted value: quotes are summed up file by file."""
    by_file = defaultdict(list)
    for row in counts:
        by_file[row["path"]].append((row["start"], row["range"], row["quotes"]))
    within = {}
    for path, ranges in by_file.items():
        ranges.sort()
        sums = list(accumulate((quotes for _, _, quotes in ranges), initial=0))
        if sums[-1] % 2:
            raise ValueError(f"{path} has an odd number of quotes")
        within.update({number: bool(before % 2) for (_, number, _), before in zip(ranges, sums)})
    if len(within) != len(counts):
        raise ValueError("two ranges have one number")
    return within


def cut_records(
    batches: Iterator[pa.RecordBatch], within: Mapping[int, bool], firsts: set[int], separator: str
) -> Iterator[pa.RecordBatch]:
    """Lines (range, value) in the order of their files as records, and as pieces of records at ends of ranges.

    A line ends a record if an even number of quotes lies before its end. Lines of a record are joined in
    Arrow, a batch at a time; only a record that goes on in the next batch is held.
    """
    current, open_lines, headless, inside, at_header = None, [], False, False, False

    def left() -> Iterator[pa.RecordBatch]:
        if current is not None and open_lines:
            yield _piece(current, MIDDLE if headless else TAIL, at_header, separator.join(open_lines))

    for batch in batches:
        numbers, values = batch.column(0).to_numpy(), batch.column(1)
        cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for first, last in zip(cuts, cuts[1:]):
            if first == last:
                continue
            if numbers[first] != current:
                yield from left()
                current, open_lines = int(numbers[first]), []
                headless = inside = within[current]
                at_header = current in firsts
            run = values.slice(first, last - first)
            counted = pc.count_substring(run, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            even = (np.cumsum(counted) + inside) % 2 == 0
            inside = not even[-1]
            ends = np.flatnonzero(even) + 1
            if not len(ends):
                open_lines += run.to_pylist()
                continue
            one = separator.join([*open_lines, *run.slice(0, int(ends[0])).to_pylist()])
            yield _piece(current, HEAD if headless else WHOLE, at_header and not headless, one)
            at_header = headless = False
            if len(ends) > 1:
                offsets = pa.array(ends - ends[0], pa.int32())
                records = pc.binary_join(pa.ListArray.from_arrays(offsets, run.slice(int(ends[0]), int(ends[-1] - ends[0]))), separator)
                yield _rows(current, WHOLE, False, records)
            open_lines = run.slice(int(ends[-1])).to_pylist()
    yield from left()


def _piece(number: int, piece: int, header: bool, text: str) -> pa.RecordBatch:
    return _rows(number, piece, header, pa.array([text], pa.string()))


def _rows(number: int, piece: int, header: bool, records: pa.Array) -> pa.RecordBatch:
    many = len(records)
    columns = [pa.array([one] * many, kind) for one, kind in ((number, pa.int64()), (piece, pa.int32()), (header, pa.bool_()))]
    return pa.RecordBatch.from_arrays([*columns, records.cast(pa.string())], names=["range", "piece", "header", "record"])


def _joined(pieces: DataFrame, places: DataFrame, separator: str) -> DataFrame:
    """Records that lie in several ranges: from a tail on to the head that ends it."""
    order = Window.partitionBy("path").orderBy("start", "piece")
    tails = F.sum((F.col("piece") == TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = pieces.join(places, "range").withColumn("_record", tails)
    parts = F.sort_array(F.collect_list(F.struct("start", "piece", "record")))
    return (
        placed.groupBy("path", "_record")
        .agg(F.array_join(F.transform(parts, lambda part: part["record"]), separator).alias("record"), F.max("header").alias("header"))
        .where("not header")
        .select("record")
    )


def _parsed(records: DataFrame, names: Sequence[str]) -> DataFrame:
    record = F.col("record")
    line = F.when(F.endswith(record, F.lit("\r")), F.left(record, F.length(record) - 1)).otherwise(record)
    cells = ", ".join(f"c{place} string" for place in range(len(names)))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST", "columnPruning": "false"}
    return (
        records.select(line.alias("record"))
        .where("record <> ''")
        .select(F.from_csv(_checked(F.col("record")), cells, options).alias("cells"))
        .select(*[F.col(f"cells.c{place}").alias(name) for place, name in enumerate(names)])
    )


def _checked(record: Column) -> Column:
    """The record; one of several lines has to be made of whole values, or lines of others may be in it."""
    refused = F.raise_error(F.concat(F.lit("malformed record, a quote within an unquoted value: "), F.left(record, F.lit(200))))
    several = record.contains("\n") | record.contains("\r")
    return F.when(several & ~record.rlike(_RECORD), refused.cast("string")).otherwise(record)
