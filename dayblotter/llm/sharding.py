"""Sharding by extendible hashing.

Every row has a string of bits: the hash of its key, then the hash of its row number. A shard is a
prefix of such strings. A prefix whose rows are over the byte limit is split on one more bit, and no
other prefix is, until every shard fits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayblotter.llm.common import numbered, stored, table, without

SHARD_BYTES = 64 << 20
_ADDED = ["shard", "shard_depth", "shard_bytes"]
_HASH_DIGITS = 15  # hexadecimal digits of a hash that are used, 60 bits


def _bits(text: Column) -> Column:
    digest = F.substring(F.md5(text), 1, _HASH_DIGITS)
    return F.lpad(F.conv(digest, 16, 2), 4 * _HASH_DIGITS, "0")


def extendible_shards(
    rows: DataFrame,
    keys: Sequence[str],
    size: Column,
    limit: int = SHARD_BYTES,
    look_ahead: int = 3,
) -> DataFrame:
    """Rows with `shard` (its prefix of bits), `shard_depth` and `shard_bytes`.

    `size` is a row's bytes; null counts as 0. Rows with one key lie together while they fit; those
    of a key that is over the limit by itself are told apart by their row number, so no key is too
    hot. A single row over the limit has a shard of its own. Null key parts are values like any
    other. Repeated rows are all kept. Input columns named like added ones give way to them. An empty
    table gives an empty table.

    Each pass sums sizes by `depth` more bits for the prefixes that are still too large, enough bits
    for all of them at even hashing, and finds the shortest prefixes that fit. Rows whose first
    `depth` bits are too heavy go to the next pass, which begins where their bits first differ. A
    pass sends sums and then rows, with the table of prefixes joined to them; the number of prefixes
    follows the number of shards, not of rows.
    """
    parts = F.to_json(F.struct(*[F.col(f"`{key}`").cast("string").alias(key) for key in keys]))
    kept = without(rows, [*_ADDED, "_size", "_bits", "_base", "_from", "_cell", "_row", "_split"])
    work = numbered(
        kept.withColumn("_size", F.coalesce(size.cast("long"), F.lit(0))).withColumn("_bits", _bits(parts)),
        "_row",
        "sharding",
    ).withColumn("_bits", F.concat("_bits", _bits(F.col("_row").cast("string"))))
    total = work.agg(F.sum("_size")).first()[0] or 0
    depth = max(1, math.ceil(math.log2(max(1, total / limit))) + look_ahead)
    left = work.withColumn("_base", F.lit("")).withColumn("_from", F.lit(0))
    done = []
    while True:
        cells = stored(_cells(left, depth), "sharding")
        homes = stored(_homes(cells, limit), "sharding")
        dealt = left.withColumn("_cell", F.expr(f"substring(_bits, 1, _from + {depth})")).join(
            homes, "_cell"
        )
        done.append(dealt.where("shard is not null"))
        if homes.where("shard is null").isEmpty():
            break
        left = dealt.where("shard is null").select(
            *work.columns, F.col("_cell").alias("_base"), F.col("_split").alias("_from")
        )
        left = stored(left, "sharding")
        depth = max(1, look_ahead)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(
        *[f"`{name}`" for name in kept.columns],
        "shard",
        F.length("shard").alias("shard_depth"),
        "shard_bytes",
    )


def _cells(left: DataFrame, depth: int) -> DataFrame:
    """Bytes by the longest prefix looked at in this pass, and how many bits its rows share."""
    shared = F.expr(
        "coalesce(nullif(array_position(transform(sequence(1, length(_low)), "
        "i -> substring(_low, i, 1) = substring(_high, i, 1)), false), 0) - 1, length(_low))"
    )
    return (
        left.groupBy("_base", "_from", F.expr(f"substring(_bits, 1, _from + {depth})").alias("_cell"))
        .agg(
            F.sum("_size").alias("_bytes"),
            F.count(F.lit(1)).alias("_rows"),
            F.min("_bits").alias("_low"),
            F.max("_bits").alias("_high"),
        )
        .withColumn("_split", shared)
        .drop("_low", "_high")
    )


def _homes(cells: DataFrame, limit: int) -> DataFrame:
    """For each longest prefix the shortest one that fits; none if it is itself too large.

    A prefix that a row has alone fits whatever its size.
    """
    steps = cells.select(
        "_cell", "_bytes", "_rows", F.explode(F.expr("sequence(_from, length(_cell))")).alias("_length")
    ).withColumn("_prefix", F.expr("substring(_cell, 1, _length)"))
    fits = (
        steps.groupBy("_prefix")
        .agg(F.sum("_bytes").alias("_sum"), F.sum("_rows").alias("_count"))
        .where((F.col("_sum") <= limit) | (F.col("_count") == 1))
    )
    best = (
        steps.join(fits, "_prefix")
        .groupBy("_cell")
        .agg(F.min(F.struct("_length", "_prefix", "_sum")).alias("_best"))
        .select("_cell", F.col("_best._prefix").alias("shard"), F.col("_best._sum").alias("shard_bytes"))
    )
    return cells.select("_cell", "_split").join(best, "_cell", "left")


def write_shards(shards: DataFrame, path: str) -> None:
    """A folder of files for each shard, `shard=...`; a shard is written by one task, being bounded."""
    shards.withColumn("shard", F.concat(F.lit("b"), "shard")).repartition("shard").write.partitionBy("shard").parquet(path)


def directory(shards: DataFrame) -> DataFrame:
    """(slot, shard): the directory of 2^depth slots, depth being that of the deepest shard.

    Every slot points to the shard whose prefix its bits begin with. For shards no deeper than 30
    bits; keys that are split by row number make deeper ones, which stay in the table of shards.
    """
    leaves = shards.select("shard", "shard_depth").distinct().where("shard_depth <= 30")
    deepest = leaves.agg(F.max("shard_depth").alias("_deepest"))
    return leaves.join(deepest).select(
        F.explode(
            F.expr(
                "sequence(shiftleft(bigint(coalesce(conv(nullif(shard, ''), 2, 10), '0')), _deepest - shard_depth), "
                "shiftleft(bigint(coalesce(conv(nullif(shard, ''), 2, 10), '0')) + 1, _deepest - shard_depth) - 1)"
            )
        ).alias("slot"),
        "shard",
    )


def op1_extendible_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size_bytes")
    )
    return extendible_shards(docs, ["doc_id"], F.col("size_bytes"))


ORACLE = f"""
with rows as (
  select doc_id, coalesce(strlen(text), 0)::bigint as size_bytes,
         ('0x' || substr(md5(case when doc_id is null then '{{}}' else '{{"doc_id":"' || doc_id || '"}}' end), 1, {_HASH_DIGITS}))::bigint as h
  from documents
), steps as (
  select r.*, d, h >> (60 - d) as prefix from rows r, range(0, 41) t(d)
), sums as (
  select *, sum(size_bytes) over (partition by d, prefix) as b, count(*) over (partition by d, prefix) as n from steps
), ranked as (
  select *, row_number() over (partition by doc_id order by d) as k from sums where b <= {SHARD_BYTES} or n = 1
)
select doc_id, size_bytes, substr(h::bit::varchar, 5, d) as shard, d::int as shard_depth, b::bigint as shard_bytes
from ranked where k = 1
"""
