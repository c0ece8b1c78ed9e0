import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dayblotter.llm.sharding import directory, extendible_shards, write_shards
from dayblotter.session import new_folder
from llm_data import frame, odd_rows, with_clash


def key_bits(number):
    text = "{}" if number is None else f'{{"doc_id":"{number}"}}'
    return bin(int(hashlib.md5(text.encode()).hexdigest()[:15], 16))[2:].zfill(60)


def test_shards_are_the_shortest_prefixes_that_fit(spark):
    sizes = {number: 1 + number * 37 % 100 for number in range(400)}
    docs = spark.createDataFrame(list(sizes.items()), "doc_id long, size long")
    got = extendible_shards(docs, ["doc_id"], F.col("size"), limit=300).collect()
    held = defaultdict(int)
    for number, size in sizes.items():
        for length in range(61):
            held[key_bits(number)[:length]] += size
    for row in got:
        bits = key_bits(row["doc_id"])
        length = next(n for n in range(61) if held[bits[:n]] <= 300)
        assert (row["shard"], row["shard_depth"], row["shard_bytes"]) == (bits[:length], length, held[bits[:length]])
    assert len(got) == 400


@pytest.mark.parametrize("look_ahead", [1, 3])
def test_a_hot_key_is_split_until_it_fits(spark, look_ahead):
    docs = spark.range(900).select(F.when(F.col("id") < 600, "hot").otherwise(F.col("id").cast("string")).alias("source"))
    got = extendible_shards(docs, ["source"], F.lit(10), limit=500, look_ahead=look_ahead).collect()
    assert Counter(row["source"] for row in got)["hot"] == 600
    byte_sums = Counter()
    for row in got:
        byte_sums[row["shard"]] += 10
    assert all(total <= 500 for total in byte_sums.values())
    assert all(row["shard_bytes"] == byte_sums[row["shard"]] for row in got)
    shards = sorted(byte_sums)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))


def test_odd_rows(spark):
    docs = with_clash(frame(spark, odd_rows()), "shard", "shard_bytes", "_row")
    got = extendible_shards(docs, ["doc_id"], F.octet_length("text"), limit=1000)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "shard_depth", "shard_bytes"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    big = [row for row in rows if row["doc_id"] == 6]
    assert big[0]["shard_bytes"] > 1000  # alone in its shard
    assert sum(row["shard"] == big[0]["shard"] for row in rows) == 1


def test_empty_table(spark):
    assert extendible_shards(frame(spark, []), ["doc_id"], F.lit(1)).collect() == []


def test_directory_has_every_slot_once(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"))
    shards = extendible_shards(docs, ["doc_id"], F.lit(1), limit=40)
    slots = {row["slot"]: row["shard"] for row in directory(shards).collect()}
    deepest = max(len(shard) for shard in slots.values())
    assert sorted(slots) == list(range(2**deepest))
    for slot, shard in slots.items():
        assert bin(slot)[2:].zfill(deepest).startswith(shard)


def test_shards_as_files(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"))
    shards = extendible_shards(docs, ["doc_id"], F.lit(1), limit=40)
    path = new_folder(spark, "shards")
    write_shards(shards, path)
    read = spark.read.option("basePath", path).parquet(path)
    assert read.groupBy("shard").count().agg(F.max("count")).first()[0] <= 40
    assert sorted((r["doc_id"], r["shard"]) for r in read.collect()) == sorted((r["doc_id"], "b" + r["shard"]) for r in shards.collect())
