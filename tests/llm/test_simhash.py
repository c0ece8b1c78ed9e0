import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dayblotter.llm import simhash
from dayblotter.llm.common import components, stored
from dayblotter.llm.simhash import fingerprint_of, links, simhash_groups
from llm_data import frame, odd_rows, prose, with_clash, words


def slow_fingerprint(text, size=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = words(low)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(one.encode(), 42) for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize("text", [None, "", "  ", "a", "a b", "A b C d a b c", "é É ẞ ſ", prose(3, 500), "x " * 1000])
def test_fingerprint(text):
    assert fingerprint_of(text, 3) % (1 << 64) == slow_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = prose(4, 300)
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    assert fingerprint_of(text, 3) % (1 << 64) == slow_fingerprint(text)


@pytest.mark.parametrize("full_cell", [0, 2, 16, 10**6])
@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_links_connect_what_is_near(spark, full_cell, max_bits):
    rng = np.random.default_rng(max_bits)
    numbers = set()
    for _ in range(12):  # families of fingerprints that differ in a few bits
        head = int(rng.integers(0, 1 << 63)) * 2
        for _ in range(12):
            numbers.add(head)
            head ^= sum(1 << int(bit) for bit in rng.choice(64, rng.integers(1, 5), replace=False))
    numbers |= {0, (1 << 64) - 1, 1, 3, 7, (1 << 64) - 2}
    signed = sorted(n - (1 << 64) if n >> 63 else n for n in numbers)
    got = links(spark.createDataFrame([(n,) for n in signed], "fp long"), max_bits, full_cell).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= max_bits]
    assert {(row["a"], row["b"]) for row in got} <= set(near)
    assert classes(signed, got) == classes(signed, near)


def test_counts_of_both_cuts(spark):
    numbers = [0, -1, 1, 1 << 62, 0x123456789ABCDEF, -(1 << 63), -0x123456789ABCDEF]
    got = spark.createDataFrame([(n,) for n in numbers], "fp long").select(
        "fp", simhash._segment_counts(F.col("fp")).alias("near"), simhash._strided_counts(F.col("fp")).alias("far")
    )
    for fp, near, far in got.collect():
        bits = [fp >> place & 1 for place in range(64)]
        assert [near >> 4 * n & 15 for n in range(16)] == [sum(bits[4 * n : 4 * n + 4]) for n in range(16)]
        assert [far >> 4 * n & 15 for n in range(16)] == [sum(bits[n::16]) for n in range(16)]


def test_a_crowded_cell_is_divided_by_the_second_cut(spark, monkeypatch):
    # Equal popcounts in segments of four neighbouring bits, but far from one another by another cut.
    rng = np.random.default_rng(7)
    heads = {sum(1 << int(4 * n + rng.integers(4)) for n in range(16)) for _ in range(300)}
    signed = sorted(n - (1 << 64) if n >> 63 else n for n in heads | {n ^ 3 << 20 for n in heads})
    prints = spark.createDataFrame([(n,) for n in signed], "fp long")
    asked = []
    plain = simhash._by_bit_strings
    monkeypatch.setattr(simhash, "_by_bit_strings", lambda left, bits: asked.append(left) or plain(left, bits))
    got = links(prints, 2, 64).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2]
    assert {(row["a"], row["b"]) for row in got} == set(near) and near
    assert asked[0].count() == 0


def test_a_hub_is_split(spark):
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        edges = spark.range(1, 400_001).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "components")
        joined = both.join(least, "a")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        roots = components(edges)
        assert roots.where("root <> 0").isEmpty() and roots.count() == 400_001
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_components(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 7), (200, 200), (300, 301), (301, 300), (None, 5), (-4, 300)]
    got = {row["node"]: row["root"] for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for edge in edges for n in edge if n is not None} - {200}
    plain = [(a, b) for a, b in edges if a is not None]
    expected = classes(nodes | {200}, plain)
    assert got == {node: expected[node] for node in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_groups_of_odd_rows(spark):
    rows = odd_rows()
    docs = with_clash(frame(spark, rows), "fingerprint", "component_id", "keep")
    got = simhash_groups(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "fingerprint", "component_id", "keep"]
    found = got.collect()
    assert len(found) == len(rows)
    zero = [row for row in found if row["fingerprint"] == "0" * 16]
    assert {row["component_id"] for row in zero} == {3}
    by_id = {row["doc_id"]: row for row in found}
    assert by_id[2]["component_id"] == by_id[1]["component_id"] == 1
    kept = [row["doc_id"] for row in found if row["keep"]]
    assert sorted(kept, key=str) == sorted({1, 3, 6, 7, 9, None}, key=str)
    alone = next(row for row in found if row["doc_id"] is None and row["text"])
    assert alone["component_id"] is None and alone["keep"]


def test_empty_table(spark):
    assert simhash_groups(frame(spark, [])).collect() == []


def test_carry(spark):
    got = simhash_groups(frame(spark, odd_rows()), carry=["source"])
    assert got.columns == ["source", "fingerprint", "component_id", "keep"]
    assert got.where(F.col("keep")).count() == 6
