from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayblotter.llm import mixing
from dayblotter.llm.mixing import mix_sources, mixed_documents, permuted, rounded, targets
from conftest import SF_DIR
from llm_data import frame, odd_rows, prose, with_clash, words


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000])
def test_permutations(size):
    first = permuted(np.arange(size), size, 1)
    assert sorted(first) == list(range(size))
    if size > 16:
        assert first.tolist() != permuted(np.arange(size), size, 2).tolist() != list(range(size))
    part = permuted(np.arange(size)[size // 2 :], size, 1)
    assert part.tolist() == first[size // 2 :].tolist()


def test_targets():
    assert targets({"b": 100, "a": 100, None: 100}) == {"a": 50, "b": 100, None: 150}
    # c may not be above 30; the excess goes to a and b as 1 to 2.
    got = targets({"a": 200, "b": 370, "c": 10})
    assert got["c"] == 30 and got["a"] == pytest.approx(550 / 3) and got["b"] == pytest.approx(1100 / 3)
    got = targets({"a": 1, "b": 1, "c": 100})
    assert got["a"] == 3 and got["b"] == 3 and got["c"] == 96
    assert targets({"a": 0, "b": 5}) == {"a": 0, "b": 5}
    assert targets({}) == {}
    # Code points, not letters of a language; null is last.
    assert list(targets({"é": 9, "z": 9, "Z": 9, None: 9})) == ["Z", "z", "é", None]


def taken(mix):
    held = Counter()
    for row in mix.pieces.collect():
        held[row["_row"]] += row["words"]
    return held


def test_mix_is_near_its_targets(spark):
    rows = [(n, prose(n, 40 + n * 31 % 300), "hot" if n % 3 == 0 else f"s{n % 7}") for n in range(900)]
    docs = frame(spark, rows).repartition(3)
    mix = mix_sources(docs, block_words=16, shard_slots=256)
    got, held = {row["doc_id"]: row for row in mix.rows.collect()}, taken(mix)
    by_source = defaultdict(int)
    for row in got.values():
        assert row["size"] == len(words(row["text"])) and held[row["_row"]] <= 3 * row["size"]
        by_source[row["source"]] += held[row["_row"]]
    for row in got.values():
        assert by_source[row["source"]] == pytest.approx(row["target"], rel=0.02)
    # Repeatable, however the table is cut up.
    again = mix_sources(docs.repartition(7), block_words=16, shard_slots=256)
    anew = taken(again)
    assert {r["doc_id"]: anew[r["_row"]] for r in again.rows.collect()} == {n: held[r["_row"]] for n, r in got.items()}


def test_rounded_shares_add_up():
    assert rounded([3.0, 0.5, 0.5, 0.5, 0.5, 12.0]) in ([3, 1, 0, 1, 0, 12], [3, 0, 1, 0, 1, 12])
    shares = np.random.default_rng(1).random(500) * 9
    got = rounded(shares)
    assert sum(got) == round(shares.sum()) and max(abs(np.array(got) - shares)) < 1 + 1e-9
    assert rounded([]) == [] and rounded([0.0]) == [0]


def test_small_sources_over_thousands_of_shards(spark):
    # One block a document; the small ones are stopped at three passes.
    small = {"s1": 1, "s2": 4, "s3": 12}
    rows = [(n, prose(n, 4), "big") for n in range(9_000)]
    rows += [(10_000 + n, prose(n, 4), name) for name, number in small.items() for n in range(number)]
    mix = mix_sources(frame(spark, rows), block_words=4, shard_slots=4)
    pieces = mix.pieces.collect()
    assert len({row["shard"] for row in pieces}) > 2_000
    place = {name: at for at, name in enumerate(sorted(["big", *small]))}
    slots = {(row["source_place"], row["slot"], row["pass"], row["block"]) for row in pieces}
    found = Counter(at for at, _, _, _ in slots)
    assert {name: found[place[name]] for name in small} == {name: 3 * number for name, number in small.items()}
    assert len(slots) == len({(at, turn, block) for at, _, turn, block in slots}) == len(rows)
    assert set(Counter(shard for shard, _, _ in {(r["shard"], r["source_place"], r["slot"]) for r in pieces}).values()) <= {4, len(rows) % 4}
    held, docs = taken(mix), mix.rows.collect()
    assert all(held[row["_row"]] == 12 for row in docs if row["source"] in small)


def test_repeated_rows_spread_over_chunks(spark):
    rows = spark.range(60_000, numPartitions=5).select(
        (F.col("id") % 3 * 0 + 5).alias("_hash"), F.monotonically_increasing_id().alias("_row")
    )
    few = spark.createDataFrame([(7, 1 << 50), (8, (1 << 50) + 1), (7, 3 << 50)], "_hash long, _row long")
    got = mixing._copies(rows.unionByName(few)).select("_hash", "_copy", "_row").collect()
    assert sorted(r["_copy"] for r in got if r["_hash"] == 5) == list(range(60_000))
    assert sorted(r["_copy"] for r in got if r["_hash"] == 7) == [0, 1]
    assert len({r["_row"] for r in got}) == 60_003
    chunks = spark.createDataFrame(got).select(F.pmod(F.xxhash64("_hash", "_copy"), F.lit(15)).alias("chunk"))
    held = {r["chunk"]: r["count"] for r in chunks.groupBy("chunk").count().collect()}
    assert len(held) == 15 and max(held.values()) < 4_500


def test_copies_do_not_change_a_rerun(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 50)
    rows = [(n % 40, prose(n % 40, 30), "a") for n in range(400)] + [(99, prose(99, 45), "b")] * 200
    sums = []
    for parts in (1, 6):
        mix = mix_sources(frame(spark, rows).repartition(parts), block_words=16, shard_slots=64)
        held = taken(mix)
        sums.append(sorted((r["doc_id"], held[r["_row"]]) for r in mix.rows.collect()))
    assert sums[0] == sums[1]


def test_slots_are_numbered_over_ranges_of_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_SHARDS", 4)
    rng = np.random.default_rng(3)
    rows = [(shard, place, int(rng.integers(1, 9))) for shard in range(37) for place in range(3) if (shard + place) % 5]
    got = mixing._first_slots(spark.createDataFrame(rows, "shard long, source_place int, _slots long")).collect()
    assert len(got) == len(rows)
    for row in got:
        before = sum(n for shard, place, n in rows if place == row["source_place"] and shard < row["shard"])
        assert row["_first"] == before


def test_slots_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TASK_SLOTS", 1_000)
    one = mixing.Source(0, "a", 2_000_000, 2_000_000.0, 20_000)
    slots = mixing._slots(spark.range(1), [one], 100)
    made = [r["n"] for r in slots.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(made) == 20_000 and len(made) > 15 and max(made) < 3_000


def plain_targets(sizes):
    """By steps: share what is left by weight, fix the sources that would get too much, and again."""
    names = sorted((name for name in sizes if name is not None), key=lambda name: name.encode("utf-32-be"))
    names += [None] if None in sizes else []
    weight = {name: 1 + at % 3 for at, name in enumerate(names)}
    fixed = {}
    while True:
        free = [name for name in names if name not in fixed]
        left = sum(sizes.values()) - sum(fixed.values())
        trial = {name: left * weight[name] / sum(weight[one] for one in free) for name in free}
        above = {name: 3 * sizes[name] for name in free if trial[name] > 3 * sizes[name]}
        if not above:
            return fixed | trial
        fixed |= above


def test_query_against_a_plain_mix(spark):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    size = {row.doc_id: len(words(row.text)) for row in docs.itertuples()}
    source = {row.doc_id: row.source for row in docs.itertuples()}
    sizes = Counter()
    for number, n in size.items():
        sizes[source[number]] += n
    goals = plain_targets(sizes)
    got = mixing.op8_mix(spark, SF_DIR).collect()
    assert len(got) == len(docs) and {r["doc_id"] for r in got} == set(size)
    sums = Counter()
    for row in got:
        number = row["doc_id"]
        assert (row["size"], row["source_size"]) == (size[number], sizes[source[number]])
        assert row["target"] == pytest.approx(goals[source[number]], rel=1e-12)
        assert 0 <= row["taken"] <= 3 * row["size"]
        sums[source[number]] += row["taken"]
    for name, goal in goals.items():
        # A slot is a block of words, the last block of a pass may be shorter; slots are whole.
        assert abs(sums[name] - goal) <= 4 * mixing.BLOCK_WORDS


def test_slots_hold_blocks(spark):
    rows = [(n, prose(n, 50), f"s{n % 2}") for n in range(40)]
    pieces = mix_sources(frame(spark, rows), block_words=16, shard_slots=8).pieces.collect()
    slots = defaultdict(int)
    for row in pieces:
        slots[row["shard"], row["source_place"], row["slot"]] += row["words"]
    assert all(total <= 16 for total in slots.values())
    per_shard = Counter(shard for shard, _, _ in slots)
    assert all(number <= 8 for number in per_shard.values())
    turns = Counter((row["source_place"], row["pass"], row["block"], row["_row"]) for row in pieces)
    assert max(turns.values()) == 1  # once in each pass


def test_chunks_do_not_matter_to_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 5)
    rows = [(n, prose(n, 30), "a") for n in range(60)]
    mix = mix_sources(frame(spark, rows), block_words=7)
    held = taken(mix)
    assert sum(held.values()) == pytest.approx(1800, abs=7)
    assert set(held.values()) == {30}  # one source: a whole pass


def test_odd_rows_and_texts(spark):
    rows = odd_rows()
    docs = with_clash(frame(spark, rows), "size", "target", "taken")
    mix = mix_sources(docs, block_words=16)
    assert mix.rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", "size", "source_size", "target"]
    held = taken(mix)
    stored = mix.rows.collect()
    assert len(stored) == len(rows)
    got = mixed_documents(mix)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    out = Counter()
    for row in got.collect():
        out[row["doc_id"]] += len(words(row["text"]))
        assert row["n_chars"] == len(row["text"])
        original = next(t for n, t, _ in rows if n == row["doc_id"] and t)
        assert set(words(row["text"])) <= set(words(original))
    expected = Counter()
    for row in stored:
        expected[row["doc_id"]] += held[row["_row"]]
    assert +out == +expected


def test_whole_documents_keep_their_text(spark):
    rows = [(n, f"a  b\t{n}\n c ", "s") for n in range(20)]
    got = mixed_documents(mix_sources(frame(spark, rows), block_words=5)).collect()
    assert {row["text"] for row in got} <= {text for _, text, _ in rows} | {row["text"] for row in got if len(row["text"]) < 9}
    assert sum(len(words(row["text"])) for row in got) == 80


def test_empty_tables(spark):
    for rows in ([], [(1, None, "a"), (2, "", None)]):
        mix = mix_sources(frame(spark, rows))
        assert mix.rows.count() == len(rows) and mix.pieces.collect() == [] and mixed_documents(mix).collect() == []
