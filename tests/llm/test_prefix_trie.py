import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayblotter.llm import prefix_trie as trie
from dayblotter.llm.prefix_trie import COLUMNS, op11_prefix_trie, prefix_trie, rebuilt, sequences, turn_records

TURNS = "conv_id long, turn long, role string, text string"


def rebuilt_plainly(rows):
    own = defaultdict(list)
    for number, turn, role, text in rows:
        if number is not None:
            own[number].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {number: [turn[1:] for turn in sorted(turns)] for number, turns in own.items()}
    out = {}
    for number, turns in own.items():
        taken = zlib.crc32(str(number).encode()) % 9
        out[number] = own.get(number - number % 5, [])[:taken] + turns[taken:]
    return out


def plain(convs):
    members = defaultdict(list)
    for number, turns in convs:
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append((number, len(turns)))
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    own = {path: (len(found) - 1) * (len(path[-1][1].encode()) if path else 0) for path, found in members.items()}
    saved, leaves = defaultdict(int), defaultdict(int)
    for path in members:
        for depth in range(len(path) + 1):
            saved[path[:depth]] += own[path]
            leaves[path[:depth]] += not children[path]
    out = []
    for path, found in members.items():
        ends = ",".join(str(number) for number, length in sorted(found) if length == len(path))
        parent = min(members[path[:-1]])[0] if path else None
        row = (min(found)[0], len(path), parent, len(found), len(children[path]), leaves[path], saved[path])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda row: row[:2])


def got(nodes):
    assert nodes.columns == COLUMNS
    return sorted((tuple(row) for row in nodes.collect()), key=lambda row: row[:2])


def rows_of(convs):
    return [(number, turn, role, text) for number, turns in convs for turn, (role, text) in enumerate(turns)]


def trie_of(spark, convs, shards):
    """The trie of conversations as they are, turnless ones included."""
    rows = spark.createDataFrame(rows_of(convs), TURNS)
    keys = sequences(turn_records(rows, "conv_id", "turn", "role", "text"))
    empty = [(number, b"") for number, turns in convs if not turns]
    return prefix_trie(keys.unionByName(spark.createDataFrame(empty, "conv_id long, key binary")), shards)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_trie(spark, seed, shards):
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "assistant"]), rng.choice(["", "a", "é", "😀 long text"]))
    most = [3, 12, 30][seed]
    convs = [(n * 3 - 50, [turn() for _ in range(rng.randrange(most))]) for n in range(120)]
    stem = [turn() for _ in range(most)]
    convs += [(1000 + n, stem[: rng.randrange(most)] + [turn()] * rng.randrange(2)) for n in range(150)]
    convs += [(5000 + n, list(stem)) for n in range(100)]
    assert got(trie_of(spark, convs, shards)) == plain(convs)


def test_one_conversation_for_all_and_a_very_long_one(spark, monkeypatch):
    convs = [(n, [("user", "hi"), ("assistant", "ho")]) for n in range(400)]
    convs += [(900, [("user", str(n)) for n in range(700)]), (901, [("user", str(n)) for n in range(650)])]
    monkeypatch.setattr(trie, "CHUNK", 7)
    assert got(trie_of(spark, convs, 9)) == plain(convs)


def test_only_turnless_ones(spark):
    convs = [(n, []) for n in range(20)]
    assert got(trie_of(spark, convs, 3)) == plain(convs)


@pytest.mark.parametrize("seed", range(5))
def test_order_is_that_of_the_keys(seed):
    rng = random.Random(seed)
    keys = [b"".join(rng.choice([b"\x01", b"\xff"]) * 24 for _ in range(rng.randrange(20))) for _ in range(300)]
    keys += keys[:50]
    order = trie._order(trie._Matrix(keys), np.arange(len(keys)))
    assert order.tolist() == sorted(range(len(keys)), key=lambda row: (keys[row], row))


def test_odd_rows(spark):
    rows = [
        (10, 0, "user", "a"), (10, 1, None, "b"), (10, None, "user", None), (10, 2, "assistant", "c" * 300_000),
        (11, 5, "user", "x"), (11, 5, "user", "x"), (11, 5, "assistant", "y"), (11, None, None, None), (12, 0, "", ""),
        (None, 0, "user", "lost"), (None, None, None, None), (-3, 0, "user", "a"), (14, 3, "user", "a"), (14, 1, "user", "\0 é"),
    ]
    rows += [(13, n, "user", f"t{n % 3}") for n in range(15)]
    turns = spark.createDataFrame(rows, TURNS).select("*", F.lit("x").alias("turns"), F.lit("x").alias("key"), F.lit("x").alias("depth"))
    records = turn_records(turns, "conv_id", "turn", "role", "text")
    expected = plain(sorted(rebuilt_plainly(rows).items()))
    assert got(prefix_trie(sequences(rebuilt(records)), 3)) == expected


def test_empty_table(spark):
    turns = spark.createDataFrame([], TURNS)
    assert got(prefix_trie(sequences(rebuilt(turn_records(turns, "conv_id", "turn", "role", "text"))))) == []


def test_query_against_a_plain_trie_and_sql(spark, duck):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = got(op11_prefix_trie(spark, folder))
    assert found == plain(rebuilt_plainly(rows).items())
    by_sql = duck.execute(f"select {', '.join(COLUMNS)} from ({trie.ORACLE})").fetchall()
    assert sorted(by_sql, key=lambda row: row[:2]) == found
