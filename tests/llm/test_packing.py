import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from dayblotter.llm.packing import Tokenizer, best_fit_decreasing, op6_pack, pack, public_tokenizer
from llm_data import frame, odd_rows, with_clash


def one_by_one(counts, window):
    """The fill of every window, when pieces are placed one at a time."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [(room, n) for n, room in enumerate(rooms) if room >= length]
            if fits:
                rooms[min(fits)[1]] -= length
            else:
                rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 10, 64])
    counts = {length: rng.randrange(12) for length in range(1, window) if rng.random() < 0.6}
    windows, pieces = defaultdict(list), defaultdict(set)
    for length, piece, number, first, offset in best_fit_decreasing(counts, window):
        for k in range(number):
            windows[first + k].append((offset, length))
            assert piece + k not in pieces[length]
            pieces[length].add(piece + k)
    assert {length: len(found) for length, found in pieces.items()} == {n: c for n, c in counts.items() if c}
    assert all(found == set(range(len(found))) for found in pieces.values())
    rooms = []
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        rooms.append(window - at)
    assert sorted(rooms) == one_by_one(counts, window)


def check(rows, texts, window, encode):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        by_doc[row["doc_id"]].append(row)
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= window
    for number, pieces in by_doc.items():
        expected = np.array([*encode(texts[number] or ""), 1], dtype="<u4")
        pieces.sort(key=lambda row: row["start"])
        assert [row["start"] for row in pieces] == list(np.cumsum([0, *[row["length"] for row in pieces]])[:-1])
        assert b"".join(bytes(row["ids"]) for row in pieces) == expected.tobytes()
        assert all(row["doc_tokens"] == len(expected) for row in pieces)
    return sum(length for held in by_sequence.values() for _, length in held) / (len(by_sequence) * window)


@pytest.fixture(scope="module")
def encode():
    loaded = tokenizers.Tokenizer.from_file(public_tokenizer().file)
    return lambda text: loaded.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("fast", [True, False])
def test_round_trip(spark, encode, fast):
    rng = random.Random(1)
    texts = {n: " ".join(rng.choice(["alpha", "β", "😀", "don't", "\n\n", "<|endoftext|>"]) for _ in range(rng.randrange(90))) for n in range(200)}
    tokenizer = public_tokenizer() if fast else Tokenizer(public_tokenizer().file)
    docs = frame(spark, [(n, t, "s") for n, t in texts.items()]).repartition(5)
    assert check(pack(docs, tokenizer, window=64).collect(), texts, 64, encode) > 0.97


def test_odd_rows(spark, encode):
    rows = odd_rows()
    docs = with_clash(frame(spark, rows), "start", "ids", "sequence_id")
    got = pack(docs, public_tokenizer())
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    found = got.collect()
    single = [row for row in found if row["doc_id"] not in (2, None)]
    texts = {number: text for number, text, _ in rows}
    for row in single:
        if row["doc_id"] in (3, 4):
            assert bytes(row["ids"]) == b"\1\0\0\0" and row["doc_tokens"] == 1
    assert len([row for row in found if row["doc_id"] == 2 and row["start"] == 0]) == 2
    assert len([row for row in found if row["doc_id"] is None and row["start"] == 0]) == 3
    totals = defaultdict(int)
    for row in found:
        totals[row["doc_id"]] += row["length"]
    assert totals[6] == len(encode(texts[6])) + 1
    places = [(row["sequence_id"], row["offset"]) for row in found]
    assert len(set(places)) == len(places)


def test_long_white_space(spark, encode):
    texts = {1: "a" + " " * 1_000_000 + "b", 2: "\n" * 1_000_000, 3: " " * 100_000 + "c", 4: "plain"}
    got = pack(frame(spark, [(n, t, "s") for n, t in texts.items()]), public_tokenizer(), window=2048)
    check(got.collect(), texts, 2048, encode)


def test_empty_table(spark):
    assert pack(frame(spark, []), public_tokenizer()).collect() == []


def test_query_against_the_file(spark, encode):
    folder = "/root/testdata/sf0.001"
    texts = {row[0]: row[1] for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    pieces = defaultdict(list)
    for row in op6_pack(spark, folder).collect():
        pieces[row["doc_id"]].append(row)
    assert set(pieces) == set(texts)
    for number, found in pieces.items():
        ids = np.array([*encode(texts[number] or ""), 1], dtype="<u4")
        for row in found:
            part = ids[row["start"] : row["start"] + row["length"]]
            assert len(part) == row["length"] and zlib.crc32(part.tobytes()) == row["ids_crc32"]
        assert sum(row["length"] for row in found) == len(ids) == found[0]["doc_tokens"]
