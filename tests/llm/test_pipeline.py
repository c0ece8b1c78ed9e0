import os

import numpy as np
import pytest

import corpus_pipeline
from dayblotter.llm.packing import END_ID, public_tokenizer
from dayblotter.llm.secrets import RULES
from dayblotter.session import new_folder, shared_folder
from llm_data import DOCS, frame, odd_rows, prose, words
from test_secrets import base
from test_simhash import classes, slow_fingerprint


def sentence(number):
    return ". ".join(f"The {word} of {prose(number, 12).split()[n]}" for n, word in enumerate("cat dog owl elk fox hen cow emu ant bee yak ram".split())) + ". " + " ".join(f"and word{number}" for _ in range(3)) + "."


@pytest.fixture
def rows():
    good = [(n, sentence(n) + f" Line {n}.", f"s{n % 3}") for n in range(60)]
    copies = [(100 + n, good[n][1], "s0") for n in range(20)]
    secret = [(200 + n, sentence(200 + n) + f" password: hunter{n}abc and more.", "s1") for n in range(5)]
    junk = [(300 + n, " ".join(w + "$#%" for w in sentence(300 + n).split()), "s2") for n in range(6)]
    return good + copies + secret + junk + odd_rows()


def test_stages_against_brute_force(spark, rows):
    docs = frame(spark, rows)
    names = docs.columns

    kept = corpus_pipeline.quality_rules(spark, docs, "")
    assert kept.columns == names
    ids = {row["doc_id"] for row in kept.collect()}
    assert {n for n in range(60)} | {100 + n for n in range(20)} | {200 + n for n in range(5)} <= ids
    assert not ids & ({300 + n for n in range(6)} | {3, 4, 5, 9} - {n for n, _, _ in rows[:60]})

    single = corpus_pipeline.near_dedup(spark, kept, "")
    held = [(row["doc_id"], row["text"]) for row in kept.collect()]
    prints = {number: slow_fingerprint(text) for number, text in held}
    near = [(a, b) for a in prints for b in prints if a is not None and b is not None and a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = set(classes([n for n in prints if n is not None], near).values())
    assert {row["doc_id"] for row in single.collect()} - {None} == expected

    clean = corpus_pipeline.secret_scan(spark, single, "")
    assert clean.columns == names and clean.count() == single.count()
    for row in clean.collect():
        assert base(row["text"]) == [] and row["n_chars"] == len(row["text"])
        if row["doc_id"] == 203:
            assert "[SECRET] and more." in row["text"]

    mixed = corpus_pipeline.mix_to_weights(spark, clean, "")
    assert mixed.columns == names
    sizes = {}
    for row in clean.collect():
        sizes[row["source"]] = sizes.get(row["source"], 0) + len(words(row["text"]))
    total = sum(len(words(row["text"])) for row in mixed.collect())
    assert total == pytest.approx(sum(sizes.values()), rel=0.1)

    packed = corpus_pipeline.pack_sequences(spark, mixed, "").collect()
    ids_of = public_tokenizer().load()
    tokens = sum(len(ids_of(row["text"])) + 1 for row in mixed.collect())
    assert sum(row["length"] for row in packed) == tokens
    assert sum(np.frombuffer(bytes(row["ids"]), dtype="<u4").tolist().count(END_ID) for row in packed) >= mixed.count()


def test_stages_of_an_empty_table(spark):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.dtypes == spark.createDataFrame([], DOCS).dtypes and docs.collect() == []
    assert corpus_pipeline.pack_sequences(spark, docs, "").collect() == []


def test_run(spark):
    shared = f"{shared_folder(spark)}/dayblotter"
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = set(os.listdir(shared)) - before
    # The result, and the ledger of secrets, which is there to stay.
    assert sorted(name.split("-")[0] for name in left) == ["ledger", "pipeline"]
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 100
    assert len(RULES) == 7
