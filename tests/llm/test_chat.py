import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayblotter.llm import chat
from dayblotter.llm.chat import (
    END,
    MAPPINGS,
    SEP,
    TURN,
    canonical_turns,
    escape,
    field_tree,
    fingerprint_of,
    format_turns,
    op2_chat_format,
    read_back,
    records_of,
    skeleton,
    unescape,
)

LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, "messages"),
    ({"turns": [{"text": "a", "role": "user"}, {"role": "assistant", "text": "b"}]}, "turns"),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations"),
    ({"instruction": "a", "output": "b"}, "instruction"),
    ({"output": "b", "instruction": "a", "input": ""}, "instruction"),
    ({"prompt": "a", "completion": "b"}, "prompt"),
    ({"prompt": "a", "response": "b"}, "response"),
    ({"question": "a", "answer": "b"}, "question"),
]


def read(spark, records):
    df = spark.createDataFrame(list(enumerate(records)), "n int, record string")
    return {row["n"]: row for row in format_turns(canonical_turns(df, "record")).collect()}


def test_layouts_become_the_same_turns(spark):
    got = read(spark, [json.dumps(record) for record, _ in LAYOUTS])
    for place, (_, name) in enumerate(LAYOUTS):
        assert got[place]["layout"] == name
        assert [tuple(turn) for turn in got[place]["turns"]] == [("user", "a"), ("assistant", "b")]
        assert got[place]["formatted"] == f"{TURN}user{SEP}a{END}{TURN}assistant{SEP}b{END}"
        assert [s["piece"] for s in got[place]["segments"] if s["loss"]] == ["b"]


def test_system_and_input_turns(spark):
    got = read(
        spark,
        [
            json.dumps({"system": "s", "prompt": "a", "completion": "b"}),
            json.dumps({"instruction": "do", "input": "this", "output": "b"}),
            json.dumps({"messages": [{"role": None, "content": None}, {"role": "model", "content": "b"}]}),
        ],
    )
    assert [tuple(t) for t in got[0]["turns"]] == [("system", "s"), ("user", "a"), ("assistant", "b")]
    assert got[1]["turns"][0]["text"] == "do\n\nthis"
    assert [tuple(t) for t in got[2]["turns"]] == [("user", ""), ("assistant", "b")]


def test_unknown_damaged_and_missing_records_stay(spark):
    got = read(spark, ['{"other": 1}', "{", "", None, "[]", "3", '{"messages": []}'])
    assert len(got) == 7
    assert all(row["layout"] is None and row["turns"] is None and row["formatted"] is None for row in got.values())


def test_fingerprints_depend_on_names_alone(spark):
    records = ['{"a": 1, "b": [{"c": "x"}]}', '{"b": [{"c": null}, {"c": 2.5}], "a": {"d": true}}', '{"b":[{"c":[1]}],"a":"OBJECT<x"}']
    df = spark.createDataFrame([(one,) for one in records], "record string")
    trees = [row[0] for row in df.select(field_tree(F.parse_json("record"))).collect()]
    assert trees[0] == trees[0].replace(" ", "") == "{a,b:[{c>>>"
    assert trees[1] == "{a:{d>,b:[{c>>>"
    assert len({fingerprint_of(tree) for mapping in MAPPINGS for tree in mapping.trees}) == sum(len(m.trees) for m in MAPPINGS)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.sampled_from("\\<|>/s[INST] é😀\n$1"), max_size=30), min_size=1, max_size=40))
def test_escaping_is_reversible(spark, texts):
    df = spark.createDataFrame([(one,) for one in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for row in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert row["u"] == row["t"]
        assert not any(word in row["e"] for word in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_rows_by_turn(spark):
    rows = [
        (1, 2, "assistant", "c"), (1, 0, "user", None), (1, 1, None, "b<|end|>"), (1, 1, None, "b<|end|>"),
        (2, None, "user", "x" * 200_000), (None, 0, "user", "n"), (3, 0, "assistant", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_turns(canonical_turns(records_of(df, "conv_id", "turn", "role", "text"), "record"))
    got = {row["conv_id"]: [tuple(t) for t in row["back"]] for row in out.withColumn("back", read_back(F.col("formatted"))).collect()}
    assert got[1] == [("user", ""), ("user", "b<|end|>"), ("user", "b<|end|>"), ("assistant", "c")]
    assert got[2] == [("user", "x" * 200_000)] and got[None] == [("user", "n")] and got[3] == [("assistant", "")]


def test_texts_longer_than_a_parser_takes_by_default(spark):
    made = "select {conv}L conv_id, id turn, if(id % 2 = 0, 'user', 'assistant') role, repeat('{word}', {times}) text from range({turns})"
    rows = [(1, "ab", 10_500_000, 1), (2, "c\\\\d\"", 1_000, 300), (3, "e", 1, 300_000)]
    df = spark.sql(" union all ".join(made.format(conv=c, word=w, times=t, turns=n) for c, w, t, n in rows))
    records = records_of(df, "conv_id", "turn", "role", "text")
    out = canonical_turns(records, "record").select(
        "conv_id", "layout", F.size("turns").alias("n"),
        F.expr("aggregate(turns, 0L, (n, t) -> n + length(t.text))").alias("chars"),
    )
    got = {row["conv_id"]: row for row in out.collect()}
    for conv, word, times, turns in rows:
        assert (got[conv]["layout"], got[conv]["n"]) == ("messages", turns)
        assert got[conv]["chars"] == len(word.replace("\\\\", "\\")) * times * turns


def test_skeletons_keep_names_and_faults(spark):
    cases = {
        '{"a": "x\\"{", "b" : [{"c": "1"} , {"c": "2"},{"c": "3"}]}': '{"a": "", "b" : [{"c": ""}]}',
        '{"k{},{}": "v", "k:": ":"}': '{"k{},{}": "", "k:": ""}',
        '{"a": "\\q", "b": "c"}': '{"a": "\\q", "b": ""}',
        '{"a": "line\nend"}': '{"a": "line\nend"}',
        '["x", 1, "y\\\\"]': '["", 1, ""]',
    }
    df = spark.createDataFrame([(one,) for one in cases], "r string")
    assert {row[0]: row[1] for row in df.select("r", skeleton(F.col("r"))).collect()} == cases
    bad = read(spark, ['{"prompt": "\\q", "response": "b"}', '{"prompt": "a\nb", "response": "b"}', '{"prompt": "a", "response": "b'])
    assert all(row["layout"] is None and row["schema_fingerprint"] is None for row in bad.values())
    plain = read(spark, ['{"prompt": 3, "response": true}', '{"prompt": 2.50, "response": null}', '{"prompt": "\\u00e9\\ud83d\\ude00", "response": ""}'])
    assert [[t["text"] for t in plain[n]["turns"]] for n in range(3)] == [["3", "true"], ["2.5", ""], ["é😀", ""]]


def test_a_record_of_its_own_that_is_not_understood_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(chat, "MAPPINGS", [])
    with pytest.raises(Exception, match="no layout for the record of conversation"):
        op2_chat_format(spark, "/root/testdata/sf0.001").collect()


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "record string, LAYOUT int, segments int")
    out = format_turns(canonical_turns(df, "record"))
    assert out.columns == ["record", "schema_fingerprint", "layout", "turns", "segments", "formatted"]
    assert out.collect() == []


def test_query_has_the_probe(spark):
    row = op2_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    assert (row["n_turns"], row["loss_chars"]) == (2, len("</s>[INST] ok [/INST]"))
