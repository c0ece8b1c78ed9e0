"""Input columns named like an operator's own give way, the others stay, whatever they begin with."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dayblotter.llm import mixing, packing, quality, secrets, sharding, simhash, substrings, urls
from dayblotter.session import new_folder
from llm_data import frame, odd_rows

OWN = [
    "_fp", "_row", "_kept_row", "_text", "_part", "_sequence", "_offset", "_key", "_marks", "_spans", "_source", "_hash",
    "_known", "_chunk", "_chunks", "_parts", "_words", "_lines", "_keys", "_low", "_again", "_best", "_split", "_cell",
    "_bits", "_size", "_base", "_from", "_blob", "source_place", "fp", "root", "node", "a", "b", "m", "id", "length", "size",
    "words", "block", "rule", "shard", "keep", "_other",
]
OPERATORS = {
    "sharding": lambda spark, docs: sharding.extendible_shards(docs, ["doc_id"], F.length("text"), limit=500),
    "urls": lambda spark, docs: urls.filter_urls(docs, "text", urls.rules_frame(spark, urls.RULES)),
    "simhash": lambda spark, docs: simhash.simhash_groups(docs),
    "packing": lambda spark, docs: packing.pack(docs, packing.public_tokenizer()),
    "substrings": lambda spark, docs: substrings.without_repeats(docs),
    "mixing": lambda spark, docs: mixing.mixed_documents(mixing.mix_sources(docs)),
    "secrets": lambda spark, docs: secrets.with_spans(docs, "text", secrets.Ledger(spark, new_folder(spark, "ledger"))),
    "quality": lambda spark, docs: quality.weak_quality(docs),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names(spark, name):
    plain = frame(spark, odd_rows())
    docs = plain.select("*", *[F.lit("x").alias(own) for own in OWN])
    got = OPERATORS[name](spark, docs)
    assert got.where("_other = 'x'").count() == OPERATORS[name](spark, plain).count()
    assert len(set(map(str.lower, got.columns))) == len(got.columns)


STAGE_NAMES = [
    "size", "target", "taken", "kept", "keep", "spans", "votes", "quality", "n_words", "base_failed", "component_id",
    "fingerprint", "source_size", "pass", "pieces", "column_0", "column_2", "start", "ids", "offset",
]


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_columns_of_documents_pass_through_stages(spark, number):
    plain = frame(spark, odd_rows())
    extra = [name for name in dict.fromkeys([*STAGE_NAMES, *OWN])]
    docs = plain.select("*", *[F.concat(F.lit(f"{name} "), F.coalesce("text", F.lit(""))).alias(name) for name in extra])
    _, stage = corpus_pipeline.STAGES[number]
    # Calling a stage takes away what the one before worked with.
    expected = stage(spark, plain, "")
    columns, held = expected.columns, expected.collect()
    got = stage(spark, docs, "")
    if number == len(corpus_pipeline.STAGES) - 1:
        assert got.columns == columns and got.count() == len(held)
        return
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(row[name].startswith(f"{name} ") for row in rows for name in extra)
    if number != 3:  # the order of documents in a mix depends on all their columns
        key = lambda row: [(value is None, value) for value in row[:5]]
        assert sorted(map(key, rows)) == sorted(map(key, held))


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_without_lengths(spark, number):
    docs = frame(spark, odd_rows()).drop("n_chars", "lang")
    _, stage = corpus_pipeline.STAGES[number]
    got = stage(spark, docs, "")
    assert number == len(corpus_pipeline.STAGES) - 1 or got.columns == docs.columns
    assert got.collect() or number == 0  # no document of this table has the quality to stay
