"""A corpus, from documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as Parquet to the shared
folder and gives what it reads back to the next. All but the last return the columns of `documents`,
with further ones of any name as they are; `doc_id`, `text` and `source` have to be there, `n_chars` may.

A stage's frame has to be written before the next stage is called: that takes away what the stage
before it worked with, so that a corpus needs room for the tables of one stage at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter.llm import mixing, packing, quality, secrets, simhash
from dayblotter.llm.common import table, working_folder
from dayblotter.session import new_folder, remove_folder

# The draw of a mix and a set of components are not within SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under names that no operator uses, and what each column is called there.

    A column of a document stays what it is, whatever an operator adds under its name.
    """
    names = {name: f"column_{place}" for place, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(there).alias(name) for name, there in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    rows, names = _numbered(docs)
    return _named(quality.weak_quality(rows, names["text"]).where("kept"), names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    rows, names = _numbered(docs)
    return _named(simhash.simhash_groups(rows, names["doc_id"], names["text"]).where("keep"), names)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark; `n_chars`, if there, is set anew."""
    rows, names = _numbered(docs)
    ledger = secrets.Ledger(spark, new_folder(spark, "ledger"))
    found = secrets.with_spans(rows, names["text"], ledger)
    clean = found.withColumn(names["text"], secrets.redact(F.col(names["text"]), F.col("spans")))
    if "n_chars" in names:
        clean = clean.withColumn(names["n_chars"], F.length(names["text"]).cast(docs.schema["n_chars"].dataType))
    return _named(clean, names)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document, a row for each pass over its source."""
    rows, names = _numbered(docs)
    mix = mixing.mix_sources(rows, names["source"], names["text"])
    return _named(mixing.mixed_documents(mix, names["text"], names.get("n_chars")), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their token ids."""
    return packing.pack(docs.select("doc_id", "text"), packing.public_tokenizer(), carry=["doc_id"])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Folders of working tables by application: those of the last stage that was called.
_WORKED_IN: dict[str, str] = {}


def _clear(spark: SparkSession) -> None:
    folder = _WORKED_IN.pop(spark.sparkContext.applicationId, None)
    if folder:
        remove_folder(spark, folder)


def _in_turn(name: str, stage: Stage) -> tuple[str, Stage]:
    def called(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(spark)
        with working_folder(spark, name) as folder:
            out = stage(spark, docs, sf_dir)
        _WORKED_IN[spark.sparkContext.applicationId] = folder
        return out

    return name, called


STAGES: list[tuple[str, Stage]] = [
    _in_turn("quality_rules", quality_rules),
    _in_turn("simhash_near_dedup", near_dedup),
    _in_turn("secret_scan", secret_scan),
    _in_turn("mix_to_weights", mix_to_weights),
    _in_turn("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    _clear(spark)
    return docs
