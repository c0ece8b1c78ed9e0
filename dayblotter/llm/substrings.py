"""Substring dedup by relative Lempel-Ziv parsing.

Documents are factored against an index of reference passages. The index holds anchors: of every
window of `WINDOW` words, the run of about half as many words with the least hash, so that equal windows have equal
anchors. It is dealt into blocks by hash, and its entry for an anchor is the smallest document that
has it, where it stands. A document's anchors are looked up in all blocks they fall in; a factor
begins at an anchor and goes on for as long as the next ones continue the same passage of the same
reference. Factors of a window or more are duplicate spans. Where a factor ends within a window,
another document may still hold it; such windows, at factor boundaries, are checked one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dayblotter.llm.common import bounded_batches, carried, stored, table

WINDOW = 50
_ADDED = ["n_words", "n_removed", "kept", "_key", "_doc", "_marks", "_spans"]
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(base, -1, 1 << 64) for base in _BASES)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # of bytes: at ASCII white space only


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(32))


class RunHashes:
    """Hashes of runs of words, from sums of a polynomial modulo 2^64 over all words before."""

    def __init__(self, words: Sequence[bytes]) -> None:
        self.words = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
        self.count = len(words)

    def of(self, size: int, kind: int = 0) -> np.ndarray:
        """The hash of the `size` words from each place on; kinds are independent of one another."""
        base, inverse = np.uint64(_BASES[kind]), np.uint64(_INVERSES[kind])
        ups = np.cumprod(np.full(self.count, base, dtype=np.uint64))
        downs = np.cumprod(np.full(self.count, inverse, dtype=np.uint64))
        values = self.words if kind == 0 else _mixed(self.words + np.uint64(kind))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * ups, dtype=np.uint64)])
        return _mixed((sums[size:] - sums[: self.count - size + 1]) * downs[: self.count - size + 1])

    def anchors(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """The place of every window's anchor, the first if several are equal, and all run hashes."""
        hashes = self.of(gram)
        views = np.lib.stride_tricks.sliding_window_view(hashes, window - gram + 1)
        return views.argmin(axis=1) + np.arange(len(views)), hashes


def duplicate_spans(rows: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """(_doc, _key, _spans): for documents with duplicate windows, word ranges (begin, end) that cover them.

    `rows` has `_doc`, the id, and `_key`, a hash of id and text. Both together tell documents apart;
    see `without_repeats`.
    """
    gram = window // 2 + 1
    columns = rows.columns
    anchors = stored(_anchors(rows, text, window, gram), "substrings")
    # What is joined back to the rows it was summed from is stored first: both sides of the join are
    # then shuffled for it alone, and Spark splits the anchors and windows that very many share.
    reference = stored(
        anchors.groupBy("gram")
        .agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
        .where("first_doc < last_doc")
        .select("gram", "first_doc"),
        "substrings",
    )
    shared = stored(anchors.join(reference, "gram"), "substrings")
    home = stored(
        shared.where("doc = first_doc")
        .groupBy("gram")
        .agg(F.min(F.struct("key", "place")).alias("home")),
        "substrings",
    )
    parsed = stored(_factored(shared.where("doc > first_doc").join(home, "gram"), window, gram), "substrings")
    factors = parsed.where(F.col("end") - F.col("begin") >= window).select(
        F.col("doc").alias("_doc"), F.col("key").alias("_key"), "begin", "end"
    )
    # Windows at boundaries ask; they are answered by others at boundaries and by the references.
    asking = parsed.where("exposed")
    answers = shared.where("doc = first_doc").join(asking.select("gram").distinct(), "gram", "left_semi")
    marks = stored(
        asking.select("doc", "key", "place", F.lit(True).alias("asks"))
        .unionByName(answers.select("doc", "key", "place", F.lit(False).alias("asks")))
        .groupBy(F.col("doc").alias("_doc"), F.col("key").alias("_key"))
        .agg(F.collect_set(F.struct("place", "asks")).alias("_marks")),  # of one document
        "substrings",
    )
    windows = rows.join(marks.hint("merge"), ["_doc", "_key"]).select(*columns, "_marks")
    hashed = stored(
        windows.mapInPandas(
            _window_hashes(text, window, gram), "_key long, doc long, begin long, h long, g long, asks boolean"
        ),
        "substrings",
    )
    smallest = stored(
        hashed.groupBy("h", "g")
        .agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
        .where("first_doc < last_doc")
        .drop("last_doc"),
        "substrings",
    )
    repeated = (
        hashed.where("asks")
        .join(smallest, ["h", "g"])
        .where("first_doc < doc")
        .select(F.col("doc").alias("_doc"), "_key", "begin", (F.col("begin") + window).alias("end"))
    )
    return stored(
        factors.unionByName(repeated)
        .groupBy("_doc", "_key")
        .agg(F.collect_set(F.struct("begin", "end")).alias("_spans")),  # of one document
        "substrings",
    )


def _anchors(rows: DataFrame, text: str, window: int, gram: int) -> DataFrame:
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, doc, one in zip(batch["_key"], batch["_doc"], batch["_text"]):
                words = split_words(one)
                if len(words) < window:
                    continue
                places, hashes = RunHashes(words).anchors(window, gram)
                places = np.unique(places)
                out.append(
                    pd.DataFrame(
                        {"gram": hashes[places].view("i8"), "key": key, "doc": doc, "place": places, "words": len(words)}
                    )
                )
            if out:
                yield pd.concat(out)

    held = rows.where("_doc is not null").select("_key", "_doc", F.col(f"`{text}`").alias("_text"))
    return held.mapInPandas(index, "gram long, key long, doc long, place int, words int")


def _factored(matched: DataFrame, window: int, gram: int) -> DataFrame:
    """Each matched anchor with its factor [begin, end), and whether a window of it sticks out."""
    line = Window.partitionBy("doc", "key", "first_doc", "home.key", F.col("place") - F.col("home.place"))
    along = line.orderBy("place")
    runs = matched.withColumn("slant", F.col("place") - F.col("home.place")).withColumn("home_key", F.col("home.key"))
    runs = runs.withColumn("breaks", F.coalesce(F.col("place") - F.lag("place").over(along) > gram, F.lit(False)).cast("int"))
    runs = runs.withColumn("run", F.sum("breaks").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    one = Window.partitionBy("doc", "key", "first_doc", "home_key", "slant", "run")
    runs = runs.withColumn("begin", F.min("place").over(one).cast("long")).withColumn(
        "end", (F.max("place").over(one) + gram).cast("long")
    )
    inside = (F.col("begin") <= F.greatest(F.lit(0), F.col("place") + gram - window)) & (
        F.col("end") >= F.least("words", F.col("place") + window)
    )
    return runs.select("gram", "key", "doc", "place", "begin", "end", (~inside).alias("exposed"))


def _window_hashes(text: str, window: int, gram: int):
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, doc, one, marks in zip(batch["_key"], batch["_doc"], batch[text], batch["_marks"]):
                runs = RunHashes(split_words(one))
                places, _ = runs.anchors(window, gram)
                asked = np.zeros(runs.count, dtype=np.int8)
                for mark in marks:
                    asked[mark["place"]] |= 2 if mark["asks"] else 1
                begins = np.flatnonzero(asked[places])
                yield pd.DataFrame(
                    {
                        "_key": key,
                        "doc": doc,
                        "begin": begins,
                        "h": runs.of(window, 0)[begins].view("i8"),
                        "g": runs.of(window, 1)[begins].view("i8"),
                        "asks": asked[places[begins]] >= 2,
                    }
                )

    return hashed


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """Documents with `n_words`, `n_removed` and `kept`, the words left, joined by one space.

    A word goes if it is in a run of `window` words that also stands in a document with a smaller
    id. Words are split at ASCII white space and compared as they are; all runs are judged on the
    input. A null text has no words. A document with a null id neither loses words nor makes others
    lose any; rows with one id do not affect each other. Repeated rows are all returned. `carry`
    names the input columns to return, by default all; those named like added ones give way.

    Only anchors (one in 13 words) are shuffled to find what documents share, and whole texts twice, once
    for windows at boundaries and once for cutting. A document is its id and a hash of 64 bits, so only
    texts of one id could be taken for each other. Its marks and spans are stored before they are joined
    to texts, and Spark splits rows that are repeated very often. An anchor that a third of all documents have is
    reduced to its smallest document before the shuffle; the join back to its documents is one that
    Spark splits. Windows are told apart by 128 bits of hash, anchors by 64; a factor long enough to
    count has at least two of them.
    """
    bounded_batches(docs.sparkSession)
    wanted = carried(docs, carry, _ADDED)
    columns = list(dict.fromkeys([*wanted, doc_id, text]))
    number = F.col(f"`{doc_id}`")
    rows = docs.select(
        *[F.col(f"`{name}`") for name in columns],
        number.cast("long").alias("_doc"),
        F.xxhash64(number, F.col(f"`{text}`")).alias("_key"),
    )
    spans = duplicate_spans(rows, text, window)
    schema = T.StructType(
        [*docs.select(*[F.col(f"`{name}`") for name in wanted]).schema.fields]
        + T.StructType.fromDDL("n_words long, n_removed long, kept string").fields
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for one, found in zip(batch[text], batch["_spans"]):
                words = split_words(one)
                gone = 0
                if found is not None and len(found):
                    steps = np.zeros(len(words) + 1, dtype=np.int64)
                    for span in found:
                        steps[span["begin"]] += 1
                        steps[span["end"]] -= 1
                    stays = np.cumsum(steps)[:-1] == 0
                    gone = int(len(words) - stays.sum())
                    kept = [word for word, stay in zip(words, stays.tolist()) if stay]
                else:
                    kept = words
                out.append((len(words), gone, b" ".join(kept).decode()))
            added = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
            yield pd.concat([batch[wanted].reset_index(drop=True), added], axis=1)

    return rows.join(spans.hint("merge"), ["_doc", "_key"], "left").select(*columns, "_spans").mapInPandas(cut, schema)


def op7_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE = """
with docs as (
  select row_number() over () as n, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words
  from documents
), windows as (
  select n, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) as h
  from docs, unnest(range(1, len(words) - 48)) as t(i) where doc_id is not null
), firsts as (
  select h, min(doc_id) as first_doc from windows group by h having first_doc < max(doc_id)
), gone as (
  select distinct n, unnest(range(i, i + 50)) as i
  from windows join firsts using (h) where first_doc < doc_id
), kept as (
  select w.n, string_agg(word, ' ' order by i) as kept, count(*) as n_kept
  from (select n, unnest(words) as word, generate_subscripts(words, 1) as i from docs) w
  anti join gone using (n, i) group by w.n
)
select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n_kept, 0))::bigint as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from docs left join kept using (n)
"""
