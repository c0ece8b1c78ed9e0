"""Packing by best-fit decreasing.

Documents become tokens; what fills a window by itself is cut off first. The rest of a document, less
than a window, is placed best-fit decreasing: longest first, each into the open window with the least
room that still takes it, found in a segment tree indexed by remaining room. Pieces of one length are
alike, so the plan is made for lengths and how many pieces have each, not for pieces: its size depends
on the window alone. Pieces are then numbered within their length and look up their place.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict, deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dayblotter.llm.common import bounded_batches, carried, stored, table

WINDOW = 2048
END_ID = 1
LONGEST_SPACE = 100_000  # characters of white space in a row that `tiktoken` is given; near a million it panics
_SPACE = re.compile(r"\s+")
_ADDED = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset", "_text", "_part", "_row", "_sequence", "_offset"]


@dataclass(frozen=True)
class Tokenizer:
    """Ids of a text by a `tokenizers` file, special tokens neither added nor escaped.

    `ranks`, if given, is the same byte-level vocabulary for `tiktoken`, which is faster; `pattern`
    splits texts for it. Texts that hold one of the file's special tokens, or more white space in a
    row than `LONGEST_SPACE`, always go by the file.
    """

    file: str
    ranks: str | None = None
    pattern: str | None = None

    def load(self) -> Callable[[str], list[int]]:
        by_file = tokenizers.Tokenizer.from_file(self.file)
        special = [token.content for token in by_file.get_added_tokens_decoder().values()]
        fast = None
        if self.ranks:
            with open(self.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

        def ids(text: str) -> list[int]:
            if fast is None or any(token in text for token in special) or _long_space(text):
                return by_file.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        return ids


def _long_space(text: str) -> bool:
    if len(text) <= LONGEST_SPACE:
        return False
    return any(found.end() - found.start() > LONGEST_SPACE for found in _SPACE.finditer(text))


class _Rooms:
    """A segment tree over remaining room 0..capacity: which is the least, from some room on, that is open?"""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, room: int, is_open: bool) -> None:
        node = room + self.size
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = least + self.size
        if self.open[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_decreasing(counts: Mapping[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Places for `counts[length]` pieces of each length: (length, first piece, pieces, first window, offset).

    Pieces of one length are numbered from 0; the pieces from `first piece` on go to the windows from
    `first window` on, one each, all at `offset`. Windows with equal room are kept as ranges and the
    earliest opened is taken, so the result is that of placing pieces one by one.
    """
    rooms = _Rooms(window)
    ranges: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    places, opened = [], 0

    def add(room: int, first: int, number: int) -> None:
        if room and number:
            ranges[room].append((first, number))
            rooms.set(room, True)

    for length in sorted((one for one, number in counts.items() if number), reverse=True):
        piece, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, first, number = window, opened, -(-left // (window // length))
                opened += number
            else:
                first, number = ranges[room].popleft()
            # Each window in turn is the tightest until it takes no more of this length.
            fit = room // length
            full = min(number, left // fit)
            over = left - full * fit if full < number else 0
            for place in range(fit):
                taken = full + (place < over)
                if taken:
                    places.append((length, piece, taken, first, window - room + place * length))
                    piece, left = piece + taken, left - taken
            used = full + bool(over)
            if used < number:
                ranges[room].appendleft((first + used, number - used))
            elif room < window and not ranges[room]:
                rooms.set(room, False)
            add(room - fit * length, first, full)
            add(room - over * length, first + full, bool(over))
    return places


def pack(
    docs: DataFrame,
    tokenizer: Tokenizer,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces: the carried columns, start, length, ids, doc_tokens, sequence_id, offset.

    A document's tokens are its text's ids and then `end_id`; a null or empty text has `end_id`
    alone. `start` counts the document's tokens before the piece, `ids` holds the piece's as unsigned
    little-endian 32-bit numbers. Sequences have at most `window` tokens; offsets have no gaps.
    `carry` names the input columns to return, by default all but the text. Repeated rows are
    separate documents. An empty table gives no pieces. Input columns named like added ones give way.

    Texts are read once, and the pieces stored. Full windows stay as they are written. The rest is
    numbered by partition and length, from sums over partitions, so that a length many pieces share
    is numbered in as many tasks as there are partitions; only numbers are shuffled for that. The
    plan has a row for each run of equal pieces, which the driver makes from one count per length.
    """
    bounded_batches(docs.sparkSession)
    wanted = [name for name in carried(docs, carry, _ADDED) if carry or name != text]
    cut = stored(_cut(docs, tokenizer, wanted, text, window, end_id), "packing")
    rest = cut.where("sequence_id is null")
    # At most `window` numbers reach the driver.
    counts = {row[0]: row[1] for row in rest.groupBy("length").count().collect()}
    places = best_fit_decreasing(counts, window)
    plan = docs.sparkSession.createDataFrame(
        pd.DataFrame(places, columns=["length", "_first", "_pieces", "_window", "_offset"]).astype("int64"),
        "length long, _first long, _pieces long, _window long, _offset long",
    )
    placed = _numbered(rest.select("_part", "_row", "length")).join(
        plan, "length"
    ).where("_nth >= _first and _nth < _first + _pieces").select(
        "_part", "_row", (F.col("_window") + F.col("_nth") - F.col("_first")).alias("_sequence"), "_offset"
    )
    names = [F.col(f"`{name}`") for name in wanted]
    own = ["start", "length", "ids", "doc_tokens"]
    whole = cut.where("sequence_id is not null").select(*names, *own, "sequence_id", "offset")
    return whole.unionByName(
        rest.join(placed, ["_part", "_row"]).select(
            *names, *own, F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset")
        )
    )


def _cut(docs, tokenizer, wanted, text, window, end_id) -> DataFrame:
    """Pieces of documents: full windows with a sequence of their own, and the rest without one.

    Sequences of full windows are negative: numbers within the partition, below those of others.
    """
    kept = docs.select(*[F.col(f"`{name}`") for name in wanted], F.col(f"`{text}`").alias("_text"))
    added = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, _part int, _row long"
    schema = T.StructType([*kept.drop("_text").schema.fields, *T.StructType.fromDDL(added).fields])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, ids_of = TaskContext.get().partitionId(), tokenizer.load()
        row = full = 0
        for batch in batches:
            place, out = [], []
            for at, one in enumerate(batch["_text"]):
                ids = np.array([*ids_of(one or ""), end_id], dtype="<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    whole = len(piece) == window
                    full += whole
                    number = -(part << 40) - full if whole else None
                    place.append(at)
                    out.append((start, len(piece), piece.tobytes(), len(ids), number, 0 if whole else None, part, row))
                row += 1
            pieces = pd.DataFrame(out, columns=schema.names[-8:])
            for name in ("sequence_id", "offset"):
                pieces[name] = pieces[name].astype("Int64")
            rows = batch.drop(columns="_text").iloc[place].reset_index(drop=True)
            yield pd.concat([rows, pieces], axis=1)

    return kept.mapInPandas(cut, schema)


def _numbered(rest: DataFrame) -> DataFrame:
    """(_part, _row, length, _nth): every piece's number among those of its length, from 0."""
    sums = rest.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_part").orderBy("_row")
    return (
        rest.withColumn("_in_part", F.row_number().over(within) - 1)
        .join(starts, ["length", "_part"])
        .select("_part", "_row", "length", (F.col("_before") + F.col("_in_part")).alias("_nth"))
    )


def public_tokenizer() -> Tokenizer:
    import public_tokenizers

    return Tokenizer(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op6_pack(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = pack(docs, public_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
