"""Mixing sources to target weights.

The documents of a source, one after another, are a stream of words that is cut into blocks of a fixed
length. An output shard has a fixed number of slots; how many of them each source gets is drawn from a
multinomial distribution. Over all shards a source gets the slots of its target: those drawn beyond it
are handed, each within its shard, to the sources that drew too few. A source's slots are numbered over
all shards, and a pseudorandom permutation of its block numbers, another one for each pass over the
source, says which block a slot holds. Blocks then join slots by number.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayblotter.llm.common import bounded_batches, carried, numbered, table, words_of

BLOCK_WORDS = 128
SHARD_SLOTS = 4_096
MOST_PASSES = 3
CHUNK_ROWS = 4_000  # documents of a source that are put in order together
TASK_SLOTS = 1 << 18  # slots made by a task, on average
RANGE_SHARDS = 1 << 12  # shards of a source whose slots are numbered together
_WEIGHTS = (1, 2, 3)
_SEED = 8
_DEALING, _KEEPING = 1 << 40, 1 << 41  # keys of permutations, beyond those of passes
_ADDED = ["size", "source_size", "target", "taken", "source_place", "_source", "_hash", "_row", "_known", "_chunks", "_chunk", "_parts", "_task", "_copy"]


@dataclass(frozen=True)
class Source:
    """A source's words, target in words, blocks, and the slots that are its share on average."""

    place: int
    name: str | None
    size: int
    target: float
    blocks: int

    @property
    def slots(self) -> float:
        return self.target * self.blocks / self.size if self.size else 0.0


def targets(sizes: Mapping[str | None, int], most: float = MOST_PASSES) -> dict[str | None, float]:
    """Words to take from each source, for all of the sources' words together.

    Sources in order of code points, null last, weigh 1, 2, 3, and so on again. A target stops at
    `most` times its source's size; what is over is shared by weight among the others, until no
    target is above.
    """
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    weights = {name: _WEIGHTS[place % len(_WEIGHTS)] for place, name in enumerate(order)}
    left, open_ones, found = float(sum(sizes.values())), list(order), {}
    while open_ones:
        share = left / sum(weights[name] for name in open_ones)
        over = [name for name in open_ones if share * weights[name] > most * sizes[name]]
        if not over:
            return found | {name: share * weights[name] for name in open_ones}
        for name in over:
            found[name] = float(most * sizes[name])
            left -= found[name]
        open_ones = [name for name in open_ones if name not in over]
    return found


def rounded(shares: Sequence[float]) -> list[int]:
    """Whole slots for each source, each share rounded up or down, that add up to the rounded sum.

    Whole shares stay as they are; fractions are rounded as their running sum is.
    """
    whole = [int(np.floor(share + 1e-6)) for share in shares]
    over = np.cumsum([0.0, *(max(0.0, share - n) for share, n in zip(shares, whole))])
    steps = np.diff(np.floor(over + 0.5).astype(int))
    return [n + int(step) for n, step in zip(whole, steps)]


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """Where a pseudorandom permutation of 0..size-1 puts each number.

    Four Feistel rounds permute the next power of four; numbers that land outside go on until they
    are inside, which keeps it a permutation.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([_SEED, key]).integers(0, 1 << 63, 4, dtype=np.uint64)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for one in keys:
            mixed = (right + one) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((mixed >> np.uint64(29)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Mix:
    """`rows`: the documents, stored, with _row, size, source_size, target and _start, their first
    word's number in their source. `pieces`: (shard, slot, source_place, pass, block, _row, first,
    words), what each slot holds of which documents."""

    rows: DataFrame
    pieces: DataFrame


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    carry: Sequence[str] | None = None,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
) -> Mix:
    """The mix of all documents; see `Mix`, `targets` and, for texts, `mixed_documents`.

    Sizes are numbers of words; a null text has none. Null is a source like any other. Documents
    without words, and an empty table, have no pieces. Repeated rows are documents of their own.
    `carry` names the input columns to keep, by default all; those named like added ones give way.

    Sources reach the driver with one row each: like the weights, they are a setting of the mix.
    The order of documents in a source is pseudorandom, by hash; they are put in order in chunks
    of a bounded size, so a source of any size spreads over many tasks. Copies of a row are numbered
    and dealt to chunks by their numbers, so that a row repeated any number of times spreads too. A shard's whole slots by
    target are given out as they are, and only what is left of them is drawn, so that shards differ
    little from the targets. Over all shards every source has the slots of its target, see `rounded`,
    so none gives more than `MOST_PASSES` passes and no slot stays empty.
    """
    wanted = carried(docs, carry, _ADDED)
    kept = docs.select(
        *[F.col(f"`{name}`") for name in wanted],
        F.col(f"`{source}`").cast("string").alias("_source"),
        F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("size"),
        F.xxhash64(*[F.col(f"`{name}`") for name in docs.columns]).alias("_hash"),
    )
    rows = numbered(kept, "_row", "mixing")
    found = rows.groupBy("_source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    sizes = {row["_source"]: row["size"] for row in found}
    goals = targets(sizes)
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    sources = [
        Source(place, name, sizes[name], goals[name], -(-sizes[name] // block_words))
        for place, name in enumerate(order)
    ]
    chunks = {row["_source"]: -(-row["rows"] // CHUNK_ROWS) for row in found}
    known = docs.sparkSession.createDataFrame(
        [(s.place, s.name, s.size, s.target, chunks[s.name]) for s in sources],
        "source_place int, _known string, source_size long, target double, _chunks int",
    )
    placed = (
        _copies(rows)
        .join(F.broadcast(known), F.col("_source").eqNullSafe(known["_known"]))  # one row for each source
        .withColumn("_chunk", F.pmod(F.xxhash64("_hash", "_copy"), F.col("_chunks")))
    )
    starts = _starts(placed.select("_row", "source_place", "_chunk", "_hash", "_copy", "size"))
    pieces = _pieces(starts, _slots(docs, sources, shard_slots), block_words)
    return Mix(placed.select(*[F.col(f"`{name}`") for name in wanted], "_row", "size", "source_size", "target"), pieces)


def _copies(rows: DataFrame) -> DataFrame:
    """Rows with `_copy`: rows of one hash are numbered from 0.

    They are numbered within each task that wrote them, after those of the tasks before. Copies are
    alike, so it does not matter to the mix which of them has which number.
    """
    rows = rows.withColumn("_task", F.shiftrightunsigned("_row", 33))  # as row numbers are made
    counts = rows.groupBy("_hash", "_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_hash").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        counts.withColumn("_before", F.sum("_n").over(earlier)).where("_before > 0").select("_hash", "_task", "_before")
    )
    nth = F.row_number().over(Window.partitionBy("_hash", "_task").orderBy("_row")) - 1
    return (
        rows.withColumn("_copy", nth)
        .join(before, ["_hash", "_task"], "left")
        .withColumn("_copy", F.col("_copy") + F.coalesce("_before", F.lit(0)))
        .drop("_task", "_before")
    )


def _starts(placed: DataFrame) -> DataFrame:
    """Documents with words, with `_start`: how many words of their source come before them."""
    sums = placed.groupBy("source_place", "_chunk").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source_place").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("source_place", "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy("source_place", "_chunk")
        .orderBy("_hash", "_copy", "_row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.where("size > 0")
        .withColumn("_in_chunk", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(before, ["source_place", "_chunk"])
        .select("_row", "source_place", "size", (F.col("_before") + F.col("_in_chunk")).alias("_start"))
    )


def _slots(docs: DataFrame, sources: Sequence[Source], shard_slots: int) -> DataFrame:
    """(shard, slot, source_place, pass, block): what every slot of every shard holds.

    Shards are drawn independently, each from its own seed; running sums over shards then number the
    slots of a source, see `_first_slots`. A task makes the slots of shards dealt to it, `TASK_SLOTS` on
    average. A source that drew more slots than `rounded` gives it keeps a pseudorandom choice
    of them. The others, numbered over all sources, are dealt in a pseudorandom order to the sources that
    drew less, so they are spread over shards, and a shard has as many slots as before.
    """
    spark = docs.sparkSession
    shares = np.array([one.slots for one in sources])
    goals = np.array(rounded(shares), dtype=np.int64)
    total = int(goals.sum())
    shards = -(-total // shard_slots)
    chances = shares / shares.sum() if total else shares
    blocks = [one.blocks for one in sources]

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for shard in batch["id"]:
                slots = min(shard_slots, total - shard * shard_slots)
                whole = np.floor(slots * chances).astype(int)
                over = slots * chances - whole
                left = slots - int(whole.sum())
                if left:
                    whole += np.random.default_rng([_SEED, shard]).multinomial(left, over / over.sum())
                out += [(shard, place, int(n)) for place, n in enumerate(whole) if n]
            yield pd.DataFrame(out, columns=["shard", "source_place", "_slots"])

    counts = spark.range(shards).mapInPandas(drawn, "shard long, source_place int, _slots long")
    got = np.zeros(len(sources), dtype=np.int64)
    for place, number in counts.groupBy("source_place").agg(F.sum("_slots")).collect():  # a row for each source
        got[place] = number
    # Before each source: slots given up, and slots taken over.
    given = np.cumsum([0, *np.maximum(got - goals, 0)])
    taken = np.cumsum([0, *np.maximum(goals - got, 0)])

    def dealt(place: int, first: int, number: int) -> Iterator[tuple[int, np.ndarray]]:
        """The sources of slots that `place` drew, with the slots' numbers in them."""
        slot = np.arange(first, first + number)
        if got[place] <= goals[place]:
            yield place, slot
            return
        slot = permuted(slot, int(got[place]), _KEEPING + place)
        yield place, slot[slot < goals[place]]
        extra = slot[slot >= goals[place]] - goals[place] + given[place]
        if len(extra):
            extra = permuted(extra, int(given[-1]), _DEALING)
            owner = np.searchsorted(taken, extra, side="right") - 1
            for one in np.unique(owner):
                yield int(one), got[one] + extra[owner == one] - taken[one]

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, drawn_place, number, first in batch.itertuples(index=False):
                for place, slot in dealt(drawn_place, first, number):
                    turn, nth = slot // blocks[place], slot % blocks[place]
                    for one in np.unique(turn):
                        mine = turn == one
                        block = permuted(nth[mine], blocks[place], place * MOST_PASSES + int(one))
                        yield pd.DataFrame(
                            {"shard": shard, "slot": slot[mine], "source_place": place, "pass": int(one), "block": block}
                        )

    tasks = max(1, -(-total // TASK_SLOTS))
    return (
        _first_slots(counts)
        .repartition(tasks, "shard")  # stated: what a task makes is many times what it reads
        .mapInPandas(held, "shard long, slot long, source_place int, pass int, block long")
    )


def _first_slots(counts: DataFrame) -> DataFrame:
    """Counts with `_first`: how many slots of the source lie in earlier shards. Ranges of shards are summed first."""
    ranged = counts.withColumn("_range", F.floor(F.col("shard") / RANGE_SHARDS))
    over_ranges = Window.partitionBy("source_place").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("source_place", "_range")
        .agg(F.sum("_slots").alias("_sum"))
        .select("source_place", "_range", F.coalesce(F.sum("_sum").over(over_ranges), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("source_place", "_range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_within", F.coalesce(F.sum("_slots").over(within), F.lit(0)))
        .join(before, ["source_place", "_range"])
        .select("shard", "source_place", "_slots", (F.col("_before") + F.col("_within")).alias("_first"))
    )


def _pieces(starts: DataFrame, slots: DataFrame, block_words: int) -> DataFrame:
    """Slots joined to the parts of documents that lie in their block."""
    end = F.col("_start") + F.col("size")
    parts = starts.withColumn(
        "block", F.explode(F.expr(f"sequence(_start div {block_words}, (_start + size - 1) div {block_words})"))
    ).select(
        "source_place",
        "block",
        "_row",
        F.greatest(F.lit(0), F.col("block") * block_words - F.col("_start")).alias("first"),
        (
            F.least(end, (F.col("block") + 1) * block_words) - F.greatest("_start", F.col("block") * block_words)
        ).alias("words"),
    )
    # Spark takes slots for few, as the shards they are drawn from are; it must not broadcast them.
    return slots.hint("merge").join(parts, ["source_place", "block"]).select(
        "shard", "slot", "source_place", "pass", "block", "_row", "first", "words"
    )


def mixed_documents(mix: Mix, text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """A row for each document and pass that the mix takes words of, with those words as its text.

    Words that lie together keep what is between them; a document taken whole keeps its text as it
    is. Stretches that do not lie together are joined by a line end. `chars` is set to the new
    length, if there is a column of that name. Documents that the mix takes nothing of go.
    """
    taken = (
        mix.pieces.groupBy("_row", "pass")
        .agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_parts"))  # of one document
    )
    bounded_batches(mix.rows.sparkSession)
    names = [n for n in mix.rows.columns if n not in ("_row", "size", "source_size", "target")]
    rows = mix.rows.join(taken, "_row").select(*[F.col(f"`{n}`") for n in names], "size", "_parts")
    schema = mix.rows.select(*[F.col(f"`{n}`") for n in names]).schema

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            texts = []
            for one, size, parts in zip(batch[text], batch["size"], batch["_parts"]):
                runs: list[list[int]] = []
                for part in parts:
                    if runs and runs[-1][1] == part["first"]:
                        runs[-1][1] += part["words"]
                    else:
                        runs.append([part["first"], part["first"] + part["words"]])
                if runs == [[0, size]]:
                    texts.append(one)
                else:
                    spans = [found.span() for found in word.finditer(one)]
                    texts.append("\n".join(one[spans[a][0] : spans[b - 1][1]] for a, b in runs))
            yield batch.assign(**{text: texts}).drop(columns=["size", "_parts"])

    out = rows.mapInPandas(cut, schema)
    if chars and chars in names:
        out = out.withColumn(chars, F.length(text).cast(schema[chars].dataType))
    return out.select(*[F.col(f"`{n}`") for n in names])


def op8_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = mix_sources(docs, carry=["doc_id"])
    taken = mix.pieces.groupBy("_row").agg(F.sum("words").alias("taken"))
    return mix.rows.join(taken, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
