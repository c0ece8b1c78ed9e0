"""SimHash near-dedup by segment popcounts.

A 64-bit fingerprint is cut into 16 segments of 4 bits; the number of bits set in each makes a point
in a grid of 16 dimensions. Two fingerprints that differ in d bits have points at most d apart by
Manhattan distance, so a range join on the grid misses no link; the bits then verify each pair. That
holds for any cut of the bits into segments: a crowded cell is divided by the grid of a second cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayblotter.llm.common import bounded_batches, carried, components, numbered, stored, table

SHINGLE_WORDS = 3
MAX_BITS = 2
FULL_CELL = 64  # about where all pairs of a cell become more rows than the cells of a second grid
_SEED = 42
_ADDED = ["fingerprint", "component_id", "keep", "_fp", "_row", "_kept_row"]
_BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint_of(text: str | None, size: int) -> int:
    """A bit is set if it is in over half of the hashes; as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = max(1, len(words) - size + 1)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, shingles, _BLOCK):
        part = words[start : min(start + _BLOCK, shingles) + size - 1]
        joined = b" ".join(part)
        ends = np.cumsum([len(word) + 1 for word in part])
        begins = [0, *ends.tolist()]
        n = min(_BLOCK, shingles - start)
        last = [*begins[size : n + size], *[begins[-1]] * max(0, n + size - len(begins))]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(joined[a : b - 1], _SEED) for a, b in zip(begins[:n], last)),
            dtype="<u8",
            count=n,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > shingles, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column, size: int) -> Column:
    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint_of(one, size) for one in batch], dtype="int64")

    return of_texts(text)


def _segment_counts(bits: Column) -> Column:
    """Popcounts of the 16 segments of neighbouring bits, packed again into 4 bits each."""
    ones = F.lit(0x1111111111111111)
    counts = bits.bitwiseAND(ones)
    for place in (1, 2, 3):
        counts = counts + F.shiftrightunsigned(bits, place).bitwiseAND(ones)
    return counts


def _strided_counts(bits: Column) -> Column:
    """Popcounts of another 16 segments: bits 16 apart. Each quarter's bits are spread to every fourth place."""
    counts = F.lit(0).cast("long")
    for quarter in range(4):
        spread = F.shiftrightunsigned(bits, 16 * quarter).bitwiseAND(F.lit(0xFFFF))
        for step, mask in ((24, 0x000000FF000000FF), (12, 0x000F000F000F000F), (6, 0x0303030303030303), (3, 0x1111111111111111)):
            spread = spread.bitwiseOR(F.shiftleft(spread, step)).bitwiseAND(F.lit(mask))
        counts = counts + spread
    return counts


def _around(point: Column, radius: int) -> Column:
    """The grid points within `radius` of a point. Coordinates go from 0 to 4."""
    cells = F.array(point)
    for _ in range(radius):
        def step(cell: Column) -> Column:
            moved = []
            for segment in range(16):
                count = F.shiftrightunsigned(cell, 4 * segment).bitwiseAND(F.lit(15))
                one = F.lit(_signed(1 << (4 * segment)))
                moved += [F.when(count < 4, cell + one), F.when(count > 0, cell - one)]
            return F.array(cell, *moved)

        cells = F.array_compact(F.array_distinct(F.flatten(F.transform(cells, step))))
    return cells


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def links(prints: DataFrame, max_bits: int = MAX_BITS, full_cell: int = FULL_CELL) -> DataFrame:
    """(a, b): links between distinct `fp` of at most `max_bits` bits, enough to connect all of them.

    Points at most `max_bits` apart have a grid cell within half of that of both; each fingerprint is
    dealt to the cells within that radius of its point, and meets those it shares a cell with. A cell
    of more than `full_cell` fingerprints would make too many pairs: its fingerprints are dealt again,
    within the cell, by the grid of another cut into segments. Cells crowded in both grids hold
    fingerprints that are alike all over. These are dealt by the finest cut there is, segments of one
    bit, whose cells are bit strings: those that share one are linked to the smallest of them, one row
    for each. No link is lost at any step. With `max_bits` over 2 a point has some 500 cells within
    reach and not 33, and crowded cells go to the finest cut at once.
    """
    reach = -(-max_bits // 2)
    few, crowded = _met(prints.select("fp"), [], "_cell", _segment_counts, reach, full_cell)
    pairs = _pairs(few, ["_cell"], max_bits)
    if reach <= 1:
        few, crowded = _met(crowded, ["_cell"], "_part", _strided_counts, reach, full_cell)
        pairs = pairs.unionByName(_pairs(few, ["_cell", "_part"], max_bits))
    return pairs.unionByName(_by_bit_strings(crowded.select("fp").distinct(), max_bits)).distinct()


def _met(
    members: DataFrame, within: list[str], cell: str, counts: Callable[[Column], Column], reach: int, full_cell: int
) -> tuple[DataFrame, DataFrame]:
    """Members with the cells of a grid in which they meet others: of cells that are not crowded, and of those that are."""
    keys = [*within, cell]
    dealt = members.select("fp", *within, F.explode(_around(counts(F.col("fp")), reach)).alias(cell))
    shared = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    met = stored(dealt.join(shared, keys), "simhash")
    return met.where(F.col("_n") <= full_cell).drop("_n"), met.where(F.col("_n") > full_cell).drop("_n")


def _pairs(members: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Pairs within each cell that differ in at most `max_bits` bits."""
    return (
        members.groupBy(*keys)
        .agg(F.collect_list("fp").alias("_fps"))  # of full_cell at most
        .select("_fps", F.explode("_fps").alias("a"))
        .select("a", F.explode("_fps").alias("b"))
        .where("a < b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def _by_bit_strings(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints that share a bit string at most half of `max_bits` away from both.

    A bit string is a cell of the grid whose segments have one bit each: counts are the bits themselves.
    For an odd distance one of a pair may be one bit further away than the other: strings at the
    longer distance link only to fingerprints at the shorter one.
    """
    near, far = max_bits // 2, -(-max_bits // 2)

    def flipped(bits: Column, radius: int) -> Column:
        strings = F.array(bits)
        masks = F.array(*[F.lit(_signed(1 << bit)) for bit in range(64)])
        for _ in range(radius):
            strings = F.array_distinct(
                F.flatten(
                    F.transform(
                        strings,
                        lambda s: F.concat(F.array(s), F.transform(masks, lambda mask: s.bitwiseXOR(mask))),
                    )
                )
            )
        return strings

    at_near = prints.select("fp", F.explode(flipped(F.col("fp"), near)).alias("_string"))
    heads = at_near.groupBy("_string").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("_n"))
    if near == far:
        linked = at_near.join(heads.where("_n > 1"), "_string")
    else:
        at_far = prints.select("fp", F.explode(flipped(F.col("fp"), far)).alias("_string"))
        linked = at_far.join(heads, "_string")
    return linked.where("fp <> b").select(
        F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")
    ).distinct()


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Documents with `fingerprint`, `component_id` and `keep`.

    `carry` names the input columns to return, all by default. Words are lower-cased (A-Z) and split
    at ASCII white space; a null text, like one without words, has fingerprint zero. `component_id`
    is the smallest id reachable by links of at most `max_bits` bits, the document's own included,
    and null if none there has an id. `keep` is true for one row of each component, that of the
    smallest id; of repeated rows, one. Repeated rows are all returned. Input columns named like
    added ones give way to them.

    Documents meet only as distinct fingerprints, so copies cost one row each; documents then get
    their component in a join on the fingerprint, which Spark splits where one is hot.
    """
    bounded_batches(docs.sparkSession)
    wanted = carried(docs, carry, _ADDED)
    columns = list(dict.fromkeys([*wanted, doc_id]))
    rows = numbered(
        docs.select(*[F.col(f"`{name}`") for name in columns], fingerprints(F.col(f"`{text}`"), shingle).alias("_fp")),
        "_row",
        "simhash",
    )
    number = F.col(f"`{doc_id}`")
    prints = stored(
        rows.groupBy(F.col("_fp").alias("fp")).agg(
            F.min(number).alias("_least"),
            F.min(F.struct(number.isNull().alias("_none"), number.alias("_id"), "_row")).alias("_first"),
        ),
        "simhash",
    )
    roots = components(links(prints, max_bits))
    rooted = stored(
        prints.join(roots, prints["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp")),
        "simhash",
    )
    # Stored, so that the join back to fingerprints shuffles for itself and Spark can split a large component.
    groups = stored(
        rooted.groupBy("root").agg(F.min("_least").alias("component_id"), F.min("_first").alias("_chosen")),
        "simhash",
    )
    labels = rooted.join(groups, "root").select(
        F.col("fp").alias("_fp"), "component_id", F.col("_chosen._row").alias("_kept_row")
    )
    return rows.join(labels, "_fp").select(
        *[F.col(f"`{name}`") for name in wanted],
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        "component_id",
        (F.col("_row") == F.col("_kept_row")).alias("keep"),
    )


def op4_simhash_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs, carry=["doc_id"]).drop("keep")
