"""Codes of vectors by a codebook for each part, with exact integer arithmetic.

Components become integers. Distances come from matrix products: integers are broken into limbs so
short that a product of two limb matrices stays below 2^53 and so is exact in float64, whatever order
BLAS adds in; the products are put together again in int64, and the first least distance is taken.
Codebooks are moved to the rounded means of what they attract, by sums that do not depend on order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayblotter.llm.common import stored, table, without

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK_ROWS = 2048  # vectors whose distances a task holds at once


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as float64 limbs, lowest first: the sum of limb * 2^(bits * place); the last keeps the sign."""
    out, rest = [], values
    while rest.size and np.abs(rest).max() >= 1 << bits:
        high = rest >> bits
        out.append((rest - (high << bits)).astype(np.float64))
        rest = high
    return [*out, rest.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """`left @ right` of int64 matrices, or stacks of them, exactly; the results have to fit 62 bits."""
    inner = max(left.shape[-1], 1)
    bits = (53 - (inner - 1).bit_length()) // 2
    out = np.zeros((*left.shape[:-1], right.shape[-1]), dtype=np.int64)
    for i, one in enumerate(limbs(left, bits)):
        for j, other in enumerate(limbs(right, bits)):
            out += np.matmul(one, other).astype(np.int64) << (bits * (i + j))
    return out


def _checked(values: np.ndarray, width: int) -> np.ndarray:
    """Integers whose squared distances over `width` components fit 62 bits, for any two of them."""
    limit = 1 << ((60 - (max(width, 1) - 1).bit_length()) // 2)
    if values.size and not (np.abs(values) < limit).all():
        raise ValueError(f"a scaled component is {limit} or more, too large for exact distances of 64 bits")
    return values.astype(np.int64)


def nearest_entries(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts (part, row, width) and codebooks (part, entry, width): the nearest entries and their distances."""
    products = exact_products(parts, np.swapaxes(books, 1, 2))
    distances = (parts * parts).sum(axis=2)[:, :, None] - 2 * products + (books * books).sum(axis=2)[:, None, :]
    codes = distances.argmin(axis=2)
    return codes, np.take_along_axis(distances, codes[:, :, None], axis=2)[:, :, 0]


@dataclass(frozen=True)
class Codebooks:
    """Integers of (part, entry, position within the part), and what components are multiplied by."""

    entries: np.ndarray
    scale: int = SCALE

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def _blocks(column: pa.Array, parts: int, width: int, scale: int) -> Iterator[np.ndarray]:
    """The scaled integers of a batch's vectors as (part, row, width), a block of rows at a time."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.floor(flat.astype(np.float64) * scale).reshape(len(column), parts, width)
    for first in range(0, len(rows), BLOCK_ROWS):
        yield np.ascontiguousarray(_checked(rows[first : first + BLOCK_ROWS], width).swapaxes(0, 1))


def _ready(vectors: DataFrame, vector: str, size: int | None = None) -> DataFrame:
    name = f"`{vector}`"
    ready = vectors.where(usable(F.col(name)))
    return ready if size is None else ready.where(F.size(name) == size)


def _shape(vectors: DataFrame, vector: str, parts: int) -> tuple[int, int] | None:
    size = _ready(vectors, vector).agg(F.max(F.size(f"`{vector}`"))).first()[0]
    if size is None:
        return None
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    return size, size // parts


def _sums(vectors: DataFrame, vector: str, books: Codebooks) -> list:
    """(part, entry, position, sum, count) of what each entry attracts; entries that attract nothing are missing.

    Every task hands on one row for each component of the codebooks at most, and so does the driver get.
    """
    entries, scale = books.entries, books.scale
    parts, number, width = entries.shape

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, number, width), dtype=np.int64)
        counts = np.zeros((parts, number), dtype=np.int64)
        for batch in batches:
            for block in _blocks(batch.column(0), parts, width, scale):
                codes, _ = nearest_entries(block, entries)
                for part in range(parts):
                    np.add.at(sums[part], codes[part], block[part])
                    counts[part] += np.bincount(codes[part], minlength=number)
        part, entry = np.nonzero(counts)
        places = np.tile(np.arange(width), len(part))
        columns = [np.repeat(part, width), np.repeat(entry, width), places, sums[part, entry].ravel(), np.repeat(counts[part, entry], width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in columns], ["part", "entry", "place", "total", "number"]
        )

    partial = vectors.select(f"`{vector}`").mapInArrow(
        added, "part long, entry long, place long, total long, number long"
    )
    return partial.groupBy("part", "entry", "place").agg(F.sum("total"), F.sum("number")).collect()


def train_codebooks(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of all usable vectors; None if there are none.

    They begin as the vectors of the smallest ids (null ids last, ties by the vector itself), fewer than
    `entries` if there are not as many. In each round every vector counts, repeated rows as often as they
    are there. A mean is rounded down; an entry that attracts nothing stays. Vectors that are null, hold a
    null or a number that is not finite, or are shorter than the longest, take no part. A longest vector
    that cannot be cut into `parts` equal parts, and components too large for exact distances, are errors.
    """
    shape = _shape(vectors, vector, parts)
    if shape is None:
        return None
    size, width = shape
    ready = _ready(vectors, vector, size)
    first = ready.orderBy(F.col(f"`{vec_id}`").asc_nulls_last(), F.col(f"`{vector}`")).select(f"`{vector}`").limit(entries)
    start = np.array([row[0] for row in first.collect()], dtype=np.float64).reshape(-1, parts, width)
    books = np.ascontiguousarray(_checked(np.floor(start * scale), width).swapaxes(0, 1))
    for _ in range(rounds):
        moved = books.copy()
        for part, entry, place, total, number in _sums(ready, vector, Codebooks(books, scale)):
            moved[part, entry, place] = total // number
        books = moved
    return Codebooks(books, scale)


def coded_vectors(vectors: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """The usable rows with `code`, two hex digits for each part, and `error`, the squared distance in scaled units.

    The other columns stay, but for the vector; input columns named like added ones give way.
    """
    entries, scale = books.entries, books.scale
    parts, number, width = entries.shape
    if number > 256:
        raise ValueError("two hex digits name 256 entries at most")
    kept = without(_ready(vectors, vector, parts * width), ["code", "error", "_vector"])
    held = kept.select(*[f"`{name}`" for name in kept.columns if name != vector], F.col(f"`{vector}`").alias("_vector"))
    schema = T.StructType([*held.drop("_vector").schema.fields, *T.StructType.fromDDL("code string, error long").fields])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for block in _blocks(batch.column(batch.num_columns - 1), parts, width, scale):
                found, distances = nearest_entries(block, entries)
                digits = np.ascontiguousarray(found.T.astype(np.uint8)).tobytes().hex()
                codes += [digits[at : at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
                errors.append(distances.sum(axis=0))
            error = np.concatenate(errors) if errors else np.zeros(0, dtype=np.int64)
            columns = [*batch.columns[:-1], pa.array(codes, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return held.mapInArrow(coded, schema)


def with_group_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """The coded rows with `label_error`: the errors of all rows of their label, nulls together.

    The sums are combined before the shuffle and stored, as are the rows, so that Spark can split a
    label that many rows share.
    """
    rows = stored(without(coded, ["label_error", "_label"]), "vector-codes")
    sums = stored(
        rows.groupBy(F.col(f"`{label}`").alias("_label")).agg(F.sum("error").alias("label_error")), "vector-labels"
    )
    return rows.join(sums, rows[f"`{label}`"].eqNullSafe(sums["_label"])).drop("_label")


def op12_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = train_codebooks(vectors)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    return with_group_error(coded_vectors(vectors, books)).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
