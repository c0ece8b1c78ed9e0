import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayblotter.llm.vector_codes import coded_vectors, exact_products, limbs, op12_vector_codes, train_codebooks, with_group_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds=2):
    """(vec_id, code, error, label_error) of every usable row and the codebooks, with Python's integers."""
    kept = [
        (number, [math.floor(256 * x) for x in vector], label)
        for number, vector, label in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    if not kept:
        return [], None
    width = len(kept[0][1]) // parts
    cut = [[vector[p * width : (p + 1) * width] for p in range(parts)] for _, vector, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][1]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        attracted = defaultdict(list)
        for row in cut:
            for p in range(parts):
                attracted[p, nearest(p, row[p])[1]].append(row[p])
        for (p, e), found in attracted.items():
            books[p][e] = [sum(column) // len(found) for column in zip(*found)]
    out, by_label = [], defaultdict(int)
    for (number, _, label), row in zip(kept, cut):
        found = [nearest(p, row[p]) for p in range(parts)]
        error = sum(distance for distance, _ in found)
        by_label[label] += error
        out.append((number, "".join(f"{e:02x}" for _, e in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [(number, code, error, by_label[label]) for number, code, error, label in out], digest


def key(row):
    return tuple((value is None, value) for value in row)


@pytest.mark.parametrize("seed", range(20))
def test_products_are_exact(seed):
    rng = random.Random(seed)
    inner, most = rng.choice([1, 3, 4, 64, 257]), rng.choice([1, 9, 2**20, 2**26])
    left = np.array([[rng.randint(-most, most) for _ in range(inner)] for _ in range(7)], dtype=np.int64)
    right = np.array([[rng.randint(-most, most) for _ in range(5)] for _ in range(inner)], dtype=np.int64)
    expected = [[sum(int(a) * int(b) for a, b in zip(row, column)) for column in right.T] for row in left]
    assert exact_products(left, right).tolist() == expected


def test_limbs_stay_small_and_add_up():
    values = np.array([0, 1, -1, 2**25 - 1, -(2**25), 2**40 + 12345, -(2**40) - 7, 2**58], dtype=np.int64)
    parts = limbs(values, 25)
    assert all(np.abs(part).max() <= 2**25 for part in parts)
    total = sum(int(1) * part.astype(np.int64) * (1 << (25 * place)) for place, part in enumerate(parts))
    assert total.tolist() == values.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_integers(spark, seed):
    rng = random.Random(seed)
    scale = [1, 1, 3000, 0.02][seed]
    rows = [(n, [rng.choice([-1, 1, rng.uniform(-1, 1)]) * scale for _ in range(8)], rng.choice([None, 1, 2])) for n in range(150)]
    rows = [(n, np.float32(v).tolist(), label) for n, v, label in rows]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    books = train_codebooks(vectors, parts=4, entries=9)
    got = with_group_error(coded_vectors(vectors, books)).select("vec_id", "code", "error", "label_error").collect()
    expected, digest = plain(rows, 4, 9)
    assert sorted(map(tuple, got)) == sorted(expected) and books.sha256() == digest


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.5, 0.25, -0.001], None), (1, [0.5, -0.5, 0.25, -0.001], None), (2, None, 1), (3, [0.0, nan, 0.0, 0.0], 1),
        (4, [0.0, -inf, 0.0, 0.0], 1), (5, [None, 0.0, 0.0, 0.0], 1), (6, [0.0, 0.0, 0.0, 0.0], 1), (None, [1.0, 2.0, 3.0, 4.0], 2),
        (None, None, None), (7, [0.0, 0.0, 0.0, 0.0], 1), (8, [0.5, -0.5, 0.25, -0.001], 3),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    vectors = vectors.select("*", F.lit("x").alias("Code"), F.lit("x").alias("label_error"), F.lit("x").alias("_vector"), F.lit("x").alias("_other"))
    books = train_codebooks(vectors, parts=2, entries=3)
    got = with_group_error(coded_vectors(vectors, books))
    assert sorted(got.columns) == sorted(["vec_id", "label", "_other", "code", "error", "label_error"])
    expected, digest = plain(rows, 2, 3)
    found = [tuple(row) for row in got.select("vec_id", "code", "error", "label_error").collect()]
    assert sorted(found, key=key) == sorted(expected, key=key) and books.sha256() == digest


def test_shorter_vectors_and_bad_widths(spark):
    rows = [(1, [0.5, 0.5], 1), (2, [0.25], 1), (3, [], 1), (4, [0.0, 1.0], None)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = coded_vectors(vectors, train_codebooks(vectors, parts=2, entries=2)).collect()
    assert sorted(row["vec_id"] for row in got) == [1, 4]
    with pytest.raises(ValueError, match="equal parts"):
        train_codebooks(vectors, parts=3)
    with pytest.raises(ValueError, match="too large"):
        train_codebooks(spark.createDataFrame([(1, [1e30, 0.0], 1)], SCHEMA), parts=2)


def test_no_usable_vector(spark, tmp_path):
    spark.createDataFrame([(1, None, 1)], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op12_vector_codes(spark, str(tmp_path))
    assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_query_against_plain_integers(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected, digest = plain(rows, 16, 64)
    got = op12_vector_codes(spark, folder).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(map(tuple, got.collect())) == sorted((*row, digest) for row in expected)
