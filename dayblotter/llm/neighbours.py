"""Approximate nearest neighbours by stable projections.

Vectors are projected to a few dimensions with normal (2-stable) coefficients, so that a projected
distance, squared and divided by the true one, follows a chi-square distribution. A kd-tree holds the
projections. A search takes projected neighbours one after another, nearest first, and verifies them on
the original vectors, until the test says that a vector nearer than those found would, with the
probability asked for, have been met by now.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dayblotter.llm.common import numbered, stored, table

DIMENSIONS = 24  # even, see `chi_square_at`
CHANCE = 0.97
SAMPLE_ROWS = 20_000  # rows the outer tree is fitted to; every row is indexed
BLOCK_ROWS = 8_192
MOST_LEAVES = 1_024  # of the outer tree
QUERY_ROWS = 16_384  # queries that one task takes for a block
_LEAF_ROWS = 32  # of the tree within a block
_LEAVES = 32  # taken from that tree at a time, or more
_POINTS = 32  # verified at a time, or a sixth of those verified before, between two looks at the test
_ROUNDING = 1e-12  # of a product of lengths: how far two equal scores may be apart before they are summed exactly
_SLACK = 1e-12
_SEED = 20


def chi_square_at(chance: float, dimensions: int) -> float:
    """Where the chi-square distribution of an even number of dimensions reaches `chance`."""
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        half, term, total = middle / 2, 1.0, 1.0
        for step in range(1, dimensions // 2):
            term *= half / step
            total += term
        low, high = (middle, high) if 1 - math.exp(-half) * total < chance else (low, middle)
    return high


@dataclass(frozen=True)
class KdTree:
    """Splits of space at medians. `boxes` are the leaves' lower and upper corners."""

    axes: np.ndarray
    cuts: np.ndarray
    children: np.ndarray  # below 0: the leaf of number -1 - value
    boxes: tuple[np.ndarray, np.ndarray]

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        if not len(self.axes):
            return np.zeros(len(points), dtype=np.int64)
        at = np.zeros(len(points), dtype=np.int64)
        while (inner := at >= 0).any():
            node = at[inner]
            right = points[inner, self.axes[node]] > self.cuts[node]
            at[inner] = self.children[node, right.astype(int)]
        return -1 - at

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distance from a point to every leaf's box."""
        low, high = self.boxes
        out = np.maximum(np.maximum(low - point, point - high), 0.0)
        return (out * out).sum(axis=1)


def grown(points: np.ndarray, leaf_rows: int, tight: bool) -> tuple[KdTree, list[np.ndarray]]:
    """A tree whose leaves hold `leaf_rows` points or fewer, or points that are all the same.

    Tight boxes enclose the leaf's points, others are bounded by the splits and cover all of space.
    """
    axes, cuts, children, lows, highs, leaves = [], [], [], [], [], []

    def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
        part = points[rows]
        width = np.ptp(part, axis=0) if len(rows) else np.zeros(points.shape[1])
        axis = int(width.argmax())
        if len(rows) <= leaf_rows or width[axis] == 0:
            lows.append(part.min(axis=0) if tight and len(rows) else low)
            highs.append(part.max(axis=0) if tight and len(rows) else high)
            leaves.append(rows)
            return -len(leaves)
        values = part[:, axis]
        cut = float(np.median(values))
        if (values <= cut).all():
            cut = float(values[values < cut].max())
        node = len(axes)
        axes.append(axis)
        cuts.append(cut)
        children.append([0, 0])
        below, above = high.copy(), low.copy()
        below[axis], above[axis] = cut, cut
        children[node] = [grow(rows[values <= cut], low, below), grow(rows[values > cut], above, high)]
        return node

    everywhere = np.full(points.shape[1], np.inf)
    grow(np.arange(len(points)), -everywhere, everywhere)
    tree = KdTree(
        np.array(axes, dtype=np.int64),
        np.array(cuts),
        np.array(children, dtype=np.int64).reshape(-1, 2),
        (np.array(lows), np.array(highs)),
    )
    return tree, leaves


def _rows(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(-1, width)


class Index:
    """Distinct vectors in blocks of a kd-tree over their projections, ready to be searched."""

    def __init__(self, rows: DataFrame, id_name: str, vector: str, neighbours: int, chance: float) -> None:
        self.neighbours, self.id, self.vector = neighbours, id_name, vector
        self.limit = chi_square_at(chance, DIMENSIONS)
        self.valid, self.width = _usable(rows, id_name, vector)
        longest = self.valid.agg(F.max(F.expr("aggregate(_vec, 0D, (sum, x) -> sum + x * x)"))).first()[0]
        self.longest = longest or 0.0
        # Copies of a vector are one point, with the smallest of their ids: more cannot be answers.
        same = Window.partitionBy("_vec").orderBy("_id")
        points = (
            self.valid.distinct()
            .withColumn("_nth", F.row_number().over(same))
            .where(F.col("_nth") <= neighbours + 1)
            .groupBy("_vec")
            .agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
        )
        projected = numbered(self._projected(points, extended=True), "_point", "neighbours")
        self.count = projected.count()
        sample = (
            projected.select("_point", "_at").orderBy(F.xxhash64("_point"), "_point").limit(SAMPLE_ROWS).collect()
        )
        sampled = np.array([row["_at"] for row in sample]).reshape(-1, DIMENSIONS)
        leaves = min(MOST_LEAVES, -(-self.count // BLOCK_ROWS)) or 1
        self.tree, _ = grown(sampled, -(-len(sampled) // leaves) or 1, tight=False)
        placed = stored(projected.withColumn("_leaf", self._leaf("_at")), "neighbours")
        # One number for each leaf; a leaf over the block size is dealt to several blocks.
        sizes = {row[0]: row[1] for row in placed.groupBy("_leaf").count().collect()}
        self.blocks = {leaf: -(-size // BLOCK_ROWS) for leaf, size in sizes.items()}
        self.points = placed.withColumn(
            "_block", F.pmod(F.xxhash64("_point"), self._of_leaf(self.blocks)).cast("int")
        )

    def _projected(self, rows: DataFrame, extended: bool) -> DataFrame:
        """Rows with `_at`. Points get one more component, so that all are equally long and the
        nearest to a query, which has 0 there, is that of the largest inner product."""
        width, longest = self.width, self.longest
        schema = rows.withColumn("_at", F.array().cast("array<double>")).schema

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lines = np.random.default_rng(_SEED).standard_normal((width + 1, DIMENSIONS))
            for batch in batches:
                vectors = _rows(batch["_vec"], width)
                last = np.zeros(len(vectors))
                if extended:
                    last = np.sqrt(np.maximum(longest - np.einsum("nd,nd->n", vectors, vectors), 0))
                at = np.einsum("nd,dm->nm", np.column_stack([vectors, last]), lines)
                yield batch.assign(_at=list(at))

        return rows.mapInPandas(project, schema)

    def _leaf(self, at: str):
        tree = self.tree

        @F.pandas_udf("int")
        def leaf(points: pd.Series) -> pd.Series:
            return pd.Series(tree.leaf_of(_rows(points, DIMENSIONS)).astype("int32"))

        return leaf(F.col(at))

    @staticmethod
    def _of_leaf(numbers: dict[int, int]):
        if not numbers:
            return F.lit(1)
        pairs = [F.lit(part) for pair in sorted(numbers.items()) for part in pair]
        return F.coalesce(F.create_map(*pairs)[F.col("_leaf")], F.lit(1))

    def search(self, queries: DataFrame) -> DataFrame:
        """(query id, rank, id, score) of each query's neighbours.

        `queries` are rows of the index's table. Distinct vectors are searched for once, in the
        leaf they fall into; the distance found there then tells which other leaves they must see.
        """
        asked = _usable(queries, self.id, self.vector, self.width)[0].distinct()
        vectors = numbered(self._projected(asked.select("_vec").distinct(), extended=False), "_query", "neighbours")
        home = vectors.withColumn("_leaf", self._leaf("_at")).withColumn("_bound", F.lit(float("inf")))
        first = stored(self._searched(home), "neighbours")
        rest = stored(self._searched(self._elsewhere(home, first)), "neighbours")
        self.searches = first.unionByName(rest)
        best = Window.partitionBy("_query").orderBy(F.desc("score"), "_id")
        found = (
            self.searches.withColumn("_nth", F.row_number().over(best))
            .where(F.col("_nth") <= self.neighbours + 1)
        )
        lists = found.groupBy("_query").agg(
            F.sort_array(F.collect_list(F.struct("_nth", "_id", "score"))).alias("_found")
        )
        answers = stored(vectors.select("_query", "_vec").join(lists, "_query"), "neighbours")
        # Each query leaves itself out and takes the first of what is left.
        others = F.slice(
            F.filter("_found", lambda one: one["_id"] != F.col("query_id")), 1, self.neighbours
        )
        return (
            asked.withColumnRenamed("_id", "query_id")
            .join(answers, "_vec")
            .select("query_id", F.posexplode(others).alias("_place", "_one"))
            .select(
                "query_id",
                (F.col("_place") + 1).alias("rank"),
                F.col("_one._id").alias(self.id),
                F.col("_one.score").alias("score"),
            )
        )

    def _elsewhere(self, home: DataFrame, first: DataFrame) -> DataFrame:
        """Queries with each other leaf that the stopping test does not exclude."""
        tree, limit, longest, needed = self.tree, self.limit, self.longest, self.neighbours + 1

        @F.pandas_udf("array<int>")
        def leaves(at: pd.Series, squares: pd.Series, own: pd.Series) -> pd.Series:
            found = []
            for point, square, mine in zip(_rows(at, DIMENSIONS), squares, own):
                near = tree.distances(point) <= (square + _SLACK) * limit
                found.append([int(leaf) for leaf in np.flatnonzero(near) if leaf != mine])
            return pd.Series(found)

        ranked = Window.partitionBy("_query").orderBy(F.desc("score"), "_id")
        last = (
            first.withColumn("_nth", F.row_number().over(ranked))
            .where(F.col("_nth") == needed)
            .select("_query", F.col("score").alias("_last"))
        )
        length = F.expr("aggregate(_vec, 0D, (sum, x) -> sum + x * x)")
        return (
            home.join(last, "_query", "left")
            .withColumn(
                "_bound", F.coalesce(F.greatest(length + longest - 2 * F.col("_last"), F.lit(0.0)), F.lit(float("inf")))
            )
            .withColumn("_leaf", F.explode(leaves("_at", "_bound", "_leaf")))
            .select(*home.columns)
        )

    def _searched(self, queries: DataFrame) -> DataFrame:
        """The best of every block, for each query that comes with one of its leaves."""
        # One number for each leaf. A block meets its queries in parts of a bounded size.
        asking = stored(queries, "neighbours")
        waiting = {row[0]: row[1] for row in asking.groupBy("_leaf").count().collect()}
        parts = self._of_leaf({leaf: -(-size // QUERY_ROWS) for leaf, size in waiting.items()})
        all_parts = F.sequence(F.lit(0), parts - 1)
        blocks = F.sequence(F.lit(0), self._of_leaf(self.blocks) - 1)
        points = self.points.where(F.col("_leaf").isin(sorted(waiting))).withColumn("_part", F.explode(all_parts))
        dealt = asking.withColumn("_part", F.pmod(F.xxhash64("_query"), parts).cast("int")).withColumn(
            "_block", F.explode(blocks)
        )
        key = ["_leaf", "_block", "_part"]
        width, longest, limit, needed = self.width, self.longest, self.limit, self.neighbours + 1

        def search(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(held) and len(asked):
                where = f"{held['_leaf'].iloc[0]}.{held['_block'].iloc[0]}"
                block = Block(_rows(held["_vec"], width), _rows(held["_at"], DIMENSIONS), held["_ids"].tolist(), longest)
                for number, vector, at, bound in zip(
                    asked["_query"], _rows(asked["_vec"], width), _rows(asked["_at"], DIMENSIONS), asked["_bound"]
                ):
                    found, seen = block.nearest(vector, at, bound, limit, needed)
                    out += [(number, one, score, where, seen) for score, one in found]
            return pd.DataFrame(out, columns=["_query", "_id", "score", "_block", "_seen"])

        return (
            points.groupBy(*key)
            .cogroup(dealt.groupBy(*key))
            .applyInPandas(search, "_query long, _id long, score double, _block string, _seen long")
        )


class Block:
    """Distinct vectors with a kd-tree over their projections, searched for one query at a time."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray, ids: list, longest: float) -> None:
        self.vectors, self.projected, self.ids, self.longest = vectors, projected, ids, longest
        self.copies = np.array([len(one) for one in ids])
        self.tree, self.leaves = grown(projected, _LEAF_ROWS, tight=True)

    def neighbours_of(
        self, at: np.ndarray, within: Callable[[], float] = lambda: math.inf
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points in order of projected distance, some at a time, with these distances, squared.

        Leaves are taken in order of the distance to their boxes; no leaf after the first `_LEAVES`, or twice
        as many and so on, can hold a point nearer than the next of these boxes. `within` tells, whenever
        asked, up to which distance points are wanted; it never grows. All leaves up to there are opened
        and their points sorted at once, or, with no distance known, as many leaves again as are open.
        """
        boxes = self.tree.distances(at)
        order = boxes.argsort(kind="stable")
        boxes = boxes[order]
        ends = boxes[_LEAVES::_LEAVES]
        waiting, distances, opened, given = np.empty(0, dtype=np.int64), np.empty(0), 0, 0
        while opened < len(boxes) and not boxes[opened] > (reach := within()):
            known = -(-int(boxes.searchsorted(reach, "right")) // _LEAVES) * _LEAVES
            until = known if reach < math.inf else max(_LEAVES, 2 * opened)
            points = np.concatenate([self.leaves[leaf] for leaf in order[opened:until]])
            apart = self.projected.take(points, axis=0)
            apart -= at
            waiting = np.concatenate([waiting, points])
            distances = np.concatenate([distances, np.einsum("nd,nd->n", apart, apart)])
            opened = until
            ranks = distances.argsort()
            waiting, distances = waiting[ranks], distances[ranks]
            ready = int(distances.searchsorted(boxes[until] if until < len(boxes) else math.inf, "right"))
            places, apart = waiting[:ready], distances[:ready]
            waiting, distances = waiting[ready:], distances[ready:]
            begin = 0
            for end in [*apart.searchsorted(ends, "right").tolist(), ready]:
                while begin < end:
                    some = slice(begin, min(end, begin + max(_POINTS, given // 6)))
                    yield places[some], apart[some]
                    begin, given = some.stop, given + some.stop - begin

    def nearest(self, query: np.ndarray, at: np.ndarray, bound: float, limit: float, needed: int) -> tuple[list, int]:
        """The `needed` best (score, id), ties by id, and how many points were verified to find them.

        `bound` is the squared distance that a point has to beat, as far as is known. The search ends
        at a point whose projected distance a nearer one would exceed with less than the chance left.
        Points stay as long as their score, rounded, may tie with the last that is needed.
        """
        square = float(query @ query)
        margin = _ROUNDING * math.sqrt(square * self.longest)
        places, scores, seen, worst = np.empty(0, dtype=np.int64), np.empty(0), 0, -math.inf

        def within() -> float:
            return (bound + _SLACK) * limit

        for points, distances in self.neighbours_of(at, within):
            if distances[0] > within():
                break
            seen += len(points)
            new = self.vectors.take(points, axis=0) @ query
            good = (new >= worst - margin).nonzero()[0]
            if not len(good):
                continue
            places, scores = np.concatenate([places, points[good]]), np.concatenate([scores, new[good]])
            order = (-scores).argsort()
            held = self.copies[places[order]].cumsum()
            if held[-1] >= needed:
                worst = float(scores[order[int(held.searchsorted(needed))]])
                kept = scores >= worst - margin
                places, scores = places[kept], scores[kept]
                bound = min(bound, max(square + self.longest - 2 * worst, 0.0))
        # Products of 32-bit components are exact, and so is their sum here.
        exact = [math.fsum(products) for products in (self.vectors[places] * query).tolist()]
        found = [(score, int(one)) for score, place in zip(exact, places) for one in self.ids[place]]
        return sorted(found, key=lambda one: (-one[0], one[1]))[:needed], seen


def _usable(rows: DataFrame, id_name: str, vector: str, width: int | None = None) -> tuple[DataFrame, int]:
    """(_id, _vec) of rows that take part, and the vectors' length, by default the most frequent one."""
    fine = (
        rows.select(F.col(f"`{id_name}`").cast("long").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_vec"))
        .where("_id is not null and _vec is not null and size(_vec) > 0")
        .where("forall(_vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        .where("exists(_vec, x -> x <> 0)")
    )
    if width is None:
        lengths = fine.groupBy(F.size("_vec").alias("n")).count()
        top = lengths.orderBy(F.desc("count"), F.desc("n")).first()
        width = top["n"] if top else 1
    return fine.where(F.size("_vec") == width), width


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    id_name: str = "vec_id",
    vector: str = "embedding",
    neighbours: int = 20,
    chance: float = CHANCE,
) -> DataFrame:
    """(query_id, rank, `id_name`, score): for each query the rows of the largest inner product.

    Ranks begin at 1; ties go to the smaller id; a query's own id is left out, and rows with one id
    and one vector count once. Rows take part if the id is not null and the vector is not null, empty
    or zero, has neither null nor non-finite components, and is as long as most are. Fewer rows than
    asked for give them all; an empty table gives an empty one. Other columns are not looked at.

    The search is approximate: each neighbour is found with the probability `chance` or better.
    """
    return Index(rows, id_name, vector, neighbours, chance).search(queries)


def op5_nearest(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
