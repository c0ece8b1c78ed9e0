"""What the operators share: words, written working tables, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter.session import new_folder

SPACES = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 256


def words_of(text: Column) -> Column:
    """The words of a text, split at ASCII white space only; a null text has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(pieces, lambda word: word != "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let tasks pass texts to Python by the hundred, not by the ten thousand as is the default.

    Rows of this kind are long; a batch is held several times over on its way. The setting stays
    with the session, since the frames that operators return run later.
    """
    most = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if most <= 0 or most > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


_WORKING: list[str] = []


@contextmanager
def working_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """Within it, operators put their working tables into one new folder, which is given.

    Frames that operators return go on reading their working tables. Once what a frame holds has been
    written, `remove_folder` may take the folder away.
    """
    folder = new_folder(spark, purpose)
    _WORKING.append(folder)
    try:
        yield folder
    finally:
        _WORKING.remove(folder)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    It cuts the lineage in a way that survives lost executors, and fixes what Spark might otherwise
    work out twice and differently, such as row numbers.
    """
    spark = df.sparkSession
    path = f"{_WORKING[-1]}/{purpose}-{uuid4().hex}" if _WORKING else new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without columns that would clash with those an operator adds."""
    taken = {name.lower() for name in names}
    return df.select(*[df[f"`{name}`"] for name in df.columns if name.lower() not in taken])


def carried(df: DataFrame, names: Iterable[str] | None, taken: Iterable[str]) -> list[str]:
    """The columns of `df` to carry along: those named, or all, but for names that an operator takes.

    An operator takes the names of the columns it adds, and of its working columns, which begin with
    an underscore.
    """
    given = {name.lower() for name in taken}
    return [name for name in names or df.columns if name.lower() not in given]


def numbered(df: DataFrame, name: str, purpose: str) -> DataFrame:
    """The frame, stored, with a unique number for every row, repeated rows included."""
    return stored(without(df, [name]).withColumn(name, F.monotonically_increasing_id()), purpose)


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of the undirected `edges` (a long, b long): the smallest node reachable.

    Alternates large and small stars. A round costs two aggregations, which combine before the
    shuffle, and two joins on the node; every round is stored, so no lineage grows, and only a
    count of changed edges reaches the driver. Smallest neighbours are stored before they are joined
    to the edges they were taken from: the join then shuffles for itself, and Spark splits a node that
    a large part of all edges leads to. Self links and repeated links do no harm; null ends
    are left out.
    """
    now = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "components",
    )
    for _ in range(most_rounds):
        # Large star: larger neighbours of a node are linked to its smallest neighbour.
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "components")
        large = stored(
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct(),
            "components",
        )
        # Small star: smaller neighbours of a node, and the node, are linked to the smallest of them.
        lowest = stored(large.groupBy("a").agg(F.min("b").alias("m")), "components")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(
            small.unionByName(lowest.withColumnRenamed("m", "b")).where("a <> b").distinct(), "components"
        )
        same = after.count() == now.count() and after.join(now, ["a", "b"], "left_anti").isEmpty()
        now = after
        if same:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            own = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return roots.unionByName(own)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
