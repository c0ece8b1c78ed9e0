"""Ranks, previous rows and pages of whole tables, against one task that sees all rows."""

import contextlib
import io
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_DIR
from dayblotter import bindings
from dayblotter.operators.global_windows import dense_rank_rows, previous_rows
from dayblotter.operators.paging import PageIndex, number_rows
from dayblotter.session import new_folder
from test_plans import plan, shuffles

NUMBERS = "id long, n int, x double, t string, d date"


def made(spark, count, seed=1):
    """A third of all rows share a value, and some have none."""
    rng = random.Random(seed)
    rows = []
    for number in rng.sample(range(10 * count), count):
        value = rng.choice([7, rng.randrange(count), rng.choice([None, -1, rng.randrange(50)])])
        rows.append((number, value, None if value is None else value / 3, rng.choice(["a", None, f"t{value}"]), None))
    return spark.createDataFrame(rows, NUMBERS).repartition(6)


@pytest.mark.parametrize("column", ["n", "x", "t", "d"])
@pytest.mark.parametrize("count", [0, 1, 700])
def test_ranks_are_those_of_one_task(spark, rows, column, count):
    df = made(spark, count)
    got = dense_rank_rows(df, column, "up", "down")
    both = {"up": F.col(column).asc_nulls_first(), "down": F.col(column).desc_nulls_last()}
    one = df.withColumns({name: F.dense_rank().over(Window.orderBy(order)).cast("long") for name, order in both.items()})
    assert got.columns == one.columns and rows(got) == rows(one)


@pytest.mark.parametrize("count", [0, 1, 5, 700])
def test_previous_rows_are_those_of_one_task(spark, rows, count):
    df = made(spark, count)
    got = previous_rows(df, "id", ["n", "t", "d"])
    order = Window.orderBy("id")
    one = df.withColumns({f"prev_{name}": F.lag(name).over(order) for name in ("n", "t", "d")})
    assert got.columns == one.columns and rows(got) == rows(one)


def test_previous_rows_over_ranges_without_rows(spark, rows):
    """Keys in two heaps: a range may have no rows, and its edge is handed on."""
    df = spark.range(40).selectExpr("if(id < 20, id, 1000000 + id) as id", "id * id as n")
    got = previous_rows(df, "id", ["n"])
    assert rows(got) == rows(df.withColumn("prev_n", F.lag("n").over(Window.orderBy("id"))))


@pytest.mark.parametrize("name", ["order_ranks", "event_change"])
def test_no_task_sees_all_rows(spark, name):
    df = bindings.QUERIES[name](spark, SF_DIR)
    df.collect()
    text = plan(df)
    assert "SinglePartition" not in text and "Python" not in text


def test_rows_with_one_value_are_split(spark):
    """Both sides of the join with the ranks are read from files, for Spark to split a large partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {name: spark.conf.get(name) for name in settings}
    folder = new_folder(spark, "hot")
    spark.range(0, 200_000, 1, 8).selectExpr("id", "if(id % 3 = 0, 7, id % 5000) as n", "uuid() as u").write.parquet(folder)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = dense_rank_rows(spark.read.parquet(folder), "n", "up")
        got.write.format("noop").mode("overwrite").save()
        got.collect()
        assert "skew=true" in plan(got)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("key", ["id", "k"])
def test_pages_by_an_index(spark, key):
    df = made(spark, 1000).withColumn("k", F.concat(F.lit("key-"), F.lpad(F.col("id").cast("string"), 6, "0")))
    folder = new_folder(spark, "index")
    assert PageIndex.of(df, key, 50).store(df, key, folder).rows == 1000
    index = PageIndex.load(spark, folder)
    numbers = [row[key] for row in number_rows(df, key).orderBy("row_number").collect()]
    for limit, page in [(1, 0), (1, 999), (7, 0), (7, 71), (7, 142), (300, 1), (300, 3), (1000, 0), (5000, 0)]:
        got = index.page(df, key, limit, page)
        assert [row[key] for row in got.collect()] == numbers[limit * page : limit * (page + 1)]
        assert got.columns == df.columns
    assert index.page(df, key, 7, 143).collect() == [] == index.page(df, key, 7, -1).collect()


def test_pages_of_tables_without_rows_with_one_and_with_a_null_key(spark):
    for rows in ([], [(5,)], [(None,), (3,), (1,)]):
        df = spark.createDataFrame(rows, "id long")
        index = PageIndex.of(df, "id", 4)
        got = [row.id for page in range(3) for row in index.page(df, "id", 2, page).collect()]
        assert got == [row.id for row in number_rows(df, "id").orderBy("row_number").collect()]


def test_a_page_scans_a_range_of_keys(spark):
    folder = new_folder(spark, "sorted")
    spark.range(0, 200_000, 1, 1).selectExpr("id", "uuid() as u").write.option("parquet.block.size", 64 << 10).parquet(folder)
    df = spark.read.parquet(folder)
    page = PageIndex.of(df, "id").page(df, "id", 100, 1234)
    page.collect()
    with contextlib.redirect_stdout(io.StringIO()) as text:
        page.explain("formatted")
    text = text.getvalue()
    assert re.search(r"PushedFilters: \[.*GreaterThan\(id,\d+\), LessThanOrEqual\(id,\d+\)", text)
    assert shuffles(plan(page)) <= 2
    assert scanned(page) < 20_000


def scanned(df):
    """Rows that the scans of an executed frame have read, after what footers leave out."""
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for place in range(children.size()):
            walk(children.apply(place))
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            walk(node.plan())

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_the_query_reads_a_page(spark, duck):
    from dayblotter.oracles import ORACLES

    got = bindings.page_read(spark, SF_DIR).collect()
    assert [tuple(row) for row in got] == sorted(duck.execute(ORACLES["page_read"]).fetchall())
