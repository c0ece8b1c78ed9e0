"""Every bound query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry_point
from conftest import SF_DIR
from dayblotter import bindings, oracles

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


def test_every_query_has_sql():
    assert set(bindings.QUERIES) == set(oracles.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = duck.execute(ORACLES[name])
    columns = {column[0]: str(column[1]) for column in found.description}
    assert dict(df.dtypes) == {name: SPARK_TYPES[kind] for name, kind in columns.items()}
    expected = found.fetchall()
    assert expected
    assert in_order(map(tuple, df.select(*columns).collect())) == in_order(expected)


def test_entry_is_the_ward_summary(spark):
    df = entry_point.entry(spark)
    assert df.count() == 25
    assert df.columns[0] == "ward"
