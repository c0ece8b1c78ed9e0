from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayblotter.functions import columns, dates, numbers
from dayblotter.schemas import struct


def values(spark, schema, rows, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, struct(schema)).select(*exprs).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 on 2024-03-10 does not exist in New York, 01:30 on 2024-11-03 happens twice.
        stamps = ["2024-03-10T02:30:00.001", "2024-11-03T01:30:00.999", "2024-11-03T06:30:00.000"]
        text = F.col("text")
        got = values(
            spark,
            "text string",
            [(s,) for s in stamps],
            dates.millisecond_text(dates.parse_wall_clock(text)),
            dates.millisecond_text(dates.utc_wall_clock(dates.parse_instant(F.concat(text, F.lit("Z"))))),
            F.hour(dates.parse_wall_clock(text)),
        )
        assert got == [(s, s, int(s[11:13])) for s in stamps]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_milliseconds_are_cut_not_rounded(spark):
    stamps = [datetime(2024, 1, 1, 0, 0, 0, 999999), datetime(2024, 1, 1, 0, 0, 0, 5000), datetime(2024, 1, 1)]
    got = values(spark, "t timestamp_ntz", [(s,) for s in stamps], dates.millisecond_text(F.col("t")))
    assert got == [("2024-01-01T00:00:00.999",), ("2024-01-01T00:00:00.005",), ("2024-01-01T00:00:00.000",)]


def test_parts_of_the_day(spark):
    times = {
        "00:00:00": "night", "05:59:59.999": "night", "06:00:00": "morning", "11:59:59": "morning",
        "12:00:00": "afternoon", "17:59:59": "afternoon", "18:00:00": "evening", "23:59:59": "evening",
    }
    rows = [(datetime.fromisoformat(f"2024-05-05T{t}"),) for t in times] + [(None,)]
    got = values(spark, "t timestamp_ntz", rows, dates.time_of_day(F.col("t")))
    assert [g[0] for g in got] == [*times.values(), "unknown"]


def test_long_dates(spark):
    got = values(
        spark, "t string", [("Monday, January 2, 2023",), ("Thursday, November 28, 2024",), (None,)],
        dates.parse_long_date(F.col("t")), dates.weekday_number(dates.parse_long_date(F.col("t"))),
    )
    assert got == [(date(2023, 1, 2), 0), (date(2024, 11, 28), 3), (None, None)]


def test_percent_text(spark):
    points = [0, 50, -56, 1234, -9999, 99999, 100000, -100000, None]
    got = values(spark, "p bigint", [(p,) for p in points], numbers.percent_text(F.col("p")))
    assert [g[0] for g in got] == [
        "   0.00%", "   0.50%", "  -0.56%", "  12.34%", " -99.99%", " 999.99%", " ###.##%", "-###.##%", None,
    ]


def test_hundreds_floors(spark):
    got = values(spark, "n int", [(733,), (99,), (0,), (-1,), (-100,), (None,)], numbers.hundreds(F.col("n")))
    assert [g[0] for g in got] == [7, 0, 0, -1, -1, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**9)), min_size=20, max_size=60))
def test_ratios_are_exact(spark, pairs):
    n, d = F.col("n"), F.col("d")
    got = values(
        spark, "n bigint, d bigint", pairs,
        numbers.basis_points(n, d), numbers.rounded_mean(F.abs(n), d), numbers.truncated_quotient(n, d),
    )
    for (numerator, denominator), (points, mean, quotient) in zip(pairs, got):
        exact = Decimal(numerator) * 10000 / Decimal(denominator)
        assert points == int(exact.quantize(Decimal(1), ROUND_HALF_UP))
        assert mean == (Decimal(abs(numerator)) / denominator).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert quotient == int(Decimal(numerator) / denominator)


def test_headers_and_structs(spark):
    df = spark.sql("select 1 as `ZIP CODE`, named_struct('a', 2, ':b', named_struct('c', 3)) as `Loc`")
    plain = columns.with_plain_headers(df)
    assert plain.columns == ["zip_code", "loc"]
    flat = columns.flatten_structs(plain)
    assert flat.columns == ["zip_code", "loc.a", "loc.:b.c"]
    assert tuple(flat.first()) == (1, 2, 3)


def test_conform(spark):
    df = spark.sql("select '7' as b, 'x' as a")
    got = columns.conform(df, struct("a string, b int, c double"))
    assert got.dtypes == [("a", "string"), ("b", "int"), ("c", "double")]
    assert tuple(got.first()) == ("x", 7, None)
    with pytest.raises(ValueError):
        columns.conform(df, struct("a string"))


def test_nan_becomes_null(spark):
    df = spark.sql("select * from values (double('nan'), 'NaN'), (1.5D, 'x'), (null, null) as t(d, s)")
    assert [tuple(r) for r in columns.missing_to_null(df).collect()] == [(None, "NaN"), (1.5, "x"), (None, None)]
