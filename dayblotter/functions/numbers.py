"""Exact ratio arithmetic on counts, and its fixed-width text form."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncated_quotient(numerator: Column, denominator: Column) -> Column:
    """Integer division towards zero."""
    return F.call_function("div", numerator, denominator)


def basis_points(numerator: Column, denominator: Column) -> Column:
    """Hundredths of a percent of numerator / denominator, rounded half away from zero.

    Stays in bigint: exact for counts below 4e14 and free of decimal division.
    """
    size = truncated_quotient(F.lit(20000) * F.abs(numerator) + denominator, F.lit(2) * denominator)
    return F.when(numerator < 0, -size).otherwise(size)


def rounded_mean(total: Column, count: Column) -> Column:
    """total / count to two places, half away from zero, for totals that are not negative."""
    cents = truncated_quotient(F.lit(200) * total + count, F.lit(2) * count)
    return hundredths(cents)


def hundredths(units: Column) -> Column:
    """bigint hundredths -> decimal with two places."""
    return (units.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def percent_text(points: Column) -> Column:
    """Basis points as '  12.34%': seven places and a percent sign.

    From 1000 percent on the digits give way to '#'. No value, no text.
    """
    digits = F.lpad(hundredths(points).cast("string"), 7, " ")
    return (
        F.when(points.isNull(), F.lit(None).cast("string"))
        .when(F.abs(points) < 100000, F.concat(digits, F.lit("%")))
        .when(points < 0, "-###.##%")
        .otherwise(" ###.##%")
    )


def hundreds(number: Column) -> Column:
    """floor(number / 100.0) in integer arithmetic, also below zero."""
    number = number.cast("bigint")
    return truncated_quotient(number - F.pmod(number, F.lit(100)), F.lit(100))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)
