"""Exact ratios, averages and guards, as column expressions."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.schemas import MARKDOWNS


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def mean(column: Column) -> Column:
    """Average over an exact sum.

    ``avg`` on a decimal keeps only four more digits than its input and
    rounds there, which shifts two-digit results at exact half cents.
    """
    return ratio(F.sum(column), F.count(column))


def mean2(column: Column) -> Column:
    return F.round(mean(column), 2)


def exact_mean(column: Column) -> Column:
    """Average with twelve decimals, fit for further decimal arithmetic."""
    return mean(column).cast("decimal(24,12)")


def percent_change(current: Column, base: Column) -> Column:
    """``(current - base) / base * 100`` with the factor applied before the
    division, so no digits are lost to the decimal type of the quotient."""
    return ratio((current - base) * F.lit(100), base)


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def or_zero(column: Column) -> Column:
    """NULL and NaN become 0; for the raw, double typed columns."""
    return F.coalesce(nan_to_null(column), F.lit(0.0))


def markdown_total(prefix: str = "") -> Column:
    return reduce(add, [F.col(prefix + m) for m in MARKDOWNS])


def active_markdowns() -> Column:
    """How many of the five markdowns are above zero."""
    return reduce(add, [(F.col(m) > 0).cast("int") for m in MARKDOWNS])


def mean_of(total: Column, count: Column) -> Column:
    """Unrounded average as a double, from an exact sum and a count."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def quotient(numerator: Column, denominator: Column) -> Column:
    """Unrounded ratio as a double, NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
