"""Arithmetic that tolerates NULL and zero, and equi-width bins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zero_filled(fields: Sequence[ColumnOrName]) -> list[Column]:
    if isinstance(fields, (str, Column)):
        raise TypeError("pass one list of columns")
    return [F.coalesce(as_column(c), F.lit(0)) for c in fields]


def safe_add(fields: Sequence[ColumnOrName]) -> Column:
    """Sum with NULL counted as 0."""
    return reduce(lambda a, b: a + b, _zero_filled(fields))


def safe_subtract(fields: Sequence[ColumnOrName]) -> Column:
    """First minus all others, with NULL counted as 0."""
    return reduce(lambda a, b: a - b, _zero_filled(fields))


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient, or NULL when the divisor is 0 or an operand is NULL."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``safe_divide`` of exact numbers, rounded half up.

    The numerator's type leaves at least 15 decimals to the quotient, so that
    rounding it a second time does not move it across a tie.
    """
    return F.round(safe_divide(numerator.cast("decimal(25,4)"), denominator), digits)


def percentage(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole)


def mean(value: ColumnOrName) -> Column:
    """Average over non-NULL values, as one division of an exact sum."""
    return safe_divide(F.sum(value).cast("double"), F.count(value))


def width_bucket(
    value: ColumnOrName, low: ColumnOrName | float, high: ColumnOrName | float, buckets: ColumnOrName | int
) -> Column:
    """Bin 1..n of equal width; 0 below the range and n + 1 at or above its end."""

    def operand(x: ColumnOrName | float) -> Column:
        return F.lit(x) if isinstance(x, (int, float)) else as_column(x)

    return F.width_bucket(
        as_column(value).cast("double"),
        operand(low).cast("double"),
        operand(high).cast("double"),
        operand(buckets).cast("bigint"),
    )
