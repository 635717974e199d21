"""Sums, means and shares that give the same result whatever the task order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def addend(column: str, scale: int | None) -> Column:
    """The value as it is summed: double, or decimal with ``scale`` digits.

    Double sums depend on the order partial sums meet in. Amounts with a known
    number of decimals are summed as decimals instead, which is exact; a value
    that does not fit decimal(18, scale) raises rather than being dropped.
    """
    value = F.col(column)
    return value if scale is None else value.cast(f"decimal(18,{scale})")


def total(column: str, scale: int | None = None) -> Column:
    return F.sum(addend(column, scale)).cast("double")


def mean(column: str, scale: int | None = None) -> Column:
    if scale is None:
        return F.avg(column)
    return F.try_divide(total(column, scale), F.count(column))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, null for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)
