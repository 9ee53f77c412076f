"""Aggregate expressions for one ``groupBy().agg()``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum(v*w)/Sum(w) over rows with a positive weight, else the plain mean of ``value``."""
    usable = value.isNotNull() & (weight > 0)
    weighted = F.try_divide(F.sum(F.when(usable, value * weight)), F.sum(F.when(usable, weight)))
    return F.coalesce(weighted, F.avg(value))


def sum_or_zero(col: Column) -> Column:
    """Sum that is 0 for a group with nothing to add."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def first_known(value: Column, order: Column) -> Column:
    """Value of the earliest row whose value is known."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def last_known(value: Column, order: Column) -> Column:
    """Value of the latest row whose value is known."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def month_set(month: Column) -> Column:
    """The months seen, one bit each: a fixed-width stand-in for a distinct count."""
    return F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1), month)), F.lit(0))


def sorted_text(col: Column, separator: str = "; ") -> Column:
    """Distinct values of a group, sorted and joined; aggregate distinct rows first."""
    return F.array_join(F.array_sort(F.collect_set(col)), separator)
