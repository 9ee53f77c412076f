"""Long category rows to wide columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import rate_per
from panelloom.operators.aggregates import sum_or_zero


def category_totals(df: DataFrame, keys: Sequence[str], category: str, value: str, name: str = "total") -> DataFrame:
    """The long form of a pivot: one row per key and category present, whatever their number."""
    known = df.filter(F.col(category).isNotNull())
    return known.groupBy(*keys, category).agg(sum_or_zero(F.col(value)).alias(name))


def category_sums(category: str, value: str, values: Sequence[str], prefix: str) -> list[Column]:
    """One sum per category, 0 where the group lacks it.

    Plain conditional sums share one ``agg`` with every other total of the same key, so the
    pivot needs no exchange of its own.
    """
    return [sum_or_zero(F.when(F.col(category) == v, F.col(value))).alias(f"{prefix}{v}") for v in values]


def category_count(category: str, values: Sequence[str]) -> Column:
    """How many of ``values`` occur in the group, without a distinct aggregate."""
    total = F.lit(0).cast("long")
    for v in values:
        total = total + F.coalesce(F.max(F.when(F.col(category) == v, F.lit(1))), F.lit(0))
    return total


def add_rates(df: DataFrame, prefix: str, rate_prefix: str, population: str, per: float) -> DataFrame:
    """A rate for every column that starts with ``prefix``."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumns(
        {rate_prefix + c[len(prefix):]: rate_per(F.col(c), F.col(population), per) for c in cols}
    )


def rename_prefix(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by prefix."""
    names = {}
    for c in df.columns:
        for old, new in mapping.items():
            if c.startswith(old):
                names[c] = new + c[len(old):]
                break
    return df.withColumnsRenamed(names)
