"""Key checks and audit counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import known


class DuplicateKeyError(ValueError):
    """A key that must be unique repeats."""


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key that an earlier row already holds."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"))
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise with the number of surplus rows."""
    surplus = surplus_rows(df, keys).first()["surplus_rows"]
    if surplus:
        raise DuplicateKeyError(f"{surplus} surplus rows repeat the key {list(keys)}")
    return df


def audit_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: the number of rows, and of rows for which each check holds."""
    return df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(known(check)).alias(name) for name, check in checks.items()],
    )
