"""Unions, de-duplication and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_same(*frames: DataFrame) -> DataFrame:
    """Union all by name; every frame has the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_missing(*frames: DataFrame) -> DataFrame:
    """Union all by name; a column a frame lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_by_priority(df: DataFrame, keys: Sequence[str], *priority: Column) -> DataFrame:
    """One row per key: the one with the lowest priority.

    An aggregate, so repeats are dropped before the exchange; columns of ``priority`` must
    decide every tie.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(priority)])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), rank).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def top_rows(df: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows: each task keeps ``k`` candidates, no full sort."""
    return df.orderBy(*by).limit(k)


def best_and_worst(
    df: DataFrame, by: str, tie: Sequence[str], k: int = 5, best: str = "lowest_error_examples",
    worst: str = "highest_error_examples",
) -> DataFrame:
    """The ``k`` rows with the lowest and the ``k`` with the highest known ``by``, labelled."""
    known = df.filter(F.col(by).isNotNull())
    ties = [F.col(c) for c in tie]
    low = top_rows(known, [F.col(by).asc(), *ties], k).withColumn("example", F.lit(best))
    high = top_rows(known, [F.col(by).desc(), *ties], k).withColumn("example", F.lit(worst))
    return low.unionByName(high)
