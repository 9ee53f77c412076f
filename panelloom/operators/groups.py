"""Values of a row relative to its group.

Group totals come from a partially aggregated pass and are joined back, instead of a
window that would bring a whole group into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.operators.joins import match_nulls
from panelloom.session import materialize


def with_group_values(df: DataFrame, group: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Add aggregates of the row's group; NULL keys form a group of their own.

    ``df`` is read twice, so pass a scan or a stored table rather than a long plan.
    """
    stats = df.groupBy(*group).agg(*[v.alias(name) for name, v in values.items()])
    return match_nulls(df, materialize(stats, "group-values"), group)


def zscore(df: DataFrame, group: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Population z-score per group: 0 where the group does not vary, NULL stays NULL."""
    stats = {}
    for c in columns:
        stats |= {
            f"_{c}_avg": F.avg(c),
            f"_{c}_sd": F.stddev_pop(c),
            f"_{c}_flat": F.min(c) == F.max(c),
        }
    joined = with_group_values(df, group, stats)
    scores = {
        name: F.when(F.col(c).isNull(), None)
        .when(F.col(f"_{c}_flat") | (F.col(f"_{c}_sd") == 0), F.lit(0.0))
        .otherwise((F.col(c) - F.col(f"_{c}_avg")) / F.nullif(F.col(f"_{c}_sd"), F.lit(0.0)))
        for c, name in columns.items()
    }
    return joined.withColumns(scores).drop(*stats)


def share_of_group(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """``value`` over its group's total; NULL where the total is not positive."""
    joined = with_group_values(df, group, {"_total": F.sum(value)})
    share = F.when(F.col("_total") > 0, F.col(value) / F.col("_total"))
    return joined.withColumn(name, share).drop("_total")
