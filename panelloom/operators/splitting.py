"""Temporal split, split summary and expanding validation folds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import known
from panelloom.operators.joins import match_nulls
from panelloom.operators.radix import exact_quantiles


def valid_target(change: Column, level: Column, complete: Column | None) -> Column:
    """Both targets known, the level positive and, unless ``complete`` is None, a full period."""
    ok = change.isNotNull() & level.isNotNull() & (level > 0)
    return known(ok if complete is None else ok & known(complete))


def temporal_split(df: DataFrame, year: str, train: tuple[int, int], test: int) -> DataFrame:
    """Rows of the training years and the test year, labelled in ``split``."""
    col = F.col(year)
    in_train = col.between(*train)
    return df.filter(in_train | (col == test)).withColumn(
        "split", F.when(in_train, f"train_{train[0]}_{train[1]}").otherwise(f"test_{test}")
    )


def feature_columns(columns: Iterable[str], excluded: Iterable[str]) -> list[str]:
    """The columns a model may see: all but identifiers, targets and future values."""
    drop = set(excluded)
    return [c for c in columns if c not in drop]


def split_summary(df: DataFrame, keys: Sequence[str], entity: str, target: str) -> DataFrame:
    """Rows, entities and the target's spread per split and year."""
    totals = df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(entity).alias("n_entities"),
        F.min(target).alias("target_min"),
        F.avg(target).alias("target_mean"),
        F.max(target).alias("target_max"),
    )
    return match_nulls(totals, exact_quantiles(df, keys, target, {"target_median": 0.5}), keys)


def fold_summary(df: DataFrame, entity: str, year: str, validation_years: Sequence[int]) -> DataFrame:
    """Per validation year v: the rows and entities before v, and those in v.

    'Before v' is a less-than condition against a short literal list, so it becomes
    conditional counts per entity instead of a join: one exchange of one partially
    aggregated row per entity, and distinct entities need no distinct aggregate.
    """
    y = F.col(year)
    per_entity, per_fold = [], []
    for fold, v in enumerate(validation_years, start=1):
        before = f"_before_{v}"
        inside = f"_in_{v}"
        per_entity += [
            F.count_if(y < v).alias(before),
            F.count_if(y == v).alias(inside),
            F.min(F.when(y < v, y)).alias(f"_min_{v}"),
            F.max(F.when(y < v, y)).alias(f"_max_{v}"),
        ]
        per_fold.append(
            F.struct(
                F.lit(fold).cast("long").alias("fold"),
                F.lit(v).cast("long").alias("validation_year"),
                F.min(f"_min_{v}").cast("long").alias("train_year_min"),
                F.max(f"_max_{v}").cast("long").alias("train_year_max"),
                F.coalesce(F.sum(before), F.lit(0)).alias("train_rows"),
                F.count_if((F.col(before) > 0) & F.col(entity).isNotNull()).alias("train_entities"),
                F.coalesce(F.sum(inside), F.lit(0)).alias("validation_rows"),
                F.count_if((F.col(inside) > 0) & F.col(entity).isNotNull()).alias("validation_entities"),
            )
        )
    return df.groupBy(entity).agg(*per_entity).agg(F.array(*per_fold).alias("_folds")).select(F.inline("_folds"))
