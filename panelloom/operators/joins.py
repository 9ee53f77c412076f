"""Key filters, validated joins, presence flags and the next-period lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.scalars import known
from panelloom.operators.quality import require_unique
from panelloom.session import materialize


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def match_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` in which a NULL key matches a NULL key."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, on, "left").drop(*[f"_r_{k}" for k in keys])


def key_filter(df: DataFrame, valid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the rows whose key occurs in ``valid``.

    The distinct keys are written once: if they are small the join broadcasts them, if not
    both sides are plain scans, which lets adaptive execution split a hot key.
    """
    return df.join(materialize(valid.select(*keys).distinct(), "valid-keys"), list(keys), "left_semi")


def checked_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with a check inside the plan that fails the job on a repeated key.

    The grouping partitions by ``keys``, which is what a following join on them needs, so
    the check adds no exchange. Fixed-width columns keep it a hash aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    text = F.concat(F.lit("duplicate join key: "), F.to_json(F.struct(*keys)))
    ok = F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    counted = df.groupBy(*keys)
    if all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in rest):
        row = counted.agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in rest])
        return row.filter(ok).drop("_n")
    row = counted.agg(F.count("*").alias("_n"), F.any_value(F.struct(*rest)).alias("_row"))
    return row.filter(ok).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def join_many_to_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = False, store: bool = True
) -> DataFrame:
    """Left join that fails when a key repeats on the right.

    ``unique=True`` skips the check for a right side that is a ``groupBy`` on ``keys``.
    The right side is written first, so its real size decides between a broadcast and a
    sort-merge join, and a hot left key can be split (adaptive execution does not split a
    join whose input is an aggregate). ``store=False`` is for a left side with one row per
    key, which cannot be hot, or a right side that is a table already.
    """
    right = right if unique else checked_unique(right.dropna(subset=list(keys)), keys)
    return left.join(materialize(right, "lookup") if store else right, list(keys), "left")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Left join that fails when a key repeats on either side."""
    if not unique:
        require_unique(left, keys)
    return join_many_to_one(left, right, keys, unique, store=False)


def attach_features(
    base: DataFrame, features: DataFrame | None, label: str, keys: Sequence[str], store: bool = True
) -> DataFrame:
    """Left-join a feature table and flag the rows that received any value.

    A missing table leaves only the flag, set to False.
    """
    flag = f"has_{label}"
    if features is None:
        return base.withColumn(flag, F.lit(False))
    new = [c for c in features.columns if c not in keys]
    clash = sorted(set(new) & set(base.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    joined = join_many_to_one(base, features, keys, store=store)
    present = reduce(or_, [F.col(c).isNotNull() for c in new]) if new else F.lit(False)
    return joined.withColumn(flag, present)


def assemble_panel(
    base: DataFrame, sources: Mapping[str, DataFrame | None], keys: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Left-join every source on the panel key, one presence flag each.

    ``base`` has one row per key. All joins share the key, so it is exchanged once at most
    and each source is checked in the exchange that its join needs anyway.
    """
    for label, features in sources.items():
        base = attach_features(base, features, label, keys, store=False)
        if prefix:
            base = base.withColumnRenamed(f"has_{label}", f"{prefix}has_{label}")
    return base


def observed_flag(df: DataFrame, flag: str) -> DataFrame:
    """Turn a flag that a left join left NULL into False."""
    return df.withColumn(flag, known(F.col(flag)))


def next_period(df: DataFrame, entity: str, period: str, columns: Mapping[str, str]) -> DataFrame:
    """Add values of period + 1 of the same entity; NULL where that period is absent.

    (entity, period) must be unique, which bounds a window by the number of periods.
    """
    following = Window.partitionBy(entity).orderBy(period).rangeBetween(1, 1)
    return df.withColumns({name: F.max(F.col(c)).over(following) for c, name in columns.items()})


def at_most_max_less_one(df: DataFrame, period: str, source: DataFrame) -> DataFrame:
    """Keep the periods before the last one found in ``source`` (a one-row subquery)."""
    last = source.agg(F.max(period)).scalar()
    return df.filter(F.col(period) <= last - 1)


def expand_periods(df: DataFrame, periods: Sequence[int], name: str) -> DataFrame:
    """One copy of every row per period of a known, short list."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(int(p)) for p in periods])))


def in_periods(df: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """One copy of every row per period found in ``source``: a one-row subquery of a few periods, no join."""
    return df.withColumn(name, F.explode(source.agg(F.sort_array(F.collect_set(name))).scalar()))
