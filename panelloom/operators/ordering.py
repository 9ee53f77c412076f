"""Exact order statistics inside groups of any size.

A window over a whole group runs in one task. Instead tables are cut into value ranges: rows are
range-partitioned by (group, value), every range counts its own weight, and a running sum
over the ranges gives each range its starting position. Quantiles need no order: see
:mod:`panelloom.operators.radix`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.operators.joins import match_nulls
from panelloom.operators.radix import SHIFTS, ordered_bits
from panelloom.session import materialize

_SLICE, _BASE, _INNER = "_slice", "_base", "_inner"


#: What one value range should hold, by the size Catalyst sees of the stored table.
RANGE_BYTES = 128 << 20
#: Distinct values that one task ranks; a bin of leading bits with more is cut at finer bits.
SLICE_VALUES = 1 << 20


def ranges_for(stored: DataFrame) -> int:
    """How many value ranges a stored table is cut into."""
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // RANGE_BYTES))


def _before(group: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def running_weight(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], weight: str,
    stored: bool = False, ranges: int | None = None,
) -> DataFrame:
    """Add ``below`` (weight of earlier rows of the group) and ``total`` (weight of the group).

    Rows equal on ``order`` share a range, so make the order total or aggregate equal rows
    into one weighted row beforehand. ``stored`` says that ``df`` is already a written table.
    ``ranges`` is how many value ranges to cut; left out, one per ``RANGE_BYTES`` of the table.
    """
    group = list(group)
    if not stored:
        df = materialize(df, "weights")
    ranges = ranges or ranges_for(df)
    none = F.lit(0).cast("long")
    # The range number is only meaningful for this one placement, so it is written down.
    placed = materialize(
        df.repartitionByRange(ranges, *[F.col(c) for c in group], *order).withColumn(_SLICE, F.spark_partition_id()),
        "ranges",
    )
    # Ranges are contiguous, so only a group cut by a range border lies in several of them:
    # at most two rows per range, whatever the number of groups and rows.
    whole = Window.partitionBy(*group)
    cut = (
        placed.groupBy(*group, _SLICE)
        .agg(F.sum(weight).alias("_w"))
        .select(
            *group,
            _SLICE,
            F.sum("_w").over(_before(group, [F.col(_SLICE)])).alias(_BASE),
            F.sum("_w").over(whole).alias("_group_weight"),
            F.count("*").over(whole).alias("_parts"),
        )
        .filter("_parts > 1")
        .drop("_parts")
    )
    own = [*group, _SLICE]
    counted = placed.withColumns(
        {
            _INNER: F.coalesce(F.sum(weight).over(_before(own, order)), none),
            "_own": F.sum(weight).over(Window.partitionBy(*own)),
        }
    )
    return (
        match_nulls(counted, materialize(cut, "cut-groups"), own)
        .withColumn("below", F.coalesce(F.col(_BASE), none) + F.col(_INNER))
        .withColumn("total", F.coalesce("_group_weight", "_own"))
        .drop(_SLICE, _BASE, _INNER, "_group_weight", "_own")
    )


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, **options) -> DataFrame:
    """1-based position of every row inside its group."""
    ranked = running_weight(df.withColumn("_one", F.lit(1)), group, order, "_one", **options)
    return ranked.withColumn(name, (F.col("below") + 1).cast("long")).drop("_one", "below", "total")


def value_shares(counts: DataFrame, group: Sequence[str], slice_values: int = SLICE_VALUES) -> DataFrame:
    """Average rank over the number of rows, for each value of a stored table ``(group, _key, n)``.

    Values are dealt into slices by their leading bits, finer where a bin holds more than ``slice_values``. The
    slices are few enough to be summed along a group; ranks inside a slice are one task's.
    """
    coarse, fine = SHIFTS[0], SHIFTS[1]
    bins = counts.groupBy(*group, F.shiftright("_key", coarse).alias("_bin")).agg(F.count("*").alias("_values"))
    crowded = bins.filter(F.col("_values") > slice_values).select(*group, "_bin", F.lit(True).alias("_fine"))
    placed = match_nulls(counts.withColumn("_bin", F.shiftright("_key", coarse)), crowded, [*group, "_bin"])
    low = F.when(F.col("_fine"), F.shiftright("_key", fine)).otherwise(F.shiftright("_key", coarse) * (1 << (coarse - fine)))
    sliced = placed.withColumn(_SLICE, low)
    sums = sliced.groupBy(*group, _SLICE).agg(F.sum("n").alias("_w"))
    offsets = sums.select(
        *group, _SLICE, F.coalesce(F.sum("_w").over(_before(group, [F.col(_SLICE)])), F.lit(0)).alias(_BASE),
        F.sum("_w").over(Window.partitionBy(*group)).alias("_total"),
    )
    inside = F.coalesce(F.sum("n").over(_before([*group, _SLICE], [F.col("_key")])), F.lit(0))
    met = match_nulls(sliced.withColumn(_INNER, inside), offsets, [*group, _SLICE])
    share = (F.col(_BASE) + F.col(_INNER) + (F.col("n") + 1) / 2) / F.col("_total")
    return met.select(*group, "_key", share.alias("_share"))


def _met_by_key(rows: DataFrame, shares: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` and ``_key``. Rows without a value match nothing and are spread, not gathered."""
    spread = F.lit(-(1 << 63)) + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 40))  # below the bits of any double
    return match_nulls(rows.withColumn("_key", F.coalesce("_key", spread)), shares, [*keys, "_key"])


def percent_rank_average(df: DataFrame, group: Sequence[str], columns: Mapping[str, str], slice_values: int = SLICE_VALUES) -> DataFrame:
    """Average rank divided by the count of known values, per group; NULL stays NULL.

    Only distinct values are ranked, those of all columns in one pass. One column's ranks meet the rows by an
    equi-join. With several, rows get a number and are stored, the ranks meet narrow (number, value) rows, are
    gathered by number and meet the rows together: the rows themselves are moved once, however many columns.
    """
    group, names = list(group), list(columns.values())
    bits = {name: ordered_bits(F.col(value).cast("double")) for value, name in columns.items()}
    if len(columns) == 1:
        rows = df.withColumn("_key", bits[names[0]])
        counts = rows.filter("_key IS NOT NULL").groupBy(*group, "_key").agg(F.count("*").alias("n"))
        shares = materialize(value_shares(materialize(counts, "values"), group, slice_values), "shares")
        return _met_by_key(rows, shares, group).withColumnRenamed("_share", names[0]).drop("_key")
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    long = rows.select(*group, "_row", *[bits[name].alias(f"_{i}") for i, name in enumerate(names)])
    long = long.unpivot([*group, "_row"], [f"_{i}" for i in range(len(names))], "_column", "_key").filter("_key IS NOT NULL")
    keys = [*group, "_column"]
    counts = long.groupBy(*keys, "_key").agg(F.count("*").alias("n"))
    shares = materialize(value_shares(materialize(counts, "values"), keys, slice_values), "shares")
    met = match_nulls(long, shares, [*keys, "_key"])
    each = [F.max(F.when(F.col("_column") == f"_{i}", F.col("_share"))).alias(name) for i, name in enumerate(names)]
    gathered = materialize(met.groupBy("_row").agg(*each), "ranks-by-row")
    return rows.join(gathered, "_row", "left").drop("_row")
