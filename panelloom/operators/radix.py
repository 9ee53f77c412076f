"""Exact quantiles by radix selection: no sort, no range partitioning, no sketch.

A double is turned into a whole number of the same order. Rows are counted by its leading bits; only the bins that
hold a wanted position are looked at again, at their next bits, until the bins are single values. Counting is a hash
aggregate, combined in the tasks, so two scans of the data send only histograms and the distinct values of the few
bins chosen first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.operators.joins import match_nulls
from panelloom.session import materialize

#: Bits below each digit. The first digit is sign, exponent and 8 bits of the fraction: 256 bins per power of two.
SHIFTS = (44, 29, 14, 0)
_FRACTION, _BIAS = 52, 1023


def ordered_bits(value: Column) -> Column:
    """A long that orders like the double ``value``; equal for both zeros, largest for NaN, NULL for NULL."""
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")
    two = lambda n: F.pow(F.lit(2.0), n)
    exponent = F.when(two(guess) > size, guess - 1).when(two(guess + 1) <= size, guess + 1).otherwise(guess)  # the log may be off by a bit
    fraction = ((size / two(exponent) - 1.0) * F.lit(2.0**_FRACTION)).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size < F.lit(2.0**-1022), (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .when(size == F.lit(float("inf")), F.lit(2047 << _FRACTION))
        .otherwise((exponent + _BIAS).cast("long") * F.lit(1 << _FRACTION) + fraction)
    )
    return F.when(F.isnan(value), F.lit((2047 << _FRACTION) + 1)).when(value < 0, -bits).when(value.isNotNull(), bits)


def from_ordered_bits(key: Column) -> Column:
    """The double whose :func:`ordered_bits` are ``key``."""
    bits = F.abs(key)
    exponent, fraction = F.shiftright(bits, _FRACTION).cast("int"), bits.bitwiseAND(F.lit((1 << _FRACTION) - 1))
    size = (
        F.when(exponent == 0, fraction.cast("double") * F.lit(2.0**-1074))
        .when(exponent == 2047, F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
        .otherwise((fraction + F.lit(1 << _FRACTION)).cast("double") * F.pow(F.lit(2.0), exponent - _BIAS - _FRACTION))
    )
    return F.when(key < 0, -size).otherwise(size)


def _positions(quantiles: Mapping[str, float]) -> list[tuple[Column, Column]]:
    """The two places, from 0, between which each quantile lies."""
    at = [F.lit(float(q)) * (F.col("_total") - 1) for q in quantiles.values()]
    return [(F.floor(a), F.ceil(a)) for a in at]


def _chosen(counted: DataFrame, parent: Sequence[str], quantiles: Mapping[str, float], base: str | None) -> DataFrame:
    """Of ``counted`` (parent keys, ``_bin``, ``n``) the bins that hold a wanted position, with what lies ``_below`` them.

    A parent has at most as many bins as a digit has values, and they are counts.
    """
    along = Window.partitionBy(*parent).orderBy("_bin")
    inside = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy(*parent)) if base is None else F.col("_total")
    placed = counted.withColumns({"_below": inside if base is None else F.col(base) + inside, "_total": total})
    ends = [p for pair in _positions(quantiles) for p in pair]
    return placed.filter(reduce(or_, [(p >= F.col("_below")) & (p < F.col("_below") + F.col("n")) for p in ends]))


def _interpolate(lo: Column, hi: Column, q: float, total: Column) -> Column:
    at = F.lit(float(q)) * (total - 1)
    return lo + (hi - lo) * (at - F.floor(at))


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per entry of ``quantiles``.

    NULL values do not count, and a group of them alone has no row; a NULL group is a group. Groups may be of any
    size and any number: a hot one is a histogram when it leaves the tasks. ``df`` is read twice.
    """
    group = list(group)
    if not group:
        return exact_quantiles(df.withColumn("_everything", F.lit(0)), ["_everything"], value, quantiles).drop("_everything")
    known = df.select(*group, ordered_bits(F.col(value).cast("double")).alias("_key")).filter(F.col("_key").isNotNull())
    prefix = lambda shift: F.shiftright("_key", shift)
    first = known.groupBy(*group, prefix(SHIFTS[0]).alias("_bin")).agg(F.count("*").alias("n"))
    chosen = materialize(_chosen(first, group, quantiles, None).drop("n"), "bins")
    keyed = known.withColumn("_bin", prefix(SHIFTS[0]))
    bins = chosen.select(*group, "_bin", F.lit(True).alias("_in"))
    cells = match_nulls(keyed, bins, [*group, "_bin"]).filter("_in").groupBy(*group, "_bin", "_key").agg(F.count("*").alias("n"))
    cells = materialize(cells, "cells")
    parent = [*group, "_bin"]
    for before, shift in zip(SHIFTS, SHIFTS[1:], strict=False):
        inside = match_nulls(cells.withColumn("_bin", prefix(before)), chosen, parent).filter(F.col("_below").isNotNull())
        counted = inside.groupBy(*group, F.col("_bin").alias("_up"), "_below", "_total", prefix(shift).alias("_bin")).agg(F.sum("n").alias("n"))
        last = _chosen(counted.withColumnRenamed("_below", "_base"), [*group, "_up"], quantiles, "_base")
        chosen = last.select(*parent, "_below", "_total", *(["n"] if shift == 0 else []))
    found = F.col("_bin")
    hit = lambda p: F.max(F.when((p >= F.col("_below")) & (p < F.col("_below") + F.col("n")), found))
    picks = [hit(p).alias(f"_{side}_{i}") for i, pair in enumerate(_positions(quantiles)) for side, p in zip(("lo", "hi"), pair, strict=True)]
    picked = chosen.groupBy(*group).agg(F.max("_total").alias("_total"), *picks)
    value_of = lambda name: from_ordered_bits(F.col(name))
    return picked.select(
        *group,
        *[_interpolate(value_of(f"_lo_{i}"), value_of(f"_hi_{i}"), q, F.col("_total")).alias(n) for i, (n, q) in enumerate(quantiles.items())],
    )
