"""Casts, null rules, guarded arithmetic and flags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a table reader treats as a missing entry.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The cast also reads Java literals such as 1.5d and 2f, which are no numbers in a data file.
_JAVA_LITERAL = r"[0-9.][dDfF]\s*$"

# -- casts ---------------------------------------------------------------------------------


def missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(MISSING_TEXTS), col)


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def number_or_null(col: Column) -> Column:
    """Text to double; text that is no number becomes NULL, as does NaN."""
    text = col.cast("string")
    return F.when(~text.rlike(_JAVA_LITERAL), nan_to_null(text.try_cast("double")))


def number_of(df: DataFrame, name: str) -> Column:
    """:func:`number_or_null` for a column of ``df``; numeric columns skip the text test."""
    col = F.col(name)
    return nan_to_null(col) if isinstance(df.schema[name].dataType, T.NumericType) else number_or_null(col)


def int_or_null(col: Column) -> Column:
    """Text to int; anything but a whole number becomes NULL."""
    value = number_or_null(col)
    return F.when(value == F.floor(value), value.try_cast("int"))


def strict_number(col: Column) -> Column:
    """Text to double; bad text fails the job."""
    return nan_to_null(col.cast("double"))


def strict_int(col: Column, name: str = "value") -> Column:
    """Text to int; bad or missing text fails the job."""
    return F.when(
        col.isNull(), F.raise_error(F.lit(f"missing {name} where an integer is required")).cast("int")
    ).otherwise(col.cast("double").cast("int"))


def month_of(col: Column) -> Column:
    """Month of a timestamp text; unparseable text becomes NULL."""
    return F.month(F.try_to_timestamp(col))


def flag_number(col: Column, dtype: str) -> Column:
    """1.0 for a true value, 0.0 for everything else, by the column's own type."""
    if dtype == "boolean":
        hit = col
    elif dtype == "string":
        hit = col.isin("True", "true")
    else:
        hit = col == 1
    return F.when(known(hit), 1.0).otherwise(0.0)


# -- null rules ----------------------------------------------------------------------------


def sentinels_to_null(col: Column, sentinels: Iterable[float]) -> Column:
    return F.when(~col.isin(list(sentinels)), col)


def fill_from_difference(part: Column, total: Column, other: Column) -> tuple[Column, Column]:
    """Fill a missing part with ``total - other``; also return the flag 'was derived'."""
    derived = total - other
    return F.coalesce(part, derived), part.isNull() & derived.isNotNull()


def non_negative(col: Column) -> Column:
    return F.when(col >= 0, col)


def positive(col: Column) -> Column:
    """The value where it is above zero, else NULL: a safe denominator."""
    return F.when(col > 0, col)


def finite(col: Column) -> Column:
    """NULL for infinities and NaN."""
    value = nan_to_null(col)
    return F.when(F.abs(value) != float("inf"), value)


# -- arithmetic ----------------------------------------------------------------------------


def safe_divide(num: Column, den: Column) -> Column:
    """NULL when either side is NULL or the denominator is not above zero."""
    return num / positive(den)


def sum_any(cols: Sequence[Column]) -> Column:
    """Row sum over the non-NULL parts; NULL only when every part is NULL."""
    return F.when(reduce(or_, [c.isNotNull() for c in cols]), sum_zero(cols))


def sum_zero(cols: Sequence[Column]) -> Column:
    """Row sum that treats NULL parts as zero."""
    return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cols])


def log_positive(col: Column) -> Column:
    return F.ln(positive(col))


def log1p(col: Column) -> Column:
    return F.log1p(col)


def rate_per(count: Column, population: Column, per: float) -> Column:
    return count / positive(population) * F.lit(float(per))


def pct_growth(current: Column, following: Column) -> Column:
    return positive(following) / positive(current) - 1.0


def log_growth(current: Column, following: Column) -> Column:
    return log_positive(following) - log_positive(current)


def grow(level: Column, log_change: Column) -> Column:
    """Undo :func:`log_growth`: the level after a log change."""
    return level * F.exp(log_change)


def months_of_supply(stock: Column, yearly_flow: Column) -> Column:
    return stock / (positive(yearly_flow) / 12.0)


# -- flags and labels ----------------------------------------------------------------------


def known(predicate: Column) -> Column:
    """A predicate that is False where it would be NULL."""
    return F.coalesce(predicate, F.lit(False))


def not_in(col: Column, values: Iterable) -> Column:
    """Negated membership that is True on NULL."""
    return ~known(col.isin(list(values)))


def first_label(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """Label of the first rule that holds."""
    chain = F
    for predicate, label in rules:
        chain = chain.when(predicate, F.lit(label))
    return chain.otherwise(F.lit(default))
