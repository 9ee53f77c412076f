"""Per-column profiles and the pairwise correlation audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.scalars import nan_to_null
from panelloom.operators.comoments import pair_correlations

# Texts of a column that holds only yes/no entries.
BOOLEAN_TEXTS = ["true", "false", "0", "1"]


def feature_kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    return "numeric" if isinstance(dtype, T.NumericType) else "categorical"


def _as_text(name: str, dtype: T.DataType) -> Column:
    col = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # NaN counts as missing and -0.0 as 0.0.
        return (nan_to_null(col) + F.lit(0.0)).cast("string").alias(name)
    return col.cast("string").alias(name)


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: kind, missing rate, exact distinct count and whether it is yes/no.

    Columns are unpivoted to (feature, value), so that distinct values are removed in the
    map tasks and spread by (feature, value) whatever the column.
    """
    types = {c: df.schema[c].dataType for c in columns}
    kinds = {k: [c for c in columns if feature_kind(types[c]) == k] for k in ("boolean", "numeric")}
    feature = F.col("feature")
    yes_no = F.lower(F.trim("value")).isin(BOOLEAN_TEXTS)
    return (
        df.select(*[_as_text(c, types[c]) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .groupBy("feature")
        .agg(
            F.count("*").alias("n_rows"),
            (F.count_if(F.col("value").isNull()) / F.count("*")).alias("missing_rate"),
            F.count_distinct("value").alias("n_unique"),
            F.coalesce(F.bool_and(yes_no), F.lit(False)).alias("is_yes_no"),
        )
        .withColumn(
            "feature_kind",
            F.when(feature.isin(kinds["boolean"]), "boolean")
            .when(feature.isin(kinds["numeric"]), "numeric")
            .otherwise("categorical"),
        )
        .withColumn(
            "preprocessing_kind", F.when(F.col("is_yes_no"), "boolean").otherwise(F.col("feature_kind"))
        )
        .drop("is_yes_no")
    )


def _numeric_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if feature_kind(df.schema[c].dataType) != "categorical"]


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """|Pearson| of every numeric column pair over the rows where both are known.

    A pair with a constant side has a NULL correlation. All pairs take a single scan; see
    :mod:`panelloom.operators.comoments`.
    """
    names = _numeric_columns(df, columns)
    if len(names) < 2:
        return df.sparkSession.createDataFrame(
            [], "left_feature string, right_feature string, abs_correlation double"
        )
    data = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in names])
    label = F.array(*[F.lit(c) for c in names])
    return pair_correlations(data, names).select(
        label[F.col("i")].alias("left_feature"),
        label[F.col("j")].alias("right_feature"),
        F.abs("correlation").alias("abs_correlation"),
    )


def correlation_audit(df: DataFrame, columns: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Column pairs that carry nearly the same signal, strongest first."""
    note = f"selected_numeric_pair_abs_corr_ge_{threshold}"
    return (
        correlation_pairs(df, columns)
        .filter(F.col("abs_correlation") >= threshold)
        .withColumn("audit_note", F.lit(note))
        .orderBy(F.desc("abs_correlation"), "left_feature", "right_feature")
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("features"))


def grouped_names(df: DataFrame, by: str, name: str = "feature", order: Sequence[str] = ()) -> DataFrame:
    """List of names per group of a profile, by the ``order`` columns, then by name."""
    keyed = F.sort_array(F.collect_list(F.struct(*order, F.col(name).alias("_name"))))
    return df.groupBy(by).agg(keyed.alias("_rows")).select(by, F.col("_rows._name").alias("features"))
