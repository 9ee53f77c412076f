"""Relative errors, error summaries and fit metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import finite, number_of, positive
from panelloom.operators.joins import join_one_to_one
from panelloom.operators.radix import exact_quantiles
from panelloom.session import materialize
from panelloom.operators.rowsets import union_missing

# Column names of the consolidated error table, in output order.
SUMMARY_COLUMNS = [
    "rows", "mean_error_pct", "mape_pct", "median_ape_pct", "rmse_pct", "p90_ape_pct", "max_ape_pct",
]
METADATA_COLUMNS = ["model", "train_years", "test_year", "target_year", "ridge_alpha"]
FIT_COLUMNS = [
    "mae_dollars", "rmse_dollars", "r2_dollars",
    "mae_log_change", "rmse_log_change", "r2_log_change",
    "mae_growth_pct_points", "rmse_growth_pct_points", "r2_growth_pct",
]


def add_relative_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Signed and absolute error relative to the actual value, as ratio and in percent."""
    real, guess = number_of(df, actual), number_of(df, predicted)
    return (
        df.withColumn("relative_error", (guess - real) / positive(real))
        .withColumn("absolute_relative_error", F.abs("relative_error"))
        .withColumn("percentage_error", F.col("relative_error") * 100.0)
        .withColumn("absolute_percentage_error", F.col("absolute_relative_error") * 100.0)
    )


def error_summary(df: DataFrame, model: str = "model") -> DataFrame:
    """Percent error metrics per model over the rows with a finite relative error.

    The few groups are huge, so the median and the 90th percentile come from histograms,
    never from one group's buffer. The errors are written once, as three passes read them.
    """
    signed, size = F.col("_signed"), F.col("_size")
    valid = df.select(
        model, finite(F.col("relative_error")).alias("_signed"),
        finite(F.col("absolute_relative_error")).alias("_size"),
    ).filter(signed.isNotNull() & size.isNotNull())
    valid = materialize(valid, "errors")
    totals = valid.groupBy(model).agg(
        F.count("*").cast("double").alias("rows"),
        (F.avg(signed) * 100.0).alias("mean_error_pct"),
        (F.avg(size) * 100.0).alias("mape_pct"),
        (F.sqrt(F.avg(signed * signed)) * 100.0).alias("rmse_pct"),
        (F.max(size) * 100.0).alias("max_ape_pct"),
    )
    order = exact_quantiles(valid, [model], "_size", {"_p50": 0.5, "_p90": 0.9})
    return (
        totals.join(order, model, "left")
        .withColumn("median_ape_pct", F.col("_p50") * 100.0)
        .withColumn("p90_ape_pct", F.col("_p90") * 100.0)
        .select(model, *SUMMARY_COLUMNS)
    )


def update_metrics(
    metrics: DataFrame, summary: DataFrame, label: str | None = None, unique: bool = False
) -> DataFrame:
    """Replace the error columns of a per-model metrics table by those of ``summary``."""
    kept = metrics.drop(*SUMMARY_COLUMNS)
    if "model" not in kept.columns:
        if label is None:
            raise ValueError("metrics without a model column need a label")
        kept = kept.withColumn("model", F.lit(label))
    return join_one_to_one(kept, summary, ["model"], unique)


def consolidate(tables: Sequence[tuple[DataFrame, Sequence[str] | None]]) -> DataFrame:
    """Stack metrics tables in one column order; each may keep only the listed models."""
    order = [*METADATA_COLUMNS, *FIT_COLUMNS, *SUMMARY_COLUMNS]
    parts = []
    for table, models in tables:
        if models is not None and "model" in table.columns:
            table = table.filter(F.col("model").isin(list(models)))
        parts.append(table.select(*[c for c in order if c in table.columns]))
    stacked = union_missing(*parts)
    return stacked.select(*[c for c in order if c in stacked.columns])


def fit_metrics(actual: Column, predicted: Column, mae: str, rmse: str, r2: str) -> list[Column]:
    """MAE, RMSE and R2 over the rows where both values are known."""
    both = actual.isNotNull() & predicted.isNotNull()
    y, miss = F.when(both, actual), actual - predicted
    return [
        F.avg(F.abs(miss)).alias(mae),
        F.sqrt(F.avg(miss * miss)).alias(rmse),
        (1.0 - F.try_divide(F.sum(miss * miss), F.regr_syy(y, y))).alias(r2),
    ]


def regression_metrics(
    df: DataFrame, group: Sequence[str], current: str, actual: str, predicted: str
) -> DataFrame:
    """Fit metrics on the level, the log change and the growth in percent points."""
    now, y, p = (positive(F.col(c)) for c in (current, actual, predicted))
    return df.groupBy(*group).agg(
        *fit_metrics(F.col(actual), F.col(predicted), *FIT_COLUMNS[0:3]),
        *fit_metrics(F.ln(y / now), F.ln(p / now), *FIT_COLUMNS[3:6]),
        *fit_metrics((y / now - 1.0) * 100.0, (p / now - 1.0) * 100.0, *FIT_COLUMNS[6:9]),
    )


def no_change_baseline(df: DataFrame, current: str, predicted: str) -> DataFrame:
    """The forecast every model must beat: next period equals this one."""
    return df.withColumn("model", F.lit("no_change")).withColumn(predicted, F.col(current))
