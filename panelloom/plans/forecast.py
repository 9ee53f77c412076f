"""Fit on the training rows, forecast the holdout, report errors per model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import grow
from panelloom.models.preprocessing import Preprocessor, fit_preprocessor
from panelloom.models.regressors import fit_boosted, fit_forest, fit_ridge
from panelloom.operators.evaluation import (
    add_relative_errors,
    error_summary,
    no_change_baseline,
    regression_metrics,
    update_metrics,
)
from panelloom.operators.rowsets import union_same
from panelloom.session import materialize

# Fixed value: penalty of the published ridge model.
RIDGE_ALPHA = 13.433993325989016

Fit = Callable[[DataFrame, str, int], Any]


def ridge(alpha: float = RIDGE_ALPHA) -> Fit:
    return lambda encoded, label, width: fit_ridge(encoded, label, alpha)


def forest(**options: Any) -> Fit:
    return lambda encoded, label, width: fit_forest(encoded, label, **options)


def boosted(**options: Any) -> Fit:
    return lambda encoded, label, width: fit_boosted(encoded, label, **options)


@dataclass(frozen=True)
class Target:
    """Column names of a growth forecast: the model predicts ``log_change`` from ``current``."""

    log_change: str
    current: str
    actual: str
    predicted: str = "pred_next_year_median_sale_price"


def fit_and_score(
    train: DataFrame, test: DataFrame, fits: Mapping[str, Fit], target: Target,
    numeric: Sequence[str], boolean: Sequence[str] = (), categorical: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, Any], Preprocessor]:
    """Predictions of every model (and of 'no change') on the test rows, the models, the encoder.

    The encoded training rows are written once and read by every fit.
    """
    pre = fit_preprocessor(train, numeric, boolean, categorical)
    width = pre.width
    encoded = materialize(
        pre.transform(train.filter(F.col(target.log_change).isNotNull())).select(target.log_change, "features"),
        "encoded",
    )
    holdout = pre.transform(test)
    models, parts = {}, [
        no_change_baseline(test, target.current, target.predicted).withColumn("_log", F.lit(0.0))
    ]
    for name, fit in fits.items():
        models[name] = fit(encoded, target.log_change, width)
        scored = models[name].transform(holdout).withColumnRenamed("prediction", "_log").drop("features")
        parts.append(
            scored.withColumn("model", F.lit(name)).withColumn(
                target.predicted, grow(F.col(target.current), F.col("_log"))
            )
        )
    predictions = union_same(*parts).withColumnRenamed("_log", "pred_log_change")
    return predictions, models, pre


def evaluate_holdout(predictions: DataFrame, target: Target) -> DataFrame:
    """One row per model: fit metrics and relative-error summary."""
    errors = materialize(add_relative_errors(predictions, target.actual, target.predicted), "errors")
    fit = regression_metrics(errors, ["model"], target.current, target.actual, target.predicted)
    return update_metrics(fit, error_summary(errors), unique=True)  # both are grouped by model
