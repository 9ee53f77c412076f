"""Linear and tree regressors, coefficients and permutation importance."""

from __future__ import annotations

import random
from collections.abc import Sequence
from math import gcd
from typing import Any

from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.models.preprocessing import FEATURES, Preprocessor
from panelloom.operators.ordering import running_weight
from panelloom.operators.rowsets import union_same
from panelloom.session import materialize


def fit_ridge(encoded: DataFrame, label: str, alpha: float, solver: str = "normal") -> LinearRegressionModel:
    """Least squares with penalty ``alpha * |w|^2`` and a free intercept; ``alpha=0`` is plain OLS.

    MLlib divides the loss by the row count and scales the label, so the penalty is
    expressed in those units; the two solvers scale by different label deviations. The
    tight tolerance is for the iterative solver, which also steps in when a column is
    constant. ``solver`` is ``normal``, which keeps a matrix of the encoded columns on the
    driver and takes at most 4096 of them, or ``l-bfgs``; both give the same fit.
    """
    normal = solver == "normal"
    spread = F.stddev_pop(label) if normal else F.stddev_samp(label)
    n, sd = encoded.agg(F.count(label), spread).first()
    return LinearRegression(
        featuresCol=FEATURES, labelCol=label, elasticNetParam=0.0, standardization=False,
        solver=solver, regParam=alpha / n * (sd or 1.0),
        tol=1e-12, maxIter=1000,
    ).fit(encoded)


def fit_forest(encoded: DataFrame, label: str, seed: int = 0, **options: Any):
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **options).fit(encoded)


def fit_boosted(encoded: DataFrame, label: str, seed: int = 0, **options: Any):
    return GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **options).fit(encoded)


def coefficient_rollup(models: dict[str, tuple[LinearRegressionModel, Preprocessor]], df: DataFrame) -> DataFrame:
    """Largest and summed |coefficient| per model and source column, with the number of terms.

    Terms are rows of a table; a term's coefficient is the model's answer to its unit vector, less the intercept.
    """
    parts = []
    for name, (model, pre) in models.items():
        units = pre.unit_vectors(df.sparkSession)
        weight = F.abs(F.col("prediction") - F.lit(float(model.intercept)))
        parts.append(model.transform(units).select(F.lit(name).alias("model"), "feature", weight.alias("_w")))
    return union_same(*parts).groupBy("model", "feature").agg(
        F.max("_w").alias("max_abs_coefficient"),
        F.sum("_w").alias("sum_abs_coefficient"),
        F.count("*").alias("coefficient_terms"),
    )


def number_all(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Dense 0-based row numbers, without a single-task window."""
    numbered = running_weight(df.withColumn("_one", F.lit(1)), [], [F.col(c) for c in order], "_one")
    return numbered.withColumnsRenamed({"below": "_at", "total": "_rows"}).drop("_one")


def affine_draws(repeats: int, seed: int = 0) -> list[tuple[int, int]]:
    """Per repeat, the multiplier and the offset of a permutation as parts of ``2**20``."""
    rng = random.Random(seed)
    return [(rng.randrange(1 << 18, 3 << 18), rng.randrange(1 << 20)) for _ in range(repeats)]


def affine_permutation(n: int, draw: tuple[int, int]) -> tuple[int, int]:
    """``(a, b)`` such that ``(a * i + b) mod n`` permutes ``0 .. n - 1`` and fits a long."""
    top = min(n, (1 << 61) // max(n, 1))
    a = 1 + (top * draw[0] >> 20)
    while gcd(a, n) > 1:
        a += 1
    return a, n * draw[1] >> 20


def permutation_importance(
    model: Any, pre: Preprocessor, rows: DataFrame, label: str, order: Sequence[str],
    repeats: int = 5, seed: int = 0,
) -> DataFrame:
    """Mean and deviation of the rise in absolute error when one source column is permuted.

    Rows are numbered once, by ``order``. In every repeat row ``i`` takes its values from row ``(a * i + b) mod n``,
    so all columns share one equi-join and nothing is sorted again; the row is then scored once per column with that
    column taken from the donor. No rows give no importance.
    """
    sources = pre.sources
    numbered = number_all(pre.filled(rows).select(label, *order, *sources), order).drop("_rows")
    base = materialize(numbered, "numbered")
    n = base.count()  # of a stored table: its footers
    donors = base.select(F.col("_at").alias("_from"), *[F.col(c).alias(f"_donor_{c}") for c in sources])
    scored = []
    for r, draw in enumerate(affine_draws(repeats, seed)):
        a, b = affine_permutation(n, draw)
        donor = (F.col("_at") * F.lit(a) + F.lit(b)) % F.lit(max(n, 1))
        paired = base.withColumn("_from", donor).join(donors, "_from").drop("_from")
        which = F.explode(F.array(*[F.lit(i) for i in range(len(sources) + 1)])).alias("_which")
        variants = paired.select("*", which)
        swapped = variants.withColumns(
            {
                c: F.when(F.col("_which") == i, F.col(f"_donor_{c}")).otherwise(F.col(c))
                for i, c in enumerate(sources)
            }
        )
        encoded = pre.encode(swapped.select(label, "_which", *sources))
        error = F.abs(F.col(label) - F.col("prediction"))
        scored.append(
            model.transform(encoded)
            .groupBy("_which")
            .agg(F.avg(error).alias("mae"))
            .withColumn("repeat", F.lit(r))
        )
    errors = scored[0]
    for part in scored[1:]:
        errors = errors.unionByName(part)
    errors = materialize(errors, "permuted")  # (columns + 1) x repeats rows
    plain = errors.filter(F.col("_which") == len(sources)).select("repeat", F.col("mae").alias("_plain"))
    names = F.array(*[F.lit(c) for c in sources])
    return (
        errors.filter(F.col("_which") < len(sources))
        .join(plain, "repeat")
        .withColumn("feature", names[F.col("_which")])
        .groupBy("feature")
        .agg(
            F.avg(F.col("mae") - F.col("_plain")).alias("importance_mean_log_mae"),
            F.stddev_pop(F.col("mae") - F.col("_plain")).alias("importance_std_log_mae"),
        )
    )
