"""Preprocessing, model and evaluation queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.bindings.common import fixed, fx, table, whole
from panelloom.functions.scalars import known, log_growth
from panelloom.models.preprocessing import fit_preprocessor
from panelloom.models.regressors import affine_draws, coefficient_rollup, fit_ridge, permutation_importance
from panelloom.operators.evaluation import (
    SUMMARY_COLUMNS,
    add_relative_errors,
    consolidate,
    error_summary,
    regression_metrics,
    update_metrics,
)
from panelloom.operators.groups import with_group_values
from panelloom.operators.joins import next_period
from panelloom.operators.rowsets import best_and_worst, top_rows
from panelloom.plans.forecast import RIDGE_ALPHA, Target, boosted, evaluate_holdout, fit_and_score, forest, ridge
from panelloom.session import materialize

# -- errors of two simple forecasts of an order's value ------------------------------------


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two forecasts per order: the mean of its customer and of its priority."""
    orders = table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    actual = F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).when(
        F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")
    )
    both = with_group_values(orders, ["o_custkey"], {"by_customer": F.avg("o_totalprice")})
    both = with_group_values(both, ["o_orderpriority"], {"by_priority": F.avg("o_totalprice")})
    # Both models in one pass over the joined orders.
    forecasts = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in ("by_customer", "by_priority")]
    )
    return both.select(
        "o_orderkey", (F.col("o_totalprice") / 2 + 50_000.0).alias("current"), actual.alias("actual"), F.inline(forecasts)
    ).select("o_orderkey", "model", "current", "actual", "predicted")


def relative_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = add_relative_errors(predictions(spark, sf_dir), "actual", "predicted")
    return out.select(
        "o_orderkey", "model", "actual", fixed(F.col("predicted"), 2).alias("predicted"),
        *[
            fixed(F.col(c)).alias(c)
            for c in (
                "relative_error", "absolute_relative_error", "percentage_error", "absolute_percentage_error"
            )
        ],
    )


def error_summary_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = error_summary(add_relative_errors(predictions(spark, sf_dir), "actual", "predicted"))
    return out.select("model", *[fixed(F.col(c)).alias(c) for c in SUMMARY_COLUMNS])


def fit_metrics_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = regression_metrics(predictions(spark, sf_dir), ["model"], "current", "actual", "predicted")
    return out.select("model", *[fixed(F.col(c), 2 if "dollars" in c else 6).alias(c) for c in out.columns[1:]])


def consolidated_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(add_relative_errors(predictions(spark, sf_dir), "actual", "predicted"), "errors")
    summary = error_summary(rows)
    fit = regression_metrics(rows, ["model"], "current", "actual", "predicted")
    customer = fit.filter(F.col("model") == "by_customer").drop("model").withColumn("rows", F.lit(-1.0))
    priority = fit.withColumn("train_years", F.lit("1995-1999"))
    out = consolidate(
        [
            (update_metrics(customer, summary, label="by_customer"), None),
            (update_metrics(priority, summary), ["by_priority"]),
        ]
    )
    return out.select(
        "model", "train_years",
        *[fixed(F.col(c), 2 if "dollars" in c else 4).alias(c) for c in out.columns[2:]],
    )


def best_worst_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = add_relative_errors(predictions(spark, sf_dir), "actual", "predicted")
    out = best_and_worst(errors, "absolute_percentage_error", ["model", "o_orderkey"])
    return out.select(
        "example", "model", "o_orderkey", "actual", F.round("predicted", 1).alias("predicted"),
        fixed(F.col("absolute_percentage_error"), 3).alias("absolute_percentage_error"),
    )


# -- a growth forecast on part prices ------------------------------------------------------

TARGET = Target("log_change", "price", "next_price", "pred_price")
NUMERIC = ["quantity", "discount", "log_price"]
BOOLEAN = ["returned"]
CATEGORICAL = ["p_type"]
KINDS = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]  # of the parts, but the one that was blanked
FIRST, LAST, TEST_YEAR = 1996, 1999, 2000


def part_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly part prices with their next-year change; some figures are missing on purpose."""
    lines = table(
        spark, sf_dir, "lineitem", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag",
    )
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type")
    yearly = lines.groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.sum(F.when(F.col("l_discount") > 0.02, F.col("l_quantity"))).alias("quantity"),
        F.avg(F.nullif(F.col("l_discount"), F.lit(0.0))).alias("discount"),
        known(F.bool_or(F.col("l_returnflag") == "R")).alias("returned"),
    )
    panel = next_period(yearly, "l_partkey", "year", {"price": "next_price"})
    return (
        panel.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .drop("p_partkey")
        .withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
        .withColumn("log_price", F.ln("price"))
        .withColumn("log_change", log_growth(F.col("price"), F.col("next_price")))
        .filter(F.col("log_change").isNotNull())
    )


def _train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    panel = materialize(part_panel(spark, sf_dir), "part-panel")
    return panel.filter(F.col("year").between(FIRST, LAST)), panel.filter(F.col("year") == TEST_YEAR)


def preprocessing_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fit learned: medians, means and deviations, modes and category levels."""
    train, _ = _train_test(spark, sf_dir)
    pre = fit_preprocessor(train, NUMERIC, BOOLEAN, CATEGORICAL)
    rows = [(c, pre.medians.get(c), pre.means[c], pre.scales[c], None, None) for c in [*NUMERIC, *BOOLEAN]]
    rows += [(c, None, None, None, pre.modes[c], pre.sizes[c]) for c in CATEGORICAL]
    out = spark.createDataFrame(
        rows, "feature string, median double, mean double, scale double, mode string, n_levels long"
    )
    return out.select(
        "feature", *[fixed(F.col(c), 6).alias(c) for c in ("median", "mean", "scale")], "mode", "n_levels"
    )


def ridge_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge on one column, whose closed form SQL can state."""
    train, test = _train_test(spark, sf_dir)
    scored, _, _ = fit_and_score(train, test, {"ridge": ridge(25.0)}, TARGET, ["discount"])
    return scored.select(
        "l_partkey", whole(F.col("year")).alias("year"), "model",
        fixed(F.col("pred_log_change"), 6).alias("pred_log_change"), fixed(F.col("pred_price"), 3).alias("pred_price"),
    )


def no_change_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _train_test(spark, sf_dir)
    baseline = test.withColumn("model", F.lit("no_change")).withColumn("pred_price", F.col("price"))
    out = evaluate_holdout(baseline, TARGET)
    return out.select("model", *[fixed(F.col(c)).alias(c) for c in out.columns if c != "model"])


def _scored(spark: SparkSession, sf_dir: str, name: str, fit) -> DataFrame:
    train, test = _train_test(spark, sf_dir)
    scored, _, _ = fit_and_score(train, test, {name: fit}, TARGET, NUMERIC, BOOLEAN, CATEGORICAL)
    return evaluate_holdout(scored, TARGET)


def _linear(spark: SparkSession, sf_dir: str, name: str, fit) -> DataFrame:
    """The report of a linear fit, rounded so that two solvers agree."""
    out = _scored(spark, sf_dir, name, fit)
    return out.select("model", *[fixed(F.col(c), 2 if "dollars" in c else 4).alias(c) for c in out.columns if c != "model"])


def ridge_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linear(spark, sf_dir, "ridge_linear_regression", ridge())


def ols_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linear(spark, sf_dir, "ols_linear_regression", ridge(0.0))


def rf_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "random_forest", forest(numTrees=20, maxDepth=5))


def gbt_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "boosted_trees", boosted(maxIter=10, maxDepth=3))


def _ridge(spark: SparkSession, sf_dir: str, alpha: float = 10.0):
    train, test = _train_test(spark, sf_dir)
    pre = fit_preprocessor(train, NUMERIC, BOOLEAN, CATEGORICAL)
    encoded = materialize(pre.transform(train).select("log_change", "features"), "encoded")
    return pre, encoded, test, fit_ridge(encoded, "log_change", alpha)


def coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ridge's coefficients; without a penalty those of the levels are not determined, so plain least squares has none of them."""
    pre, encoded, _, model = _ridge(spark, sf_dir)
    train, _ = _train_test(spark, sf_dir)
    numbers = fit_preprocessor(train, NUMERIC, BOOLEAN)
    plain = fit_ridge(materialize(numbers.transform(train).select("log_change", "features"), "encoded"), "log_change", 0.0)
    out = coefficient_rollup({"ridge": (model, pre), "ols": (plain, numbers)}, encoded)
    return out.select(
        "model", "feature", *[fixed(F.col(c), 6).alias(c) for c in ("max_abs_coefficient", "sum_abs_coefficient")], "coefficient_terms"
    )


def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector of the test rows: scaled numbers, flags and one-hot slots."""
    train, test = _train_test(spark, sf_dir)
    pre = fit_preprocessor(train, NUMERIC, BOOLEAN, CATEGORICAL)
    slots = vector_to_array("features")
    out = pre.transform(test).select("l_partkey", whole(F.col("year")).alias("year"), slots.alias("_slots"))
    names = [*NUMERIC, *BOOLEAN, *[f"p_type_{k.lower()}" for k in KINDS]]
    return out.select("l_partkey", "year", *[fixed(F.col("_slots")[i]).alias(n) for i, n in enumerate(names)])


def one_feature_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of one-column OLS and ridge, whose closed form SQL can state."""
    train, _ = _train_test(spark, sf_dir)
    pre = fit_preprocessor(train, ["log_price"])
    encoded = materialize(pre.transform(train).select("log_change", "features"), "encoded")
    models = {name: (fit_ridge(encoded, "log_change", a), pre) for name, a in (("ols", 0.0), ("ridge", 25.0))}
    out = coefficient_rollup(models, encoded)
    return out.select(
        "model", "feature", fixed(F.col("max_abs_coefficient"), 6).alias("max_abs_coefficient"),
        fixed(F.col("sum_abs_coefficient"), 6).alias("sum_abs_coefficient"), "coefficient_terms",
    )


SEED, REPEATS = 0, 3


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six columns whose permutation hurts the ridge most."""
    pre, _, test, model = _ridge(spark, sf_dir)
    found = permutation_importance(model, pre, test, "log_change", ["l_partkey", "year"], repeats=REPEATS, seed=SEED)
    top = top_rows(found, [F.desc("importance_mean_log_mae"), F.col("feature")], 6)
    return top.select("feature", *[fixed(F.col(c), 7).alias(c) for c in ("importance_mean_log_mae", "importance_std_log_mae")])


QUERIES = {
    "relative_errors": relative_errors,
    "error_summary_by_model": error_summary_by_model,
    "fit_metrics_by_model": fit_metrics_by_model,
    "consolidated_metrics": consolidated_metrics,
    "best_worst_examples": best_worst_examples,
    "preprocessing_parameters": preprocessing_parameters,
    "ridge_one_feature": ridge_one_feature,
    "no_change_metrics": no_change_metrics,
    "ridge_fit_predict": ridge_fit_predict,
    "ols_fit_predict": ols_fit_predict,
    "rf_fit_predict": rf_fit_predict,
    "gbt_fit_predict": gbt_fit_predict,
    "encoded_features": encoded_features,
    "coefficient_rollup": coefficients,
    "one_feature_coefficients": one_feature_coefficients,
    "permutation_importance": importance,
}

_PREDICTIONS_SQL = """
p AS (
  SELECT o_orderkey, m.model, o_totalprice / 2 + 50000 AS current,
         CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS actual,
         CASE m.model WHEN 'by_customer' THEN avg(o_totalprice) OVER (PARTITION BY o_custkey, m.model)
              ELSE avg(o_totalprice) OVER (PARTITION BY o_orderpriority, m.model) END AS predicted
  FROM orders CROSS JOIN (VALUES ('by_customer'), ('by_priority')) m(model)),
e AS (SELECT *, CASE WHEN actual > 0 THEN (predicted - actual) / actual END AS r FROM p)"""


def _summary_sql(r: str) -> dict[str, str]:
    return {
        "rows": f"count({r})::DOUBLE",
        "mean_error_pct": f"avg({r}) * 100",
        "mape_pct": f"avg(abs({r})) * 100",
        "median_ape_pct": f"median(abs({r})) * 100",
        "rmse_pct": f"sqrt(avg({r} * {r})) * 100",
        "p90_ape_pct": f"quantile_cont(abs({r}), 0.9) * 100",
        "max_ape_pct": f"max(abs({r})) * 100",
    }


_SUMMARY_SQL = _summary_sql("r")


def _fit_sql(y: str, p: str, names: tuple[str, str, str]) -> dict[str, str]:
    both = f"({y}) IS NOT NULL AND ({p}) IS NOT NULL"
    kept = f"CASE WHEN {both} THEN {y} END"
    return {
        names[0]: f"avg(abs(({y}) - ({p})))",
        names[1]: f"sqrt(avg((({y}) - ({p})) * (({y}) - ({p}))))",
        names[2]: f"1 - sum((({y}) - ({p})) * (({y}) - ({p}))) "
        f" / nullif(var_pop({kept}) * count({kept}), 0)",
    }


def _all_fit_sql(current: str, actual: str, predicted: str) -> dict[str, str]:
    ok_y = f"{actual} > 0 AND {current} > 0"
    ok_p = f"{predicted} > 0 AND {current} > 0"
    return {
        **_fit_sql(actual, predicted, ("mae_dollars", "rmse_dollars", "r2_dollars")),
        **_fit_sql(
            f"CASE WHEN {ok_y} THEN ln({actual} / {current}) END",
            f"CASE WHEN {ok_p} THEN ln({predicted} / {current}) END",
            ("mae_log_change", "rmse_log_change", "r2_log_change"),
        ),
        **_fit_sql(
            f"CASE WHEN {ok_y} THEN ({actual} / {current} - 1) * 100 END",
            f"CASE WHEN {ok_p} THEN ({predicted} / {current} - 1) * 100 END",
            ("mae_growth_pct_points", "rmse_growth_pct_points", "r2_growth_pct"),
        ),
    }


_FIT = _all_fit_sql("current", "actual", "predicted")
_DIGITS = {c: 2 if "dollars" in c else 4 for c in [*_FIT, *_SUMMARY_SQL]}
_CONSOLIDATED = ", ".join(f"{fx(e, _DIGITS[c])} AS {c}" for c, e in {**_FIT, **_SUMMARY_SQL}.items())

_PANEL_SQL = f"""
yearly AS (
  SELECT l_partkey, year(l_shipdate)::BIGINT AS year, avg(l_extendedprice / l_quantity) AS price,
         sum(CASE WHEN l_discount > 0.02 THEN l_quantity END) AS quantity, avg(nullif(l_discount, 0)) AS discount,
         bool_or(l_returnflag = 'R') AS returned
  FROM lineitem GROUP BY 1, 2),
panel AS (
  SELECT a.*, b.price AS next_price, nullif(p_type, 'PROMO') AS p_type, ln(a.price) AS log_price,
         ln(b.price) - ln(a.price) AS log_change
  FROM yearly a JOIN yearly b ON a.l_partkey = b.l_partkey AND b.year = a.year + 1
  LEFT JOIN part ON a.l_partkey = p_partkey),
train AS (SELECT * FROM panel WHERE year BETWEEN {FIRST} AND {LAST}),
test AS (SELECT * FROM panel WHERE year = {TEST_YEAR})"""

_NO_CHANGE = {
    **_all_fit_sql("price", "next_price", "price"),
    **_summary_sql("((price - next_price) / next_price)"),
}

def _scaled_sql(c: str) -> str:
    filled = f"coalesce({c}, (SELECT median({c}) FROM train))"
    return f"({filled} - (SELECT avg({filled}) FROM train)) / (SELECT stddev_pop({filled}) FROM train)"


ORACLES = {
    "relative_errors": f"""WITH {_PREDICTIONS_SQL}
SELECT o_orderkey, model, actual, {fx('predicted', 2)} AS predicted, {fx('r')} AS relative_error,
       {fx('abs(r)')} AS absolute_relative_error, {fx('r * 100')} AS percentage_error,
       {fx('abs(r) * 100')} AS absolute_percentage_error
FROM e""",
    "error_summary_by_model": f"WITH {_PREDICTIONS_SQL} SELECT model, "
    + ", ".join(f"{fx(e)} AS {c}" for c, e in _SUMMARY_SQL.items())
    + " FROM e GROUP BY 1",
    "fit_metrics_by_model": f"WITH {_PREDICTIONS_SQL} SELECT model, "
    + ", ".join(f"{fx(e, 2 if 'dollars' in c else 6)} AS {c}" for c, e in _FIT.items())
    + " FROM e GROUP BY 1",
    "consolidated_metrics": f"""WITH {_PREDICTIONS_SQL}
SELECT model, CASE model WHEN 'by_priority' THEN '1995-1999' END AS train_years, {_CONSOLIDATED}
FROM e GROUP BY 1""",
    "best_worst_examples": f"""WITH {_PREDICTIONS_SQL},
x AS (SELECT *, abs(r) * 100 AS ape FROM e WHERE r IS NOT NULL),
low AS (SELECT 'lowest_error_examples' AS example, * FROM x ORDER BY ape, model, o_orderkey LIMIT 5),
high AS (SELECT 'highest_error_examples' AS example, * FROM x ORDER BY ape DESC, model, o_orderkey LIMIT 5)
SELECT example, model, o_orderkey, actual, round(predicted, 1) AS predicted,
       {fx('ape', 3)} AS absolute_percentage_error
FROM (SELECT * FROM low UNION ALL SELECT * FROM high)""",
    "preprocessing_parameters": f"WITH {_PANEL_SQL}, "
    + ", ".join(
        f"m_{c} AS (SELECT '{c}' AS feature, median({c}) AS med, "
        f"avg(coalesce({c}, (SELECT median({c}) FROM train))) AS mean, "
        f"stddev_pop(coalesce({c}, (SELECT median({c}) FROM train))) AS scale FROM train)"
        for c in NUMERIC
    )
    + ", "
    + "m_returned AS (SELECT 'returned' AS feature, NULL::DOUBLE AS med, avg(returned::INT) AS mean, "
    "stddev_pop(returned::INT) AS scale FROM train), "
    "allm AS (" + " UNION ALL ".join(f"SELECT * FROM m_{c}" for c in [*NUMERIC, "returned"]) + ") "
    f"SELECT feature, {fx('med', 6)} AS median, {fx('mean', 6)} AS mean, {fx('scale', 6)} AS scale, "
    "NULL::VARCHAR AS mode, NULL::BIGINT AS n_levels FROM allm UNION ALL "
    "SELECT 'p_type', NULL, NULL, NULL, (SELECT p_type FROM train WHERE p_type IS NOT NULL GROUP BY 1 "
    "ORDER BY count(*) DESC, p_type LIMIT 1), (SELECT count(DISTINCT p_type) FROM train)",
    "ridge_one_feature": f"""WITH {_PANEL_SQL},
med AS (SELECT median(discount) AS d FROM train),
s AS (SELECT avg(coalesce(discount, d)) AS mean, stddev_pop(coalesce(discount, d)) AS scale FROM train, med),
z AS (SELECT (coalesce(discount, d) - mean) / scale AS z, log_change AS y FROM train, med, s),
w AS (SELECT sum(z * y) / (count(*) + 25.0) AS w, avg(y) AS b FROM z),
f AS (SELECT test.*, b + w * (coalesce(discount, d) - mean) / scale AS p FROM test, med, s, w)
SELECT l_partkey, year, 'ridge' AS model, {fx('p', 6)} AS pred_log_change, {fx('price * exp(p)', 3)} AS pred_price
FROM f
UNION ALL SELECT l_partkey, year, 'no_change', 0.0, {fx('price', 3)} FROM test""",
    "encoded_features": f"""WITH {_PANEL_SQL},
mode AS (SELECT p_type FROM train WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 1),
t AS (SELECT *, coalesce(p_type, (SELECT p_type FROM mode)) AS kind FROM test)
SELECT l_partkey, year, """
    + ", ".join(
        f"{fx(_scaled_sql(c))} AS {c}" for c in NUMERIC
    )
    + f", {fx('(returned::INT - (SELECT avg(returned::INT) FROM train)) / (SELECT stddev_pop(returned::INT) FROM train)')} AS returned, "
    + ", ".join(f"(kind = '{k}')::INT::DOUBLE AS p_type_{k.lower()}" for k in KINDS)
    + " FROM t",
    "one_feature_coefficients": f"""WITH {_PANEL_SQL},
z AS (SELECT (log_price - avg(log_price) OVER ()) / stddev_pop(log_price) OVER () AS z, log_change AS y FROM train),
w AS (
  SELECT 'ols' AS model, abs(sum(z * y) / count(*)) AS w FROM z
  UNION ALL SELECT 'ridge', abs(sum(z * y) / (count(*) + 25.0)) FROM z)
SELECT model, 'log_price' AS feature, {fx('w', 6)} AS max_abs_coefficient, {fx('w', 6)} AS sum_abs_coefficient,
       1::BIGINT AS coefficient_terms FROM w""",
    "no_change_metrics": f"WITH {_PANEL_SQL} SELECT 'no_change' AS model, "
    + ", ".join(f"{fx(e)} AS {c}" for c, e in _NO_CHANGE.items())
    + " FROM test",
}


def _filled_sql(of: str) -> str:
    """Rows of ``of`` as the encoder sees them: medians and the mode of the training rows where a value is missing."""
    columns = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM train)) AS {c}" for c in NUMERIC)
    return (
        f"SELECT l_partkey, year, price, next_price, log_change AS y, {columns}, coalesce(returned, false)::INT::DOUBLE AS returned, "
        f"coalesce(p_type, (SELECT p_type FROM train WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 1)) AS p_type FROM {of}"
    )


def _vector_sql(kinds: list[str], source: Callable[[str], str] = str) -> str:
    """The feature vector, every column read from what ``source`` makes of its name."""
    plain = [f"({source(c)} - m_{c}) / s_{c}" for c in [*NUMERIC, *BOOLEAN]]
    hot = [f"({source('p_type')} = '{k}')::INT::DOUBLE" for k in kinds]
    return "[" + ", ".join([*plain, *hot]) + "]"


def _solved_sql(name: str, alpha: float, kinds: list[str]) -> str:
    """Least squares with penalty ``alpha`` by Gauss-Jordan elimination: ``name`` has weights, column means and the mean."""
    p = len(NUMERIC) + len(BOOLEAN) + len(kinds)
    row = lambda i: ", ".join(
        [f"covar_pop(x[{i}], x[{j}]) * count(*)" + (f" + {alpha!r}" if i == j else "") for j in range(1, p + 1)] + [f"covar_pop(x[{i}], y) * count(*)"]
    )
    return f"""
{name}_x AS (SELECT y, {_vector_sql(kinds)} AS x FROM f_train, moments),
{name}_gj(k, a) AS (
  SELECT 1::BIGINT, [{", ".join(f"[{row(i)}]" for i in range(1, p + 1))}] FROM {name}_x
  UNION ALL
  SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / a[k][k])
                               ELSE list_transform(r, lambda v, j: v - r[k] * a[k][j] / a[k][k]) END)
  FROM {name}_gj WHERE k <= {p}),
{name} AS (
  SELECT list_transform(a, lambda r: r[{p + 1}]) AS w, yb, mx FROM {name}_gj,
         (SELECT avg(y) AS yb, [{", ".join(f"avg(x[{i}])" for i in range(1, p + 1))}] AS mx FROM {name}_x)
  WHERE k = {p + 1})"""


_FITTED_SQL = f"""WITH RECURSIVE {_PANEL_SQL.strip()},
f_train AS ({_filled_sql("train")}),
f_test AS ({_filled_sql("test")}),
moments AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in [*NUMERIC, *BOOLEAN])} FROM f_train)"""


def _predicted_sql(vector: str) -> str:
    return f"yb + list_inner_product({vector}, w) - list_inner_product(mx, w)"


def _report_sql(name: str, alpha: float, kinds: list[str]) -> str:
    """The holdout report of a linear fit and of 'no change'."""
    figures = {**_all_fit_sql("price", "next_price", "p"), **_summary_sql("((p - next_price) / next_price)")}
    shown = ", ".join(f"{fx(e, 2 if 'dollars' in c else 4)} AS {c}" for c, e in figures.items())
    return f"""{_FITTED_SQL}, {_solved_sql("fit", alpha, kinds)},
scored AS (
  SELECT '{name}' AS model, price, next_price, price * exp({_predicted_sql(_vector_sql(kinds))}) AS p FROM f_test, moments, fit
  UNION ALL SELECT 'no_change', price, next_price, price FROM test)
SELECT model, {shown} FROM scored GROUP BY 1"""


_SOURCES = [*NUMERIC, *BOOLEAN, *CATEGORICAL]
#: The plain fit has no level columns: without a penalty their coefficients are not determined.
_TERMS = [(c, [i]) for i, c in enumerate([*NUMERIC, *BOOLEAN], 1)]
_HOT = [("p_type", list(range(len(_TERMS) + 1, len(_TERMS) + len(KINDS) + 1)))]


def _rollup_sql(model: str, fit: str, terms: list[tuple[str, list[int]]]) -> str:
    rows = []
    for feature, slots in terms:
        sizes = "[" + ", ".join(f"abs(w[{i}])" for i in slots) + "]"
        rows.append(
            f"SELECT '{model}' AS model, '{feature}' AS feature, {fx(f'list_max({sizes})', 6)} AS max_abs_coefficient, "
            f"{fx(f'list_sum({sizes})', 6)} AS sum_abs_coefficient, {len(slots)}::BIGINT AS coefficient_terms FROM {fit}"
        )
    return " UNION ALL ".join(rows)


def _swapped(column: str) -> str:
    """The column of row ``a``, or of its donor ``b`` where it is the one that is permuted."""
    return f"(CASE WHEN which = {_SOURCES.index(column)} THEN b.{column} ELSE a.{column} END)"


ORACLES |= {
    "ridge_fit_predict": _report_sql("ridge_linear_regression", RIDGE_ALPHA, KINDS),
    # The levels sum to one, so plain least squares forecasts the same without the last of them.
    "ols_fit_predict": _report_sql("ols_linear_regression", 0.0, KINDS[:-1]),
    "coefficient_rollup": f"""{_FITTED_SQL}, {_solved_sql("penalised", 10.0, KINDS)}, {_solved_sql("plain", 0.0, [])}
{_rollup_sql("ridge", "penalised", _TERMS + _HOT)} UNION ALL {_rollup_sql("ols", "plain", _TERMS)}""",
    "permutation_importance": f"""{_FITTED_SQL}, {_solved_sql("fit", 10.0, KINDS)},
numbered AS (SELECT *, row_number() OVER (ORDER BY l_partkey, year) - 1 AS i, count(*) OVER () AS n FROM f_test),
draw(r, u, v) AS (VALUES {", ".join(f"({r}, {u}, {v})" for r, (u, v) in enumerate(affine_draws(REPEATS, SEED)))}),
step AS (
  SELECT r, n, (SELECT min(a) FROM (SELECT unnest(range(1 + (n * u >> 20), 2 * n + 2)) AS a) WHERE gcd(a, n) = 1) AS a, n * v >> 20 AS b
  FROM draw, (SELECT count(*) AS n FROM f_test)),
e AS (
  SELECT step.r, which, avg(abs(a.y - ({_predicted_sql(_vector_sql(KINDS, _swapped))}))) AS mae
  FROM numbered a, step, (SELECT unnest(range({len(_SOURCES) + 1})) AS which), moments, fit, numbered b
  WHERE b.i = (step.a * a.i + step.b) % step.n GROUP BY ALL),
g AS (
  SELECT ['{"', '".join(_SOURCES)}'][e.which + 1] AS feature, e.mae - p.mae AS rise
  FROM e JOIN e p ON p.r = e.r AND p.which = {len(_SOURCES)} WHERE e.which < {len(_SOURCES)})
SELECT feature, {fx('avg(rise)', 7)} AS importance_mean_log_mae, {fx('stddev_pop(rise)', 7)} AS importance_std_log_mae
FROM g GROUP BY 1 ORDER BY avg(rise) DESC, feature LIMIT 6""",
}
