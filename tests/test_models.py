import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelloom.models.preprocessing import column_medians, column_modes, fit_preprocessor, level_counts
from panelloom.models.regressors import (
    affine_draws,
    affine_permutation,
    coefficient_rollup,
    fit_ridge,
    number_all,
    permutation_importance,
)
from panelloom.plans.forecast import Target, boosted, evaluate_holdout, fit_and_score, forest, ridge

NUMERIC, BOOLEAN, CATEGORICAL = ["a", "b", "const"], ["flag"], ["kind"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"id": range(n), "a": rng.normal(5, 2, n), "b": rng.normal(0, 9, n), "const": 3.0})
    pdf["flag"] = [None if x < 0.2 else bool(x > 0.6) for x in rng.random(n)]
    pdf["kind"] = rng.choice(["x", "y", "z"], n)
    pdf["y"] = 0.02 * pdf["a"] - 0.01 * pdf["b"] + (pdf["kind"] == "z") * 0.1 + rng.normal(0, 0.05, n)
    pdf.loc[rng.random(n) < 0.2, "a"] = np.nan
    pdf.loc[rng.random(n) < 0.1, "kind"] = None
    return pdf


@pytest.fixture(scope="module")
def frame(spark, data):
    clean = data.astype(object).where(data.notna(), None)
    schema = "id long, a double, b double, const double, flag boolean, kind string, y double"
    return spark.createDataFrame([tuple(r) for r in clean.itertuples(index=False)], schema).repartition(4).cache()


def _design(train, other):
    """The same preprocessing in numpy: median / mode fill, population scaling, one-hot."""
    cols = []
    for c in [*NUMERIC, *BOOLEAN]:
        t, o = train[c], other[c]
        if c in BOOLEAN:
            t, o = (s.map({True: 1.0, False: 0.0}).fillna(0.0) for s in (t, o))
        fill = t.astype(float).median()
        t, o = t.astype(float).fillna(fill), o.astype(float).fillna(fill)
        cols.append((o - t.mean()) / (t.std(ddof=0) or 1.0))
    mode = train["kind"].value_counts().sort_index().idxmax()
    kinds = sorted(train["kind"].dropna().unique())
    kind = other["kind"].fillna(mode)
    return np.column_stack([*cols, *[(kind == k).astype(float) for k in kinds]])


def test_ridge_matches_closed_form(frame, data):
    alpha = 13.4
    pre = fit_preprocessor(frame, NUMERIC, BOOLEAN, CATEGORICAL)
    model = fit_ridge(pre.transform(frame), "y", alpha)
    x, y = _design(data, data), data["y"].to_numpy()
    centered = x - x.mean(axis=0)
    want = np.linalg.solve(centered.T @ centered + alpha * np.eye(x.shape[1]), centered.T @ (y - y.mean()))
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-8, atol=1e-10)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ want, rel=1e-8)


def test_unseen_category_and_missing_values_at_scoring(spark, frame):
    pre = fit_preprocessor(frame, NUMERIC, BOOLEAN, CATEGORICAL)
    assert {(r["value"], r["level"]) for r in pre.levels.collect()} == {("x", 0), ("y", 1), ("z", 2)} and pre.sizes == {"kind": 3}
    odd = spark.createDataFrame(
        [(1, None, float("nan"), None, None, "new"), (2, 1.0, 1.0, 3.0, True, None)],
        "id long, a double, b double, const double, flag boolean, kind string",
    )
    out = {r["id"]: r for r in pre.transform(odd).collect()}
    assert list(out[1]["features"].toArray()[-3:]) == [0.0, 0.0, 0.0]
    assert sum(out[2]["features"].toArray()[-3:]) == 1.0
    assert out[1]["features"].toArray()[0] == pytest.approx((pre.medians["a"] - pre.means["a"]) / pre.scales["a"])
    assert out[1]["kind"] == "new" and out[1]["a"] is None  # the inputs stay as they were


def test_medians_and_modes(spark):
    df = spark.createDataFrame(
        [(1.0, "b"), (2.0, "a"), (3.0, "b"), (10.0, "a"), (float("nan"), None)], "v double, s string"
    ).withColumn("none", F.lit(None).cast("double"))
    assert column_medians(df, ["v", "none"]) == {"v": 2.5, "none": 0.0}
    assert column_modes(level_counts(df, ["s"]), ["s"]) == {"s": "a"}


def test_coefficient_rollup(frame, rows):
    pre = fit_preprocessor(frame, NUMERIC, BOOLEAN, CATEGORICAL)
    model = fit_ridge(pre.transform(frame), "y", 1.0)
    out = {r["feature"]: r for r in rows(coefficient_rollup({"m": (model, pre)}, frame))}
    w = np.abs(model.coefficients.toArray())
    assert out["kind"]["coefficient_terms"] == 3
    assert out["kind"]["sum_abs_coefficient"] == pytest.approx(w[-3:].sum())
    assert out["a"]["max_abs_coefficient"] == pytest.approx(w[0])


def test_dense_numbers(frame):
    numbers = sorted(r["_at"] for r in number_all(frame.select("id"), ["id"]).collect())
    assert numbers == list(range(300))


def test_permutation_importance_ranks_the_signal(frame, rows):
    pre = fit_preprocessor(frame, NUMERIC, BOOLEAN, CATEGORICAL)
    model = fit_ridge(pre.transform(frame), "y", 1.0)
    out = {r["feature"]: r for r in rows(permutation_importance(model, pre, frame, "y", ["id"], repeats=2))}
    assert set(out) == set(pre.sources)
    assert out["const"]["importance_mean_log_mae"] == pytest.approx(0.0, abs=1e-12)
    assert out["b"]["importance_mean_log_mae"] == max(r["importance_mean_log_mae"] for r in out.values())
    assert out["b"]["importance_mean_log_mae"] > 0.02


def test_models_beat_no_change(frame, rows):
    prices = frame.withColumn("price", F.lit(100.0)).withColumn("actual", 100.0 * F.exp("y"))
    target = Target("y", "price", "actual", "predicted")
    fits = {"ridge": ridge(1.0), "forest": forest(numTrees=5, maxDepth=4), "boosted": boosted(maxIter=5, maxDepth=3)}
    scored, models, _ = fit_and_score(prices, prices, fits, target, NUMERIC, BOOLEAN, CATEGORICAL)
    report = {r["model"]: r for r in rows(evaluate_holdout(scored, target))}
    assert set(report) == {"no_change", "ridge", "forest", "boosted"} and set(models) == set(fits)
    for name in fits:
        assert report[name]["rows"] == 300.0
        assert report[name]["mape_pct"] < report["no_change"]["mape_pct"]
        assert report[name]["r2_log_change"] > 0


def test_affine_permutations():
    for n in (1, 2, 3, 12, 97, 210, 1000):
        for draw in affine_draws(4, seed=n):
            a, b = affine_permutation(n, draw)
            assert sorted((a * i + b) % n for i in range(n)) == list(range(n))
    for n in (10**6, 10**10, 2**60):
        a, b = affine_permutation(n, affine_draws(1)[0])
        assert a * (n - 1) + b < 2**63
    assert affine_permutation(0, (1 << 19, 5)) == (1, 0)


def test_importance_joins_once_per_repeat_and_sorts_nothing_again(frame):
    pre = fit_preprocessor(frame, NUMERIC, BOOLEAN, CATEGORICAL)
    model = fit_ridge(pre.transform(frame), "y", 1.0)
    calls = []
    kind = type(frame)
    real = kind.repartitionByRange
    kind.repartitionByRange = lambda self, *a, **k: calls.append(a) or real(self, *a, **k)
    try:
        found = permutation_importance(model, pre, frame, "y", ["id"], repeats=3)
        empty = permutation_importance(model, pre, frame.limit(0), "y", ["id"], repeats=2)
    finally:
        kind.repartitionByRange = real
    assert len(calls) == 2  # one numbering a call
    assert found.count() == len(pre.sources)
    assert all(r["importance_mean_log_mae"] is None for r in empty.collect())


def test_levels_of_many_columns(spark):
    rows = [(f"v{i % 7}", None, f"w{i % 3}" if i % 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "p string, none string, q string")
    pre = fit_preprocessor(df, [], [], ["p", "none", "q"])
    assert pre.sizes == {"p": 7, "none": 1, "q": 3} and pre.width == 11
    terms = sorted((r["slot"], r["term"]) for r in pre.terms(spark).collect())
    assert [s for s, _ in terms] == list(range(11)) and terms[7] == (7, "none=") and terms[10] == (10, "q=w2")
    for r in pre.unit_vectors(spark).collect():
        assert list(r["features"].toArray()) == [float(i == r["slot"]) for i in range(11)]
    out = [r["features"].toArray() for r in pre.transform(df).collect()]
    assert all(v.sum() == 3.0 and v[7] == 1.0 for v in out)
