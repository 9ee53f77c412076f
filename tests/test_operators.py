import math

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom.operators import aggregates, comoments, evaluation, groups, joins, pivoting, profiling, quality, rowsets, splitting


def test_weighted_mean_falls_back(spark, rows):
    df = spark.createDataFrame(
        [("w", 10.0, 1.0), ("w", 20.0, 3.0), ("w", 99.0, 0.0), ("w", None, 5.0), ("w", 50.0, None),
         ("f", 10.0, 0.0), ("f", 30.0, None), ("n", None, 2.0)],
        "g string, v double, w double",
    )
    out = rows(df.groupBy("g").agg(aggregates.weighted_mean(F.col("v"), F.col("w")).alias("m")), "g")
    assert [r["m"] for r in out] == [20.0, None, 17.5]


def test_first_last_and_months(spark):
    df = spark.createDataFrame([(1, None, 5.0), (3, "b", None), (2, "a", 7.0), (12, "c", 6.0), (12, None, None)], "t int, s string, v double")
    out = df.agg(
        aggregates.first_known(F.col("s"), F.col("t")).alias("first"),
        aggregates.last_known(F.col("v"), F.col("t")).alias("last"),
        F.bit_count(aggregates.month_set(F.col("t"))).alias("months"),
        aggregates.sorted_text(F.col("s")).alias("text"),
    ).first()
    assert (out["first"], out["last"], out["months"], out["text"]) == ("a", 6.0, 4, "a; b; c")


def test_next_period_skips_gaps(spark, rows):
    df = spark.createDataFrame([("a", 2012, 1.0), ("a", 2013, 2.0), ("a", 2015, 4.0)], "k string, year int, v double")
    out = rows(joins.next_period(df, "k", "year", {"v": "nv"}), "year")
    assert [r["nv"] for r in out] == [2.0, None, None]


def test_validated_joins_raise(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, a string")
    twice = spark.createDataFrame([(1, 10), (1, 11)], "k int, b int")
    once = spark.createDataFrame([(1, 10), (None, 12)], "k int, b int")
    assert {r["k"]: r["b"] for r in joins.join_many_to_one(left, once, ["k"]).collect()} == {1: 10, 2: None, 3: None}
    with pytest.raises(PySparkException, match="duplicate join key"):
        joins.join_many_to_one(left, twice, ["k"]).collect()
    with pytest.raises(quality.DuplicateKeyError):
        joins.join_one_to_one(left.union(left), once, ["k"])


def test_presence_flag_and_missing_source(spark, rows):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    feats = spark.createDataFrame([(1, 5.0), (2, None)], "k int, v double")
    out = rows(joins.assemble_panel(base, {"f": feats, "gone": None}, ["k"], prefix="p_"), "k")
    assert [r["p_has_f"] for r in out] == [True, False, False]
    assert [r["p_has_gone"] for r in out] == [False, False, False]
    with pytest.raises(ValueError, match="both sides"):
        joins.attach_features(feats, feats, "again", ["k"])


def test_surplus_rows_and_audit(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, 1.0)], "k int, v double")
    assert quality.surplus_rows(df, ["k"]).first()[0] == 2
    with pytest.raises(quality.DuplicateKeyError, match="2 surplus"):
        quality.require_unique(df, ["k"])
    assert quality.surplus_rows(df.limit(0), ["k"]).first()[0] == 0
    assert tuple(quality.audit_counts(df, {"big": F.col("v") > 0}).first()) == (4, 1)


def test_zscore_edges(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("flat", 0.1), ("flat", 0.1), ("flat", 0.1), ("one", 7.0), (None, 1.0), (None, 2.0)],
        "g string, v double",
    )
    out = rows(groups.zscore(df, ["g"], {"v": "z"}), "g", "v")
    got = {(r["g"], r["v"]): r["z"] for r in out}
    assert got == {
        ("a", 1.0): -1.0, ("a", 3.0): 1.0, ("a", None): None, ("flat", 0.1): 0.0, ("one", 7.0): 0.0,
        (None, 1.0): -1.0, (None, 2.0): 1.0,
    }


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("zero", 0.0)], "g string, v double")
    out = {(r["g"], r["v"]): r["s"] for r in groups.share_of_group(df, ["g"], "v", "s").collect()}
    assert out == {("a", 1.0): 0.25, ("a", 3.0): 0.75, ("zero", 0.0): None}


def test_category_columns(spark, rows):
    df = spark.createDataFrame([("k", "a", 1.0), ("k", "b", None), ("j", "c", 2.0)], "k string, t string, v double")
    values = ["a", "b", "c"]
    long = pivoting.category_totals(df, ["k"], "t", "v")
    assert rows(long, "k", "t") == [
        {"k": "j", "t": "c", "total": 2.0}, {"k": "k", "t": "a", "total": 1.0}, {"k": "k", "t": "b", "total": 0.0}
    ]
    out = df.groupBy("k").agg(
        pivoting.category_count("t", values).alias("n"), *pivoting.category_sums("t", "v", values, "est_")
    )
    assert rows(out, "k") == [
        {"k": "j", "n": 1, "est_a": 0.0, "est_b": 0.0, "est_c": 2.0},
        {"k": "k", "n": 2, "est_a": 1.0, "est_b": 0.0, "est_c": 0.0},
    ]
    assert pivoting.rename_prefix(out, {"est_": "e_"}).columns == ["k", "n", "e_a", "e_b", "e_c"]


def test_row_sets(spark, rows):
    df = spark.createDataFrame([(2012, 1, "x"), (2012, 0, "y"), (2013, 1, "z")], "year int, rank int, v string")
    assert [r["v"] for r in rows(rowsets.keep_by_priority(df, ["year"], F.col("rank")), "year")] == ["y", "z"]
    a, b = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "a int, c int")
    assert rows(rowsets.union_missing(a, b), "a") == [{"a": 1, "b": 2, "c": None}, {"a": 3, "b": None, "c": 4}]
    errors = spark.createDataFrame([(i, float(i)) for i in range(9)] + [(9, None)], "k int, e double")
    out = rowsets.best_and_worst(errors, "e", ["k"], 2).collect()
    assert [(r["example"][:4], r["k"]) for r in out] == [("lowe", 0), ("lowe", 1), ("high", 8), ("high", 7)]


def test_profile_kinds(spark):
    df = spark.createDataFrame(
        [(True, 1, 1.0, "True", "a", None), (None, 0, float("nan"), "false", "b", None), (False, 1, -0.0, None, "b", None)],
        "flag boolean, bit int, num double, txt string, cat string, empty string",
    )
    out = {r["feature"]: r for r in profiling.column_profile(df, df.columns).collect()}
    assert {k: r["feature_kind"] for k, r in out.items()} == {
        "flag": "boolean", "bit": "numeric", "num": "numeric", "txt": "categorical", "cat": "categorical", "empty": "categorical"}
    assert {k: r["preprocessing_kind"] for k, r in out.items()} == {
        "flag": "boolean", "bit": "boolean", "num": "numeric", "txt": "boolean", "cat": "categorical", "empty": "categorical"}
    assert out["num"]["n_unique"] == 2 and out["num"]["missing_rate"] == pytest.approx(1 / 3)
    assert out["empty"]["n_unique"] == 0 and out["empty"]["missing_rate"] == 1.0


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (400, 4)), columns=list("abcd"))
    pdf["e"] = pdf["a"] * 2 + rng.normal(0, 0.01, 400)
    pdf["flat"] = 2.1
    pdf.loc[rng.random(400) < 0.3, "b"] = np.nan
    pdf.loc[5, "a"] = np.nan
    pdf["odd"] = np.where(pdf["b"].isna(), pdf["a"], 0.3)  # constant wherever b is known
    want = pdf.corr().abs()
    df = spark.createDataFrame(pdf).repartition(5)
    got = profiling.correlation_pairs(df, list(pdf.columns)).collect()
    assert len(got) == 21
    for r in got:
        x = want.loc[r["left_feature"], r["right_feature"]]
        if "flat" in (r["left_feature"], r["right_feature"]) or {r["left_feature"], r["right_feature"]} == {"b", "odd"}:
            assert r["abs_correlation"] is None
        else:
            assert r["abs_correlation"] == pytest.approx(x, rel=1e-6)
    none = profiling.correlation_pairs(df.limit(0), list(pdf.columns)).collect()
    assert len(none) == 21 and all(r["abs_correlation"] is None for r in none)
    audit = profiling.correlation_audit(df, list(pdf.columns)).collect()
    assert ("a", "e") in {(r["left_feature"], r["right_feature"]) for r in audit}


def test_co_moments_by_task_and_in_a_tree(spark):
    """A row per task (and band) is all that is exchanged; rounds of three merges give the same state as one pass."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (900, 5)) + [0, 1e9, -5, 3, 0]
    x[:, 3] = 7.25
    x[rng.random((900, 5)) < 0.3] = np.nan
    one = comoments.batch_state(x)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcde"))).repartition(10)
    states = comoments.task_states(df, 10)
    assert states.count() == 10
    for fan in (3, 64):
        (row,) = comoments.tree_merged(states, fan).collect()
        np.testing.assert_allclose(np.frombuffer(row["state"]).reshape(8, -1)[:6], one[:6], rtol=1e-6, atol=1e-4)
    assert comoments.task_states(df, 10, band=4).count() == 30
    found = comoments.pair_correlations(df, list("abcde"), band=4).collect()
    want = pd.DataFrame(x).corr()
    assert len(found) == 10
    for r in found:
        expected = want.iloc[r["i"], r["j"]]
        assert r["correlation"] is None if 3 in (r["i"], r["j"]) else r["correlation"] == pytest.approx(expected, abs=1e-6)


def test_folds_of_sparse_years(spark, rows):
    df = spark.createDataFrame([("a", 2015), ("a", 2016), ("b", 2016), ("b", 2017), ("b", 2017), (None, 2017)], "z string, year int")
    out = rows(splitting.fold_summary(df, "z", "year", [2016, 2017, 2020]), "fold")
    assert [(r["train_rows"], r["train_entities"], r["validation_rows"], r["validation_entities"]) for r in out] == [
        (1, 1, 2, 2), (3, 2, 3, 1), (6, 2, 0, 0)]
    assert [(r["train_year_min"], r["train_year_max"]) for r in out] == [(2015, 2015), (2015, 2016), (2015, 2017)]


def test_split_drops_other_years(spark, rows):
    df = spark.createDataFrame([(y, float(y)) for y in (2011, 2012, 2022, 2023, 2024)] + [(None, 0.0)], "year int, t double")
    out = rows(splitting.temporal_split(df, "year", (2012, 2022), 2023), "year")
    assert [(r["year"], r["split"]) for r in out] == [
        (2012, "train_2012_2022"), (2022, "train_2012_2022"), (2023, "test_2023")]
    ok = splitting.valid_target(F.col("a"), F.col("b"), F.col("c"))
    frame = spark.createDataFrame([(1.0, 1.0, True), (1.0, 0.0, True), (None, 1.0, True), (1.0, 1.0, None)], "a double, b double, c boolean")
    assert [r[0] for r in frame.select(ok).collect()] == [True, False, False, False]


def test_error_summary_edges(spark, rows):
    df = spark.createDataFrame(
        [("m", 100.0, 110.0), ("m", 100.0, 80.0), ("m", 0.0, 5.0), ("m", None, 5.0), ("m", 50.0, None),
         ("m", 100.0, float("inf")), ("q", 100.0, 100.0)],
        "model string, y double, p double",
    )
    out = {r["model"]: r for r in rows(evaluation.error_summary(evaluation.add_relative_errors(df, "y", "p")))}
    m = out["m"]
    assert m["rows"] == 2.0
    assert m["mean_error_pct"] == pytest.approx(-5.0) and m["mape_pct"] == pytest.approx(15.0)
    assert m["median_ape_pct"] == pytest.approx(15.0) and m["p90_ape_pct"] == pytest.approx(19.0)
    assert m["rmse_pct"] == pytest.approx(math.sqrt(0.025) * 100) and m["max_ape_pct"] == pytest.approx(20.0)
    assert out["q"]["max_ape_pct"] == 0.0


def test_metrics_update_and_consolidate(spark, rows):
    summary = spark.createDataFrame([("a", 5.0, 1.0), ("b", 6.0, 2.0)], "model string, rows double, mape_pct double")
    with_model = spark.createDataFrame([("a", 1.5, -9.0), ("b", 2.5, -9.0)], "model string, mae_dollars double, rows double")
    unlabelled = spark.createDataFrame([(3.5, 13.4)], "mae_dollars double, ridge_alpha double")
    one = evaluation.update_metrics(with_model, summary)
    two = evaluation.update_metrics(unlabelled, summary, label="b")
    with pytest.raises(ValueError, match="label"):
        evaluation.update_metrics(unlabelled, summary)
    out = evaluation.consolidate([(one, ["a"]), (two, None)])
    assert out.columns == ["model", "ridge_alpha", "mae_dollars", "rows", "mape_pct"]
    assert rows(out, "model") == [
        {"model": "a", "ridge_alpha": None, "mae_dollars": 1.5, "rows": 5.0, "mape_pct": 1.0},
        {"model": "b", "ridge_alpha": 13.4, "mae_dollars": 3.5, "rows": 6.0, "mape_pct": 2.0},
    ]
