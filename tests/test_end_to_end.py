"""Raw tables through every job to a holdout report."""

import pytest
from pyspark.sql import functions as F

from fixtures import raw_world
from panelloom.plans.annual_panel import build_annual_panel
from panelloom.plans.category_pivot import build_category_pivot_features
from panelloom.plans.composition import build_composition_features
from panelloom.plans.event_rates import build_event_rate_features
from panelloom.plans.forecast import Target, evaluate_holdout, fit_and_score, ridge
from panelloom.plans.model_data import CHANGE_ALIAS, PRICE_ALIAS, build_panel, prepare_model_data
from panelloom.plans.rate_schedule import build_rate_schedule_features
from panelloom.plans.relative_scores import build_relative_scores
from panelloom.plans.select_features import select_features
from panelloom.session import materialize
from panelloom.sources.readers import key_rows

AMENITIES = ["coffee_shops", "fitness", "parks", "restaurants"]


@pytest.fixture(scope="module")
def model_data(spark):
    raw = raw_world(spark)
    _, listings = build_annual_panel(raw["listings"], key_rows(raw["demographics"], {"zcta5": 5}))
    _, people = build_composition_features(raw["demographics"])
    people = materialize(people, "people")
    sources = {
        "demographics": people,
        "school_quality": build_relative_scores(raw["school"], key_rows(people, ["zcta5", "year"]))[1],
        "minimum_wage": build_rate_schedule_features(raw["wage"], raw["bridge"])["features"],
        "crime": build_event_rate_features(raw["crime"])[1],
        "amenities": build_category_pivot_features(raw["amenities"], people, AMENITIES)[1],
    }
    panel = materialize(build_panel(listings, sources), "panel")
    assert panel.count() == 12 * 12  # one row per area and year, the last year has no target
    return prepare_model_data(panel)


@pytest.fixture(scope="module")
def selection(model_data):
    return select_features(model_data.rows, model_data.profile)


def test_candidate_and_selected_feature_counts(model_data, selection):
    assert len(model_data.features) == 202
    assert len(selection.features) == 54
    kinds = {r[0]: len(r[1]) for r in selection.by_kind.collect()}
    assert kinds["categorical"] == 3
    assert sum(kinds.values()) == 54


def test_feature_set_sizes(selection):
    sizes = {r[0]: len(r[1]) for r in selection.sets.collect()}
    assert sizes == {
        "all_selected_features": 54, "baseline_features": 37, "phase2_features": 54,
        "neighborhood_features": 13, "policy_features": 3, "crime_features": 2,
    }


def test_no_future_column_is_a_feature(model_data):
    assert not [c for c in model_data.features if c.startswith(("target_", "next_year_", "y_next"))]


def test_split_and_folds(model_data, rows):
    train = {r["year"] for r in model_data.train.select("year").distinct().collect()}
    test = {r["year"] for r in model_data.test.select("year").distinct().collect()}
    assert train == set(range(2012, 2023)) and test == {2023}
    folds = rows(model_data.folds, "fold")
    assert [f["validation_year"] for f in folds] == list(range(2017, 2023))
    assert all(f["train_year_max"] < f["validation_year"] for f in folds)
    assert folds[0]["train_rows"] == 12 * 5 and folds[0]["train_entities"] == 12


def test_fit_and_evaluate(model_data, selection, rows):
    profile = {r["feature"]: r["preprocessing_kind"] for r in selection.schema.filter("selected").collect()}
    by_kind = {k: sorted(f for f, kind in profile.items() if kind == k) for k in ("numeric", "boolean", "categorical")}
    target = Target(CHANGE_ALIAS, "annual_median_sale_price", PRICE_ALIAS)
    is_train = F.col("split").startswith("train_")
    scored, models, _ = fit_and_score(
        selection.rows.filter(is_train), selection.rows.filter(~is_train), {"ridge": ridge()}, target, **by_kind
    )
    report = {r["model"]: r for r in rows(evaluate_holdout(scored, target))}
    assert set(report) == {"no_change", "ridge"}
    assert report["ridge"]["rows"] == 12.0
    assert report["no_change"]["median_ape_pct"] > 0
    assert report["ridge"]["mape_pct"] < 30
