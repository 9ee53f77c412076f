import pytest

from panelloom.operators.profiling import grouped_names, value_counts
from panelloom.operators.rules import first_match, names_rule, Rule
from panelloom.plans.model_data import with_source_group
from panelloom.plans.select_features import feature_sets, select_schema
from pyspark.sql import functions as F


def _profile(spark, *features):
    rows = [f if isinstance(f, tuple) else (f, 0.1, 9) for f in features]
    return spark.createDataFrame(rows, "feature string, missing_rate double, n_unique long")


@pytest.mark.parametrize(
    "feature, group",
    [
        ("year", "time"), ("annual_homes_sold", "listings"), ("first_month", "listings"), ("age_0_17_share", "demographics"),
        ("male_share", "demographics"), ("born_other_state_25plus_share", "demographics"), ("min_pct_met_overall", "school_quality"),
        ("is_cst", "school_quality"), ("state_minimum_wage_source", "minimum_wage"), ("phase2_has_minimum_wage", "minimum_wage"),
        ("any_county_ordinance_record", "minimum_wage"), ("phase2_has_crime", "feature_availability"),
        ("log1p_crime_index_est", "crime"), ("amenities_observed", "amenities"), ("hispanic_or_latino_total_share", "other"),
    ],
)
def test_source_groups_by_first_match(spark, feature, group):
    assert with_source_group(_profile(spark, feature)).first()["source_group"] == group


@pytest.mark.parametrize(
    "feature, reason",
    [
        ("crime_violent_est_per_1k", ""), ("crime_observed", "crime_restricted_to_violent_and_property_rates"),
        ("phase2_has_minimum_wage", "constant_or_duplicate_minimum_wage_signal_in_train_test_window"),
        ("n_schools", "raw_duplicate_of_log1p_n_schools"), ("amenities_observed", "processing_artifact_or_duplicate_source_field"),
        (("anything", 0.0, 1), "constant_in_train_test_window"), (("anything", 0.5, 1), ""), (("is_cst", 0.0, 1), "school_raw_or_percentile_duplicate_of_selected_z_score_or_quality_flag"),
        ("dominant_county", "geographic_duplicate_of_parent_metro_region"), ("annual_median_dom", ""),
    ],
)
def test_exclusion_reasons_by_first_match(spark, feature, reason):
    row = select_schema(with_source_group(_profile(spark, feature))).first()
    assert row["exclusion_reason"] == reason and row["selected"] is (reason == "")


def test_selected_rows_come_first(spark):
    schema = select_schema(with_source_group(_profile(spark, "year", "male_share", "annual_median_dom", "age_0_17_share")))
    assert [r["feature"] for r in schema.collect()] == ["age_0_17_share", "male_share", "annual_median_dom", "year"]
    counts = {(r["source_group"], r["selected"]): r["features"] for r in value_counts(schema, "source_group", "selected").collect()}
    assert counts == {("demographics", True): 2, ("listings", True): 1, ("time", False): 1}
    sets = {r[0]: r[1] for r in feature_sets(schema).collect()}
    assert sets["baseline_features"] == ["age_0_17_share", "male_share", "annual_median_dom"] and "crime_features" not in sets
    reasons = {r[0]: r[1] for r in grouped_names(schema.filter("not selected"), "exclusion_reason").collect()}
    assert list(reasons.values()) == [["year"]]


def test_null_label_stops_the_search(spark):
    rules = [names_rule(F.col("feature"), {"a": "named"}), Rule(F.col("feature") == "b", None), Rule(F.lit(True), "rest")]
    out = first_match(_profile(spark, "a", "b", "c"), "feature", rules, "label", "default")
    assert {r["feature"]: r["label"] for r in out.collect()} == {"a": "named", "b": None, "c": "rest"}
