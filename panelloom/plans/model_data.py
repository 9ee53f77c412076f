"""Panel -> leakage-safe train/test rows, column profile, split summary and folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import number_of
from panelloom.operators.joins import assemble_panel
from panelloom.operators.profiling import column_profile, value_counts
from panelloom.operators.rules import Rule, first_match, named
from panelloom.operators.splitting import (
    feature_columns,
    fold_summary,
    split_summary,
    temporal_split,
    valid_target,
)
from panelloom.session import materialize

# Target columns and their aliases, identifiers, columns that know the future, years.
PRICE_TARGET = "next_year_annual_median_sale_price"
CHANGE_TARGET = "target_median_sale_price_log_change_next_year"
PRICE_ALIAS = "y_next_year_median_sale_price"
CHANGE_ALIAS = "y_next_year_median_sale_price_log_change"
IDENTIFIERS = ["zcta5", "geo_id", "zcta_name"]
LEAKAGE = [
    PRICE_TARGET,
    CHANGE_TARGET,
    "next_year_months_observed",
    "next_year_full_year_coverage",
    "target_median_sale_price_pct_change_next_year",
    "has_next_year_target",
    "target_next_year_complete",
    "baseline_model_eligible",
]
TRAIN_YEARS = (2012, 2022)
TEST_YEAR = 2023
FIRST_VALIDATION_YEAR = 2017

# Column names that belong to a source group without sharing its prefix.
LISTINGS_NAMES = [
    "parent_metro_region", "months_observed", "first_month", "last_month", "full_year_coverage",
    "months_with_median_sale_price", "months_with_median_list_price", "months_with_homes_sold",
    "months_with_pending_sales", "months_with_new_listings", "months_with_inventory",
]
DEMOGRAPHIC_NAMES = [
    "total_population", "log_total_population", "median_household_income", "log_median_household_income",
    "median_household_income_missing", "demographics_baseline_eligible", "male_share", "female_share",
    "born_other_state_25plus_share", "born_other_state_25plus_bachelors_or_higher_count",
    "born_other_state_25plus_bachelors_or_higher_share",
]
SCHOOL_NAMES = [
    "assessment_type", "is_caaspp", "is_cst", "school_year_complete", "school_quality_extended_eligible",
    "n_schools", "log1p_n_schools", "overall_score_range", "total_students_tested_reported_positive",
    "total_students_tested_unreliable",
]


def source_group_rules() -> list[Rule]:
    """Which source a feature comes from, by its name; the first rule that holds counts."""
    name = F.col("feature")
    return [
        Rule(name == "year", "time"),
        Rule(named(name, LISTINGS_NAMES, ["annual_"]), "listings"),
        Rule(
            named(name, DEMOGRAPHIC_NAMES, ["age_", "education_", "foreign_born", "native_born", "race_"]),
            "demographics",
        ),
        Rule(named(name, SCHOOL_NAMES, ["avg_pct_", "median_pct_", "min_pct_", "max_pct_"]), "school_quality"),
        Rule(
            named(name, [], ["dominant_county", "zcta_county", "any_county"], ["minimum_wage"]), "minimum_wage"
        ),
        Rule(named(name, [], ["crime_", "log1p_crime", "violent_component", "property_component"]), "crime"),
        Rule(named(name, [], ["amenity_", "amenities_"]), "amenities"),
        Rule(named(name, [], ["phase2_has_"]), "feature_availability"),
    ]


def with_source_group(profile: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    return first_match(profile, "feature", rules or source_group_rules(), "source_group", "other")


def with_target_aliases(panel: DataFrame) -> DataFrame:
    """Targets as numbers, also under the names the models use."""
    change, price = number_of(panel, CHANGE_TARGET), number_of(panel, PRICE_TARGET)
    return panel.withColumns(
        {CHANGE_TARGET: change, PRICE_TARGET: price, CHANGE_ALIAS: change, PRICE_ALIAS: price}
    )


def build_panel(listings: DataFrame, sources: dict[str, DataFrame | None]) -> DataFrame:
    """Listings with every feature table and its ``phase2_has_*`` flag."""
    return assemble_panel(listings, sources, ["zcta5", "year"], prefix="phase2_")


@dataclass(frozen=True)
class ModelData:
    """The split rows and their column profile; the summaries run when they are asked for."""

    rows: DataFrame
    features: list[str]
    profile: DataFrame
    validation_years: range

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("split").startswith("train_"))

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("split").startswith("test_"))

    @cached_property
    def split_summary(self) -> DataFrame:
        return split_summary(self.rows, ["split", "year"], "zcta5", CHANGE_ALIAS)

    @cached_property
    def folds(self) -> DataFrame:
        return fold_summary(self.train, "zcta5", "year", self.validation_years)

    @property
    def kind_counts(self) -> DataFrame:
        return value_counts(self.profile, "feature_kind")

    @property
    def group_counts(self) -> DataFrame:
        return value_counts(self.profile, "source_group")


def prepare_model_data(
    panel: DataFrame, allow_incomplete_target: bool = False,
    train_years: tuple[int, int] = TRAIN_YEARS, test_year: int = TEST_YEAR,
    first_validation_year: int = FIRST_VALIDATION_YEAR,
) -> ModelData:
    """Filter, split, project and describe the model rows.

    The split rows are written once: the profile, the summaries and the models read them.
    """
    frame = with_target_aliases(panel)
    complete = None if allow_incomplete_target else F.col("target_next_year_complete")
    valid = frame.filter(valid_target(F.col(CHANGE_ALIAS), F.col(PRICE_ALIAS), complete))
    split = temporal_split(valid, "year", train_years, test_year)
    features = feature_columns(frame.columns, [*IDENTIFIERS, *LEAKAGE, CHANGE_ALIAS, PRICE_ALIAS])
    rows = materialize(
        split.select(
            "zcta5", "year", "split", PRICE_ALIAS, CHANGE_ALIAS, *[c for c in features if c != "year"]
        ),
        "model-rows",
    )
    profile = with_source_group(materialize(column_profile(rows, features), "profile"))
    return ModelData(rows, features, profile, range(first_validation_year, train_years[1] + 1))
