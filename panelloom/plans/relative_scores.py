"""Yearly assessment scores -> flags, z-scores and percentile ranks per assessment and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.keys import pad_key
from panelloom.functions.scalars import int_or_null, known, log1p, not_in, number_of
from panelloom.operators.groups import zscore
from panelloom.operators.joins import key_filter
from panelloom.operators.ordering import percent_rank_average
from panelloom.session import materialize

# Measure columns, the scored ones, and the years without a full assessment.
MEASURES = [
    "n_schools", "avg_pct_met_ela", "avg_pct_met_math", "avg_pct_met_overall", "median_pct_met_overall",
    "min_pct_met_overall", "max_pct_met_overall", "total_students_tested",
]
SCORED = ["avg_pct_met_ela", "avg_pct_met_math", "avg_pct_met_overall", "median_pct_met_overall"]
INCOMPLETE_YEARS = [2014, 2020]


def clean_scores(raw: DataFrame, valid_keys: DataFrame) -> DataFrame:
    """Typed scores of the valid (area, year) keys with their flags."""
    typed = raw.select(
        pad_key(F.col("zcta5")).alias("zcta5"),
        int_or_null(F.col("year")).alias("year"),
        "assessment_type",
        *[number_of(raw, c).alias(c) for c in MEASURES],
    )
    tested = F.col("total_students_tested")
    return key_filter(typed, valid_keys, ["zcta5", "year"]).withColumns(
        {
            "is_caaspp": known(F.col("assessment_type") == "CAASPP"),
            "is_cst": known(F.col("assessment_type") == "CST"),
            "school_year_complete": not_in(F.col("year"), INCOMPLETE_YEARS),
            "total_students_tested_reported_positive": known(tested > 0),
            "total_students_tested_unreliable": F.coalesce(tested, F.lit(0.0)) == 0,
            "overall_score_range": F.col("max_pct_met_overall") - F.col("min_pct_met_overall"),
            "school_quality_extended_eligible": F.col("avg_pct_met_overall").isNotNull(),
        }
    )


def build_relative_scores(raw: DataFrame, valid_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, written once because every score reads it, and the feature table."""
    clean = materialize(clean_scores(raw, valid_keys), "scores-clean")
    group = ["assessment_type", "year"]
    # Ranks first: they read the stored table, not the joins of the scores.
    ranked = percent_rank_average(clean, group, {c: f"{c}_pct_assessment_year" for c in SCORED})
    scored = zscore(ranked, group, {c: f"{c}_z_assessment_year" for c in SCORED})
    return clean, scored.withColumn("log1p_n_schools", log1p(F.col("n_schools"))).drop("total_students_tested")
