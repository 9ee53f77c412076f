"""Yearly demographic counts -> cleaned table -> shares and logs.

Both tables are projections of the source row: no exchange at all. The cleaned table is an
output of the job, so the features read it back typed instead of parsing every text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.keys import pad_key
from panelloom.functions.scalars import (
    fill_from_difference,
    known,
    log_positive,
    non_negative,
    number_of,
    safe_divide,
    sentinels_to_null,
    strict_int,
    sum_any,
)
from panelloom.session import materialize

# Identifier columns, special missing codes and the source columns of each bucket.
ID_COLUMNS = ["year", "zcta5", "geo_id", "zcta_name"]
SPECIAL_MISSING = [-666666666, -888888888, -999999999]
AGE_BANDS = {
    "age_0_17": ["under_5", "5_to_9", "10_to_14", "15_to_17"],
    "age_18_24": ["18_to_19", "20", "21", "22_to_24"],
    "age_25_34": ["25_to_29", "30_to_34"],
    "age_35_44": ["35_to_39", "40_to_44"],
    "age_45_64": ["45_to_49", "50_to_54", "55_to_59", "60_to_61", "62_to_64"],
    "age_65_plus": ["65_to_66", "67_to_69", "70_to_74", "75_to_79", "80_to_84", "85_plus"],
}
EDUCATION_LEVELS = {
    "education_less_than_high_school": [
        "no_schooling", "nursery_school", "kindergarten", "grade_1", "grade_2", "grade_3", "grade_4",
        "grade_5", "grade_6", "grade_7", "grade_8", "grade_9", "grade_10", "grade_11",
        "grade_12_no_diploma",
    ],
    "education_high_school_or_ged": ["high_school_diploma", "ged"],
    "education_some_college_or_associates": [
        "some_college_less_than_1_year", "some_college_1plus_years_no_degree", "associates",
    ],
    "education_bachelors": ["bachelors"],
    "education_graduate_degree": ["masters", "professional_school", "doctorate"],
}
POPULATION_SHARES = [
    "native_born_in_state", "native_born_other_state_us", "foreign_born_total",
    "foreign_born_naturalized", "foreign_born_noncitizen",
    "race_white_alone", "race_black_alone", "race_american_indian_or_alaska_native_alone",
    "race_asian_alone", "race_native_hawaiian_or_pacific_islander_alone",
    "race_some_other_race_alone", "race_two_or_more", "hispanic_or_latino_total",
]


def clean_composition(raw: DataFrame) -> DataFrame:
    """Typed counts with special codes removed, the derived part filled and row flags set."""
    measures = [c for c in raw.columns if c not in ID_COLUMNS]
    typed = raw.select(
        strict_int(F.col("year"), "year").alias("year"),
        pad_key(F.col("zcta5")).alias("zcta5"),
        *[c for c in ID_COLUMNS[2:] if c in raw.columns],
        *[sentinels_to_null(number_of(raw, c), SPECIAL_MISSING).alias(c) for c in measures],
    )
    part, derived = fill_from_difference(
        F.col("foreign_born_noncitizen"), F.col("foreign_born_total"), F.col("foreign_born_naturalized")
    )
    populated = known(F.col("total_population") > 0)
    # The flag looks at the filled value before the guard: a negative difference ends as
    # NULL and still counts as derived.
    return typed.withColumns(
        {
            "foreign_born_noncitizen_derived": derived,
            "foreign_born_noncitizen": non_negative(part),
            "population_nonzero": populated,
            "median_household_income_missing": F.col("median_household_income").isNull(),
            "demographics_baseline_eligible": populated & known(F.col("education_25plus_total") > 0),
        }
    )


def composition_features(clean: DataFrame) -> DataFrame:
    """Logs, bucket counts and shares of the populated rows."""
    population = F.col("total_population")
    adults = F.col("education_25plus_total")
    foreign = F.col("foreign_born_total")

    counts = {
        bucket: sum_any([F.col(f"{sex}_age_{band}") for sex in ("male", "female") for band in bands])
        for bucket, bands in AGE_BANDS.items()
    }
    levels = {
        level: sum_any([F.col(f"education_25plus_{part}") for part in parts])
        for level, parts in EDUCATION_LEVELS.items()
    }
    levels["education_bachelors_or_higher"] = (
        levels["education_bachelors"] + levels["education_graduate_degree"]
    )
    out = {
        "log_total_population": log_positive(population),
        "log_median_household_income": log_positive(F.col("median_household_income")),
        "male_share": safe_divide(F.col("male_total"), population),
        "female_share": safe_divide(F.col("female_total"), population),
    }
    for name, count in counts.items():
        out |= {f"{name}_count": count, f"{name}_share": safe_divide(count, population)}
    for name, count in levels.items():
        out |= {f"{name}_count": count, f"{name}_share": safe_divide(count, adults)}
    out |= {f"{c}_share": safe_divide(F.col(c), population) for c in POPULATION_SHARES}
    out |= {
        f"foreign_born_{part}_share_of_foreign_born": safe_divide(F.col(f"foreign_born_{part}"), foreign)
        for part in ("naturalized", "noncitizen")
    }
    for origin in ("born_other_state_25plus", "foreign_born_25plus"):
        total = F.col(f"{origin}_total")
        degrees = F.col(f"{origin}_bachelors") + F.col(f"{origin}_graduate_degree")
        out |= {
            f"{origin}_share": safe_divide(total, adults),
            f"{origin}_bachelors_or_higher_count": degrees,
            f"{origin}_bachelors_or_higher_share": safe_divide(degrees, total),
        }
    kept = [
        *ID_COLUMNS, "total_population", "median_household_income", "median_household_income_missing",
        "education_25plus_total", "foreign_born_total", "foreign_born_noncitizen_derived",
        "demographics_baseline_eligible",
    ]
    return clean.filter("population_nonzero").select(
        *[c for c in kept if c in clean.columns], *[col.alias(name) for name, col in out.items()]
    )


def build_composition_features(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and the feature table."""
    clean = materialize(clean_composition(raw), "composition-clean")
    return clean, composition_features(clean)
