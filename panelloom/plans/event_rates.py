"""Estimated yearly counts per (area, county) -> area totals, rates and logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.keys import pad_key, strip_suffix_word
from panelloom.functions.scalars import known, log1p, number_of, positive, rate_per, strict_int
from panelloom.operators.aggregates import sorted_text, sum_or_zero

# Source count columns and the names of their totals.
COUNTS = {
    "est_Violent_Crime_Total": "crime_violent_est",
    "est_Homicide_Total": "crime_homicide_est",
    "est_Rape_Total": "crime_rape_est",
    "est_Robbery_sum": "crime_robbery_est",
    "est_Aggravated_Assaults_Total": "crime_aggravated_assault_est",
    "est_Property_Crime_Total": "crime_property_est",
    "est_Burglary_Total": "crime_burglary_est",
    "est_Vehicle_Theft_Crime_Total": "crime_vehicle_theft_est",
    "est_Larceny_Thefts_Total": "crime_larceny_theft_est",
}
MEASURES = {
    "Population": "county_population_source",
    "total_population": "crime_population_for_rate",
    "Ratio": "crime_allocation_ratio",
    "Total_Crime": "source_total_crime_double_counted",
}
VIOLENT_PARTS = ["est_Homicide_Total", "est_Rape_Total", "est_Robbery_sum", "est_Aggravated_Assaults_Total"]
PROPERTY_PARTS = ["est_Burglary_Total", "est_Vehicle_Theft_Crime_Total", "est_Larceny_Thefts_Total"]


def clean_counts(raw: DataFrame) -> DataFrame:
    """Typed counts with the index and the rounding gaps of the component sums."""
    typed = raw.select(
        pad_key(F.col("Zipcode")).alias("zcta5"),
        strict_int(F.col("Year"), "year").alias("year"),
        strip_suffix_word(F.col("County")).alias("county"),
        *[number_of(raw, c).alias(name) for c, name in MEASURES.items()],
        *[number_of(raw, c).alias(c) for c in COUNTS],
    )
    violent, property_ = F.col("est_Violent_Crime_Total"), F.col("est_Property_Crime_Total")
    return typed.withColumns(
        {
            "crime_index_est": violent + property_,
            "violent_component_rounding_gap": sum((F.col(c) for c in VIOLENT_PARTS[1:]), F.col(VIOLENT_PARTS[0]))
            - violent,
            "property_component_rounding_gap": sum(
                (F.col(c) for c in PROPERTY_PARTS[1:]), F.col(PROPERTY_PARTS[0])
            )
            - property_,
            "crime_source_rows": F.lit(1),
        }
    )


def area_totals(
    df: DataFrame, keys: list[str], unit: str, sums: Mapping[str, str], maxima: Mapping[str, str],
    unit_count: str, unit_list: str,
) -> DataFrame:
    """Sums, maxima and the distinct units of each key.

    Two levels: rows collapse to (key, unit) first, so the unit list is built from distinct
    units and the wide sums stay in a hash aggregate.
    """
    by_unit = df.dropna(subset=keys).groupBy(*keys, unit).agg(
        *[F.sum(c).alias(name) for c, name in sums.items()],
        *[F.max(c).alias(name) for c, name in maxima.items()],
    )
    return by_unit.groupBy(*keys).agg(
        *[sum_or_zero(F.col(name)).alias(name) for name in sums.values()],
        *[F.max(name).alias(name) for name in maxima.values()],
        F.count(unit).alias(unit_count),
        sorted_text(F.col(unit)).alias(unit_list),
    )


def add_rates_and_logs(df: DataFrame, counts: list[str], population: str, per: float = 1000.0) -> DataFrame:
    """A rate and a log1p for every count."""
    return df.withColumns(
        {f"{c}_per_1k": rate_per(F.col(c), F.col(population), per) for c in counts}
        | {f"log1p_{c}": log1p(F.col(c)) for c in counts}
    )


def build_event_rate_features(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and the feature table."""
    clean = clean_counts(raw)
    sums = {
        "crime_source_rows": "crime_source_rows",
        "crime_allocation_ratio": "crime_allocation_ratio_sum",
        "source_total_crime_double_counted": "crime_source_total_double_counted_sum",
        "violent_component_rounding_gap": "violent_component_rounding_gap",
        "property_component_rounding_gap": "property_component_rounding_gap",
        "crime_index_est": "crime_index_est",
        **COUNTS,
    }
    population = "crime_population_for_rate"
    totals = area_totals(
        clean, ["zcta5", "year"], "county", sums, {population: population}, "crime_county_count", "crime_counties"
    ).withColumns(
        {"crime_observed": F.lit(True), "crime_multi_county_zcta": known(F.col("crime_county_count") > 1)}
    )
    features = add_rates_and_logs(totals, ["crime_index_est", *COUNTS.values()], population)
    return clean, features.withColumn(
        "crime_has_zero_or_missing_population", positive(F.col(population)).isNull()
    )
