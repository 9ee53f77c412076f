"""Category rows per (area, year) -> wide counts, size buckets and per-capita rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.keys import category_label, pad_key, strip
from panelloom.functions.scalars import number_of, strict_int, sum_zero
from panelloom.operators.aggregates import sum_or_zero
from panelloom.operators.joins import join_many_to_one
from panelloom.operators.pivoting import add_rates, category_count, category_sums
from panelloom.session import materialize

# Size-bucket columns and the labels with a set name.
BUCKETS = [
    "emp_1_4", "emp_5_9", "emp_10_19", "emp_20_49", "emp_50_99", "emp_100_249", "emp_250_499",
    "emp_500_999", "emp_1000_plus",
]
CATEGORY_NAMES = {
    "Coffee Shops": "coffee_shops",
    "Fitness": "fitness",
    "Park": "parks",
    "Resturants": "restaurants",
    "Restaurants": "restaurants",
}


def clean_categories(raw: DataFrame) -> DataFrame:
    """Typed rows with a normalised category; a missing count is 0."""
    numbers = {c: F.coalesce(number_of(raw, c), F.lit(0.0)) for c in ["est", *BUCKETS]}
    typed = raw.select(
        pad_key(F.col("zip")).alias("zcta5"),
        strict_int(F.col("year"), "year").alias("year"),
        strip(F.col("amenities")).alias("amenity_type_raw"),
        category_label(F.col("amenities"), CATEGORY_NAMES).alias("amenity_type"),
        *[col.alias(c) for c, col in numbers.items()],
    )
    total = sum_zero([F.col(c) for c in BUCKETS])
    return typed.withColumns(
        {
            "amenity_employee_bucket_total": total,
            "amenity_est_bucket_gap": F.col("est") - total,
            "amenity_source_rows": F.lit(1),
        }
    )


def category_features(
    clean: DataFrame, population: DataFrame | None, categories: Sequence[str]
) -> DataFrame:
    """Totals, one column per category and bucket, and rates when a population is given.

    Totals, pivot and buckets share the key, so they are one aggregate. ``categories`` lists
    every category, as they are columns of the result; for an open set take the long form,
    ``pivoting.category_totals``.
    """
    values = list(categories)
    wide = clean.dropna(subset=["zcta5", "year"]).groupBy("zcta5", "year").agg(
        F.sum("amenity_source_rows").alias("amenity_source_rows"),
        category_count("amenity_type", values).alias("amenity_type_count"),
        F.sum("est").alias("amenity_est_total"),
        F.sum("amenity_employee_bucket_total").alias("amenity_employee_bucket_total"),
        F.sum("amenity_est_bucket_gap").alias("amenity_est_bucket_gap"),
        *category_sums("amenity_type", "est", values, "amenity_est_"),
        *[sum_or_zero(F.col(c)).alias(f"amenity_{c}") for c in BUCKETS],
    ).withColumn("amenities_observed", F.lit(True))
    if population is None:
        return wide.withColumn("amenities_population_for_rate", F.lit(None).cast("double"))
    people = population.select(
        "zcta5", "year", F.col("total_population").alias("amenities_population_for_rate")
    )
    # ``wide`` is grouped by the key, so only the population needs the check.
    joined = join_many_to_one(wide, people, ["zcta5", "year"], store=False)
    return add_rates(joined, "amenity_est_", "amenity_per_10k_", "amenities_population_for_rate", 10_000.0)


def build_category_pivot_features(
    raw: DataFrame, population: DataFrame | None, categories: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and the feature table, with a column for each of ``categories`` (cleaned names)."""
    clean = materialize(clean_categories(raw), "categories-clean")
    return clean, category_features(clean, population, categories)
