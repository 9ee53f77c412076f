"""Local and state-wide rates by year -> area-level rates over an area-to-county bridge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.keys import has_prefix, pad_key, strip, strip_suffix_word
from panelloom.functions.scalars import first_label, known, number_of, strict_int, strict_number
from panelloom.operators.aggregates import sum_or_zero
from panelloom.operators.groups import with_group_values
from panelloom.operators.joins import in_periods, join_many_to_one
from panelloom.operators.ordering import number_rows
from panelloom.operators.rowsets import keep_by_priority, union_same
from panelloom.session import materialize
from panelloom.sources.readers import literal_table

# State-wide yearly rates before the first input year, as (start of year, yearly average).
EARLY_RATES = {
    2012: (8.00, 8.00),
    2013: (8.00, 8.00),
    2014: (8.00, (8.00 * 181 + 9.00 * 184) / 365),
    2015: (9.00, 9.00),
}
STATE_LAW = "State Law"
COUNTY_LAW = "County Ordinance"
STATE_PREFIX = "06"
DOMINANT_SHARE = 0.8

_RATES = ["minimum_wage_year_start", "minimum_wage_annual_avg"]
_STATE_RATES = [f"state_{c}" for c in _RATES]


def clean_rates(raw: DataFrame) -> DataFrame:
    """Typed (city, county, year) rates; bad years and rates fail the job."""
    start = strict_number(F.col("Minimum Wage"))
    return raw.select(
        strip(F.col("City")).alias("city"),
        strip_suffix_word(F.col("County")).alias("county"),
        strict_int(F.col("Year"), "year").alias("year"),
        start.alias("minimum_wage_year_start"),
        start.alias("minimum_wage_annual_avg"),
        F.col("Ordinance Type").alias("ordinance_type"),
        F.lit(False).alias("minimum_wage_backfilled"),
        F.lit("input_minimum_wage_updated").alias("minimum_wage_source_detail"),
    )


def state_schedule(
    spark: SparkSession, rates: DataFrame, early: Mapping[int, tuple[float, float]] = EARLY_RATES
) -> DataFrame:
    """One state-wide rate per year; the constants win over the input for the same year.

    Among several state-law rows of a year the first by (county, city) counts.
    """
    constants = literal_table(
        spark,
        [(y, *pair) for y, pair in early.items()],
        f"year int, {_RATES[0]} double, {_RATES[1]} double",
    )
    by_place = F.when(F.col(_RATES[0]).isNotNull(), F.struct("county", "city"))
    given = (
        rates.filter(F.col("ordinance_type") == STATE_LAW)
        .groupBy("year")
        .agg(F.min_by(_RATES[0], by_place).alias(_RATES[0]))
        .withColumn(_RATES[1], F.col(_RATES[0]))
    )
    both = union_same(
        constants.withColumn("_rank", F.lit(0)), given.withColumn("_rank", F.lit(1))
    )
    first_input = rates.agg(F.min("year")).scalar()
    return (
        keep_by_priority(both, ["year"], F.col("_rank"))
        .drop("_rank")
        .withColumnsRenamed(dict(zip(_RATES, _STATE_RATES)))
        .withColumn(
            "state_minimum_wage_source",
            first_label(
                [(F.col("year") < first_input, "california_dir_history_backfill")], "input_state_law_rows"
            ),
        )
    )


def backfill_rates(rates: DataFrame, schedule: DataFrame) -> DataFrame:
    """Add the state-wide rate of the years before the first input year to every place."""
    first_input = rates.agg(F.min("year")).scalar()
    early = schedule.filter(F.col("year") < first_input)
    places = rates.select("city", "county").distinct()
    given = early.select("year", *[F.col(f"state_{c}").alias(c) for c in _RATES])
    filled = in_periods(places, early, "year").join(given, "year").withColumns(
        {
            "ordinance_type": F.lit(STATE_LAW),
            "minimum_wage_backfilled": F.lit(True),
            "minimum_wage_source_detail": F.lit("state_law_backfill_pre_input_years"),
        }
    )
    return union_same(filled.select(*rates.columns), rates)


def county_year_rates(clean: DataFrame, schedule: DataFrame) -> DataFrame:
    """The effective rate of every county and schedule year: the higher of state and county."""
    ordinances = (
        clean.filter(F.col("ordinance_type") == COUNTY_LAW)
        .groupBy("county", "year")
        .agg(
            F.max(_RATES[0]).alias("county_ordinance_wage_year_start"),
            F.max(_RATES[1]).alias("county_ordinance_wage_annual_avg"),
            F.count_distinct("city").alias("county_ordinance_city_rows"),
        )
    )
    grid = in_periods(clean.select("county").distinct(), schedule, "year")
    first_input = clean.filter(~F.col("minimum_wage_backfilled")).agg(F.min("year")).scalar()
    state, local = F.col("state_minimum_wage_annual_avg"), F.col("county_ordinance_wage_annual_avg")
    joined = join_many_to_one(
        grid.join(ordinances, ["county", "year"], "left"), schedule, ["year"], unique=True, store=False
    )
    effective = F.greatest(state, local)
    return joined.withColumns(
        {
            "effective_minimum_wage_year_start": F.greatest(
                "state_minimum_wage_year_start", "county_ordinance_wage_year_start"
            ),
            "effective_minimum_wage_annual_avg": effective,
            "county_ordinance_record": F.col("county_ordinance_wage_year_start").isNotNull(),
            "county_ordinance_above_state": known(local > state),
            "minimum_wage_geo_level": first_label([(known(local > state), COUNTY_LAW)], STATE_LAW),
            "local_minimum_wage_premium_annual_avg": effective - state,
            "minimum_wage_backfilled": known(F.col("year") < first_input),
        }
    )


def rank_bridge(
    parts: DataFrame, area: str, unit: str, primary: str, fallback: str
) -> DataFrame:
    """Share, rank and assignment quality of every (area, unit) part.

    The share is of ``primary``; an area whose primary parts are all zero uses
    primary + fallback. Group figures are one partially aggregated pass.
    """
    both = F.col(primary) + F.col(fallback)
    grouped = with_group_values(
        parts,
        [area],
        {
            "_primary": F.sum(primary),
            "_both": F.sum(both),
            "_top_primary": F.max(primary),
            "_top_both": F.max(both),
            "unit_count": F.count_distinct(unit),
        },
    )
    bare = F.col("_primary") == 0
    total = F.when(bare, F.col("_both")).otherwise(F.col("_primary"))
    part = F.when(bare, both).otherwise(F.col(primary))
    top = F.when(bare, F.col("_top_both")).otherwise(F.col("_top_primary"))
    grouped = grouped.withColumn("share", F.when(total > 0, part / total)).withColumn(
        "dominant_share", F.when(total > 0, top / total)
    )
    grouped = grouped.drop("_primary", "_both", "_top_primary", "_top_both")
    ranked = number_rows(grouped, [area], [F.col("share").desc_nulls_last(), F.col(unit).asc()], "unit_rank")
    return ranked.withColumns(
        {
            "is_dominant": F.col("unit_rank") == 1,
            "assignment_quality": first_label(
                [
                    (F.col("unit_count") == 1, "single_county"),
                    (known(F.col("dominant_share") >= DOMINANT_SHARE), "dominant_county_ge_80pct"),
                ],
                "multi_county_low_dominance",
            ),
        }
    )


def area_county_bridge(raw: DataFrame, prefix: str = STATE_PREFIX) -> DataFrame:
    """The area-to-county bridge of one state, from the relationship file."""
    rows = raw.filter(F.col("GEOID_ZCTA5_20").isNotNull() & has_prefix(F.col("GEOID_COUNTY_20"), prefix))
    parts = rows.select(
        pad_key(F.col("GEOID_ZCTA5_20")).alias("zcta5"),
        pad_key(F.col("GEOID_COUNTY_20")).alias("county_fips"),
        strip_suffix_word(F.col("NAMELSAD_COUNTY_20")).alias("county"),
        F.coalesce(number_of(rows, "AREALAND_PART"), F.lit(0.0)).alias("_land"),
        F.coalesce(number_of(rows, "AREAWATER_PART"), F.lit(0.0)).alias("_water"),
    )
    parts = materialize(parts, "bridge-parts")
    return rank_bridge(parts, "zcta5", "county_fips", "_land", "_water").select(
        "zcta5", "county_fips", "county",
        F.col("share").alias("zcta_county_area_share"),
        F.col("unit_count").alias("zcta_county_count"),
        F.col("unit_rank").alias("county_rank_in_zcta"),
        F.col("is_dominant").alias("is_dominant_county"),
        F.col("dominant_share").alias("dominant_county_share"),
        F.col("assignment_quality").alias("zcta_county_assignment_quality"),
    )


def area_rates(bridge: DataFrame, county_year: DataFrame) -> DataFrame:
    """Yearly rate of every area: its dominant county's, with the area-weighted mix beside it.

    The bridge is read once: the aggregate that mixes the counties of an area also carries the row of the dominant one.
    """
    county_year = materialize(county_year, "county-year")
    by_year = join_many_to_one(
        in_periods(bridge, county_year, "year"), county_year, ["county", "year"], unique=True, store=False
    )
    share = F.col("zcta_county_area_share")
    carried = [c for c in by_year.columns if c not in ("zcta5", "year")]
    # An unmatched county drops out of the sum without re-weighting the others.
    mixed = by_year.groupBy("zcta5", "year").agg(
        *[
            sum_or_zero(F.col(f"effective_{c}") * share).alias(
                c.replace("minimum_wage", "minimum_wage_county_area_weighted")
            )
            for c in _RATES
        ],
        F.bool_or("county_ordinance_record").alias("any_county_ordinance_record"),
        F.bool_or("county_ordinance_above_state").alias("any_county_ordinance_above_state"),
        F.any_value(F.when(F.col("is_dominant_county"), F.struct(*carried)), True).alias("_dominant"),
    )
    dominant = mixed.filter("_dominant IS NOT NULL").select("*", "_dominant.*").drop("_dominant").withColumnsRenamed(
        {
            "county": "dominant_county",
            "county_fips": "dominant_county_fips",
            "effective_minimum_wage_year_start": "minimum_wage_dominant_county_year_start",
            "effective_minimum_wage_annual_avg": "minimum_wage_dominant_county_annual_avg",
            "minimum_wage_geo_level": "minimum_wage_dominant_county_geo_level",
            "county_ordinance_record": "dominant_county_ordinance_record",
            "county_ordinance_above_state": "dominant_county_ordinance_above_state",
            "minimum_wage_backfilled": "minimum_wage_imputed",
        }
    )
    average = F.col("minimum_wage_dominant_county_annual_avg")
    feature = dominant.withColumns(
        {
            "minimum_wage_feature_method": F.lit("dominant_county_with_area_weighted_check"),
            "minimum_wage_for_model_annual_avg": average,
            "minimum_wage_for_model_year_start": F.col("minimum_wage_dominant_county_year_start"),
            "minimum_wage_local_premium_for_model_annual_avg": average - F.col("state_minimum_wage_annual_avg"),
            "minimum_wage_area_weighted_diff_annual_avg": (
                F.col("minimum_wage_county_area_weighted_annual_avg") - average
            ),
        }
    )
    return feature.drop(
        "county_rank_in_zcta", "is_dominant_county", "county_ordinance_wage_year_start",
        "county_ordinance_wage_annual_avg", "county_ordinance_city_rows",
        "local_minimum_wage_premium_annual_avg",
    )


def build_rate_schedule_features(
    raw_rates: DataFrame, raw_bridge: DataFrame, early: Mapping[int, tuple[float, float]] = EARLY_RATES
) -> dict[str, DataFrame]:
    """Cleaned rates, county-year rates, bridge and area-level features.

    The typed rates and the schedule feed several later steps, so each is written once.
    """
    rates = materialize(clean_rates(raw_rates), "rates")
    schedule = materialize(state_schedule(raw_rates.sparkSession, rates, early), "schedule")
    clean = backfill_rates(rates, schedule)
    county_year = county_year_rates(clean, schedule)
    bridge = area_county_bridge(raw_bridge)
    return {
        "clean": clean,
        "county_year": county_year,
        "bridge": bridge,
        "features": area_rates(bridge, county_year),
    }
