"""The feature jobs on rows that hold every edge case."""

import math

import pytest
from pyspark.sql import functions as F

from fixtures import (
    CRIME_COUNTS,
    DEMOGRAPHIC_COLUMNS,
    LISTING_COLUMNS,
    SCHOOL_COLUMNS,
    listing,
    text_frame,
)
from panelloom.operators.quality import DuplicateKeyError
from panelloom.plans.annual_panel import build_annual_panel
from panelloom.plans.category_pivot import BUCKETS, build_category_pivot_features
from panelloom.plans.composition import build_composition_features
from panelloom.plans.event_rates import build_event_rate_features
from panelloom.plans.rate_schedule import area_county_bridge, area_rates, build_rate_schedule_features
from panelloom.plans.relative_scores import build_relative_scores
from panelloom.session import materialize


@pytest.fixture(scope="module")
def listing_rows():
    rows = [
        # 2012: no usable weight, so the mean is plain; two months only.
        listing("9001", 2012, 1, MEDIAN_SALE_PRICE=100, HOMES_SOLD=0, INVENTORY=7, PARENT_METRO_REGION=None),
        listing("9001", 2012, 2, MEDIAN_SALE_PRICE=300, HOMES_SOLD=None, INVENTORY="", PARENT_METRO_REGION="LA"),
        # 2015 follows a gap.
        listing("9001", 2015, 1, MEDIAN_SALE_PRICE=500, HOMES_SOLD=2),
        # dropped rows: bad date, other type, unknown area
        {**listing("9001", 2012, 3, MEDIAN_SALE_PRICE=9), "PERIOD_END": "soon"},
        {**listing("9001", 2012, 4, MEDIAN_SALE_PRICE=9), "PROPERTY_TYPE": "Condo"},
        listing("5555", 2012, 5, MEDIAN_SALE_PRICE=9),
        # an area with nothing but missing prices
        listing(" 9003 ", 2012, 1, MEDIAN_SALE_PRICE="NaN", HOMES_SOLD="n/a"),
    ]
    for month in range(1, 13):  # two full years with weights 1 and 3
        rows.append(listing("9002", 2012, month, MEDIAN_SALE_PRICE=100 if month < 7 else 200, HOMES_SOLD=1 if month < 7 else 3, INVENTORY=month))
        rows.append(listing("9002", 2013, month, MEDIAN_SALE_PRICE=350, HOMES_SOLD=1))
    return rows


def _valid(spark):
    return spark.createDataFrame([("09001",), ("09002",), ("09003",)], "zcta5 string")


def test_annual_panel(spark, rows, listing_rows):
    annual, model = build_annual_panel(text_frame(spark, LISTING_COLUMNS, listing_rows), _valid(spark))
    assert len(annual.columns) == 27 and len(model.columns) == 27 + 8
    a = {(r["zcta5"], r["year"]): r for r in rows(annual)}
    assert set(a) == {("09001", 2012), ("09001", 2015), ("09002", 2012), ("09002", 2013), ("09003", 2012)}
    first = a["09001", 2012]
    assert first["annual_median_sale_price"] == 200.0 and first["annual_homes_sold"] == 0.0
    assert first["annual_months_of_supply_est"] is None and first["annual_inventory_end"] == 7.0
    assert (first["months_observed"], first["first_month"], first["last_month"]) == (2, 1, 2)
    assert first["parent_metro_region"] == "LA" and not first["full_year_coverage"]
    full = a["09002", 2012]
    assert full["annual_median_sale_price"] == pytest.approx(175.0)
    assert full["full_year_coverage"] and full["annual_homes_sold"] == 24.0
    assert full["annual_inventory_end"] == 12.0
    assert full["annual_months_of_supply_est"] == pytest.approx(6.5 / 2)
    empty = a["09003", 2012]
    assert empty["annual_median_sale_price"] is None and empty["annual_homes_sold"] is None
    assert empty["months_with_median_sale_price"] == 0 and empty["parent_metro_region"] is None

    m = {(r["zcta5"], r["year"]): r for r in rows(model)}
    assert set(m) == {("09001", 2012), ("09002", 2012), ("09002", 2013), ("09003", 2012)}  # 2015 is the last year
    good = m["09002", 2012]
    assert good["target_median_sale_price_pct_change_next_year"] == pytest.approx(1.0)
    assert good["target_median_sale_price_log_change_next_year"] == pytest.approx(math.log(2))
    assert good["baseline_model_eligible"] and good["target_next_year_complete"]
    gap = m["09001", 2012]
    assert gap["next_year_annual_median_sale_price"] is None
    assert (gap["has_next_year_target"], gap["target_next_year_complete"], gap["baseline_model_eligible"]) == (False,) * 3


def test_annual_panel_rejects_duplicates(spark, listing_rows):
    twice = [*listing_rows, listing_rows[0]]
    with pytest.raises(DuplicateKeyError, match="1 surplus"):
        build_annual_panel(text_frame(spark, LISTING_COLUMNS, twice), _valid(spark))


def test_composition(spark, rows):
    def person(key, **values):
        return {"year": 2012, "zcta5": key, "geo_id": "g", "zcta_name": "n", **dict.fromkeys(DEMOGRAPHIC_COLUMNS, 10), **values}

    raw = text_frame(
        spark, ["year", "zcta5", "geo_id", "zcta_name", *DEMOGRAPHIC_COLUMNS],
        [
            person("1", total_population=100, male_age_under_5=None, median_household_income=-666666666,
                   foreign_born_noncitizen=None, foreign_born_total=30, foreign_born_naturalized=10),
            person("2", total_population=0),
            person("3", total_population=None),
            person("4", total_population=50, education_25plus_total=0, foreign_born_noncitizen=None,
                   foreign_born_total=5, foreign_born_naturalized=9, education_25plus_masters=-999999999,
                   education_25plus_bachelors=-888888888,
                   **{f"{s}_age_{b}": None for s in ("male", "female") for b in ("25_to_29", "30_to_34")}),
        ],
    )
    clean, features = build_composition_features(raw)
    c = {r["zcta5"]: r for r in rows(clean)}
    assert len(c) == 4 and c["00003"]["population_nonzero"] is False
    assert c["00001"]["foreign_born_noncitizen"] == 20.0 and c["00001"]["foreign_born_noncitizen_derived"]
    assert c["00004"]["foreign_born_noncitizen"] is None and c["00004"]["foreign_born_noncitizen_derived"]
    assert c["00001"]["median_household_income_missing"] and not c["00004"]["demographics_baseline_eligible"]

    f = {r["zcta5"]: r for r in rows(features)}
    assert set(f) == {"00001", "00004"}
    assert f["00001"]["age_0_17_count"] == 70.0 and f["00001"]["age_0_17_share"] == pytest.approx(0.7)
    assert f["00001"]["log_total_population"] == pytest.approx(math.log(100))
    assert f["00001"]["log_median_household_income"] is None
    assert f["00001"]["foreign_born_noncitizen_share_of_foreign_born"] == pytest.approx(2 / 3)
    assert f["00004"]["age_25_34_count"] is None and f["00004"]["age_25_34_share"] is None
    assert f["00004"]["education_graduate_degree_count"] == 20.0
    assert f["00004"]["education_bachelors_or_higher_count"] is None
    assert f["00004"]["education_high_school_or_ged_share"] is None  # denominator 0


def test_relative_scores(spark, rows):
    def score(key, year, kind, ela, **values):
        return {"zcta5": key, "year": year, "assessment_type": kind, **dict.fromkeys(SCHOOL_COLUMNS, 5), "avg_pct_met_ela": ela, **values}

    raw = text_frame(
        spark, ["zcta5", "year", "assessment_type", *SCHOOL_COLUMNS],
        [
            score("1", 2014, "CAASPP", 10, total_students_tested=None), score("2", 2014, "CAASPP", 20, total_students_tested=0),
            score("3", 2014, "CAASPP", 20), score("4", 2014, "CAASPP", None, avg_pct_met_overall=None),
            score("1", 2015, None, 50), score("2", 2015, None, 70), score("9", 2014, "CAASPP", 99), score("1", "bad", "CST", 1),
        ],
    )
    valid = spark.createDataFrame([(f"0000{i}", y) for i in range(1, 5) for y in (2014, 2015)], "zcta5 string, year int")
    clean, features = build_relative_scores(raw, valid)
    assert clean.count() == 6 and "total_students_tested" not in features.columns
    f = {(r["zcta5"], r["year"]): r for r in rows(features)}
    sd = math.sqrt(200 / 9)
    z, pct = "avg_pct_met_ela_z_assessment_year", "avg_pct_met_ela_pct_assessment_year"
    assert f["00001", 2014][z] == pytest.approx((10 - 50 / 3) / sd)
    assert f["00001", 2014][pct] == pytest.approx(1 / 3) and f["00002", 2014][pct] == pytest.approx(2.5 / 3)
    assert f["00004", 2014][z] is None and f["00004", 2014][pct] is None
    assert f["00001", 2015][z] == pytest.approx(-1.0)  # the group without an assessment name
    assert f["00001", 2014]["avg_pct_met_math_z_assessment_year"] == 0.0
    assert [f[k, 2014]["total_students_tested_unreliable"] for k in ("00001", "00002", "00003")] == [True, True, False]
    assert not f["00001", 2014]["school_year_complete"] and f["00001", 2015]["school_year_complete"]
    assert not f["00004", 2014]["school_quality_extended_eligible"] and not f["00001", 2015]["is_caaspp"]
    assert f["00001", 2014]["log1p_n_schools"] == pytest.approx(math.log(6))


@pytest.fixture(scope="module")
def wage_tables(spark):
    wage = text_frame(
        spark, ["City", "County", "Year", "Minimum Wage", "Ordinance Type"],
        [
            {"City": " A ", "County": "Kern  County", "Year": 2016, "Minimum Wage": 10, "Ordinance Type": "State Law"},
            {"City": "B", "County": "Los  Angeles County", "Year": 2016, "Minimum Wage": 12, "Ordinance Type": "County Ordinance"},
            {"City": "C", "County": "Los Angeles", "Year": 2016, "Minimum Wage": 9, "Ordinance Type": "County Ordinance"},
            {"City": "B", "County": "Los Angeles County", "Year": 2017, "Minimum Wage": 10.5, "Ordinance Type": "County Ordinance"},
            {"City": "A", "County": "Kern", "Year": 2017, "Minimum Wage": 10.5, "Ordinance Type": "State Law"},
        ],
    )
    names = {"06029": "Kern County", "06037": "Los Angeles County", "06099": "Nowhere County", "32003": "Clark County"}

    def part(area, county, land, water=0):
        return {"GEOID_ZCTA5_20": area, "GEOID_COUNTY_20": county, "NAMELSAD_COUNTY_20": names[county], "AREALAND_PART": land, "AREAWATER_PART": water}

    bridge = text_frame(
        spark, ["GEOID_ZCTA5_20", "GEOID_COUNTY_20", "NAMELSAD_COUNTY_20", "AREALAND_PART", "AREAWATER_PART"],
        [
            part("90001", "06037", 100), part("90001", "32003", 900),
            part("90002", "06029", 85), part("90002", "06037", 15),
            part("90003", "06029", 40), part("90003", "06037", 35), part("90003", "06099", 25),
            part("90004", "06029", 0, 30), part("90004", "06037", 0, 10),
            part("90005", "06029", 0, 0), part("90006", "06037", 50), part("90006", "06029", 50),
            part(None, "06037", 5),
        ],
    )
    return wage, bridge


def test_bridge(spark, rows, wage_tables):
    out = {(r["zcta5"], r["county_fips"]): r for r in rows(area_county_bridge(wage_tables[1]))}
    share, quality = "zcta_county_area_share", "zcta_county_assignment_quality"
    assert out["90001", "06037"][share] == 1.0 and out["90001", "06037"][quality] == "single_county"
    assert out["90002", "06029"][share] == 0.85 and out["90002", "06029"][quality] == "dominant_county_ge_80pct"
    assert out["90003", "06099"]["county_rank_in_zcta"] == 3
    assert out["90003", "06029"][quality] == "multi_county_low_dominance"
    assert out["90004", "06029"][share] == 0.75 and out["90004", "06037"]["dominant_county_share"] == 0.75
    assert out["90005", "06029"][share] is None and out["90005", "06029"]["is_dominant_county"]
    assert out["90006", "06029"]["is_dominant_county"] and not out["90006", "06037"]["is_dominant_county"]
    assert not [k for k in out if k[0] is None or k[1].startswith("32")]


def test_rate_schedule(spark, rows, wage_tables):
    tables = build_rate_schedule_features(*wage_tables)
    clean = rows(tables["clean"])
    assert len(clean) == 5 + 3 * 4 and sum(r["minimum_wage_backfilled"] for r in clean) == 12
    assert {r["county"] for r in clean} == {"Kern", "Los Angeles"}
    f = {(r["zcta5"], r["year"]): r for r in rows(tables["features"])}
    assert len(f) == 6 * 6 and len(tables["features"].columns) == 26
    mean_2014 = (8.0 * 181 + 9.0 * 184) / 365
    assert f["90001", 2014]["minimum_wage_for_model_annual_avg"] == pytest.approx(mean_2014)
    assert f["90001", 2014]["minimum_wage_for_model_year_start"] == 8.0 and f["90001", 2014]["minimum_wage_imputed"]
    assert f["90001", 2014]["state_minimum_wage_source"] == "california_dir_history_backfill"
    assert f["90001", 2016]["minimum_wage_for_model_annual_avg"] == 12.0
    assert f["90001", 2016]["dominant_county_ordinance_above_state"] and not f["90001", 2016]["minimum_wage_imputed"]
    assert f["90001", 2017]["dominant_county_ordinance_record"]
    assert not f["90001", 2017]["dominant_county_ordinance_above_state"]  # equal to the state rate
    two = f["90002", 2016]
    assert two["minimum_wage_county_area_weighted_annual_avg"] == pytest.approx(0.85 * 10 + 0.15 * 12)
    assert two["minimum_wage_area_weighted_diff_annual_avg"] == pytest.approx(0.3)
    assert two["any_county_ordinance_above_state"] and two["minimum_wage_dominant_county_geo_level"] == "State Law"
    # A county without rates drops out of the mix, and an area without a share adds up to zero.
    assert f["90003", 2016]["minimum_wage_county_area_weighted_annual_avg"] == pytest.approx(0.4 * 10 + 0.35 * 12)
    assert f["90005", 2016]["minimum_wage_county_area_weighted_annual_avg"] == 0.0


def test_rate_schedule_reads_the_bridge_once_and_collects_no_years(wage_tables, monkeypatch):
    tables = build_rate_schedule_features(*wage_tables)
    kind = type(tables["clean"])

    def refused(self, *args):
        raise AssertionError("rows on the driver")

    with monkeypatch.context() as patch:
        patch.setattr(kind, "collect", refused)
        patch.setattr(kind, "first", refused)
        features = area_rates(materialize(tables["bridge"], "bridge"), tables["county_year"])
    text = features._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("county_fips#") and text.count("Relation [zcta5#") == 1  # one scan of the bridge
    assert text.count("Join") == 1  # its counties' rates; the dominant row comes out of the aggregate


def test_schedule_without_earlier_years(spark, rows, wage_tables):
    clean = rows(build_rate_schedule_features(*wage_tables, early={})["clean"])
    assert len(clean) == 5 and not any(r["minimum_wage_backfilled"] for r in clean)


def test_event_rates(spark, rows):
    def crime(key, county, population, value):
        return {"Zipcode": key, "County": county, "Year": 2015, "Population": 1, "total_population": population, "Ratio": 0.5,
                "Total_Crime": 3, **dict.fromkeys(CRIME_COUNTS, value)}

    raw = text_frame(
        spark, ["Zipcode", "County", "Year", "Population", "total_population", "Ratio", "Total_Crime", *CRIME_COUNTS],
        [crime("1", "Kern County", 1000, 2), crime("1", "Alpine", 500, 3), crime("1", "Kern", None, 1), crime("2", "Kern", 0, None)],
    )
    clean, features = build_event_rate_features(raw)
    assert clean.count() == 4
    f = {r["zcta5"]: r for r in rows(features)}
    one, two = f["00001"], f["00002"]
    assert one["crime_counties"] == "Alpine; Kern" and one["crime_county_count"] == 2 and one["crime_multi_county_zcta"]
    assert one["crime_source_rows"] == 3 and one["crime_population_for_rate"] == 1000.0
    assert one["crime_index_est"] == 12.0 and one["crime_violent_est_per_1k"] == 6.0
    assert one["log1p_crime_violent_est"] == pytest.approx(math.log(7))
    assert one["violent_component_rounding_gap"] == 18.0 and one["property_component_rounding_gap"] == 12.0
    assert two["crime_violent_est"] == 0.0 and two["crime_violent_est_per_1k"] is None
    assert two["crime_has_zero_or_missing_population"] and two["crime_observed"] and not two["crime_multi_county_zcta"]


def test_category_pivot(spark, rows):
    def amenity(key, kind, est, **buckets):
        return {"zip": key, "year": 2015, "amenities": kind, "est": est, **buckets}

    raw = text_frame(
        spark, ["zip", "year", "amenities", "est", *BUCKETS],
        [amenity("1", "Resturants", 4, emp_1_4=3), amenity("1", " Restaurants ", 6, emp_5_9=6), amenity("1", "Bars & Pubs", "x"), amenity("2", "Park", 5)],
    )
    people = spark.createDataFrame([("00001", 2015, 2000.0)], "zcta5 string, year int, total_population double")
    _, features = build_category_pivot_features(raw, people, ["bars_and_pubs", "parks", "restaurants"])
    f = {r["zcta5"]: r for r in rows(features)}
    one, two = f["00001"], f["00002"]
    assert one["amenity_est_restaurants"] == 10.0 and one["amenity_est_parks"] == 0.0 and one["amenity_est_total"] == 10.0
    assert one["amenity_type_count"] == 2 and one["amenity_source_rows"] == 3
    assert one["amenity_per_10k_restaurants"] == 50.0 and one["amenity_per_10k_total"] == 50.0
    assert one["amenity_est_bucket_gap"] == 1.0 and one["amenity_per_10k_bucket_gap"] == 5.0
    assert one["amenity_est_bars_and_pubs"] == 0.0 and one["amenity_emp_1_4"] == 3.0
    assert two["amenity_per_10k_parks"] is None and two["amenities_population_for_rate"] is None
    _, bare = build_category_pivot_features(raw, None, ["parks"])
    assert not [c for c in bare.columns if c.startswith("amenity_per_10k_")]
    assert bare.filter(F.col("amenities_population_for_rate").isNotNull()).count() == 0
