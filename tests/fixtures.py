"""Small raw tables with the layouts the jobs read, text as a file would hold it."""

from __future__ import annotations

import random

from panelloom.plans.category_pivot import BUCKETS
from panelloom.plans.composition import AGE_BANDS, EDUCATION_LEVELS

LISTING_COLUMNS = [
    "REGION", "YEAR", "PROPERTY_TYPE", "PARENT_METRO_REGION", "PERIOD_END", "MEDIAN_SALE_PRICE",
    "MEDIAN_LIST_PRICE", "MEDIAN_PPSF", "MEDIAN_LIST_PPSF", "HOMES_SOLD", "PENDING_SALES", "NEW_LISTINGS",
    "INVENTORY", "OFF_MARKET_IN_TWO_WEEKS", "AVG_SALE_TO_LIST", "SOLD_ABOVE_LIST", "MEDIAN_DOM",
]

DEMOGRAPHIC_COLUMNS = [
    "total_population", "male_total", "female_total", "median_household_income",
    *[f"{s}_age_{b}" for s in ("male", "female") for bands in AGE_BANDS.values() for b in bands],
    "education_25plus_total",
    *[f"education_25plus_{p}" for parts in EDUCATION_LEVELS.values() for p in parts],
    "foreign_born_total", "foreign_born_naturalized", "foreign_born_noncitizen", "native_born_in_state",
    "native_born_other_state_us", "born_other_state_25plus_total", "born_other_state_25plus_bachelors",
    "born_other_state_25plus_graduate_degree", "foreign_born_25plus_total", "foreign_born_25plus_bachelors",
    "foreign_born_25plus_graduate_degree", "race_white_alone", "race_black_alone",
    "race_american_indian_or_alaska_native_alone", "race_asian_alone",
    "race_native_hawaiian_or_pacific_islander_alone", "race_some_other_race_alone", "race_two_or_more",
    "hispanic_or_latino_total",
]

CRIME_COUNTS = [
    "est_Violent_Crime_Total", "est_Homicide_Total", "est_Rape_Total", "est_Robbery_sum",
    "est_Aggravated_Assaults_Total", "est_Property_Crime_Total", "est_Burglary_Total",
    "est_Vehicle_Theft_Crime_Total", "est_Larceny_Thefts_Total",
]
SCHOOL_COLUMNS = [
    "n_schools", "avg_pct_met_ela", "avg_pct_met_math", "avg_pct_met_overall", "median_pct_met_overall",
    "min_pct_met_overall", "max_pct_met_overall", "total_students_tested",
]


def text_frame(spark, columns, records):
    """Records (dicts) as an all-text table; absent entries are NULL."""
    data = [tuple(None if r.get(c) is None else str(r[c]) for c in columns) for r in records]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def listing(region, year, month, **values):
    day = {2: 28, 4: 30, 6: 30, 9: 30, 11: 30}.get(month, 31)
    return {
        "REGION": region, "YEAR": year, "PROPERTY_TYPE": "All Residential",
        "PERIOD_END": f"{year}-{month:02d}-{day}", **values,
    }


def raw_world(spark, areas=12, years=range(2012, 2025), seed=7):
    """All seven raw tables for a few areas, random but reproducible."""
    rng = random.Random(seed)
    keys = [f"{90000 + i}" for i in range(areas)]
    listings, people, school, crime, amenities = [], [], [], [], []
    for i, key in enumerate(keys):
        price = 300_000 + 40_000 * i
        for year in years:
            price *= 1 + rng.uniform(-0.05, 0.12)
            for month in range(1 + (i == 0 and year == years[0]), 13):  # one year lacks a month
                listings.append(
                    listing(
                        key, year, month, PARENT_METRO_REGION=f"Metro {i % 3}",
                        MEDIAN_SALE_PRICE=price * rng.uniform(0.95, 1.05), MEDIAN_LIST_PRICE=price * 1.02,
                        MEDIAN_PPSF=price / 1500, MEDIAN_LIST_PPSF=price / 1450, HOMES_SOLD=rng.randint(0, 30),
                        PENDING_SALES=rng.randint(1, 30), NEW_LISTINGS=rng.randint(1, 40),
                        INVENTORY=rng.randint(5, 90), OFF_MARKET_IN_TWO_WEEKS=rng.random(),
                        AVG_SALE_TO_LIST=rng.uniform(0.9, 1.1), SOLD_ABOVE_LIST=rng.random(),
                        MEDIAN_DOM=rng.randint(5, 90),
                    )
                )
            counts = {c: rng.randint(1, 900) for c in DEMOGRAPHIC_COLUMNS}
            counts |= {"total_population": 20_000 + rng.randint(0, 5000), "median_household_income": rng.randint(4, 15) * 10_000}
            if i == 1 and year == years[1]:
                counts |= {
                    "median_household_income": -666666666, "education_25plus_total": 0,
                    "foreign_born_total": 900, "foreign_born_naturalized": 300, "foreign_born_noncitizen": None,
                }
            people.append({"year": year, "zcta5": key, "geo_id": f"g{key}", "zcta_name": f"ZCTA5 {key}", **counts})
            school.append(
                {"zcta5": key, "year": year, "assessment_type": "CST" if year < 2014 else "CAASPP",
                 **{c: rng.randint(1, 99) for c in SCHOOL_COLUMNS},
                 **({"total_students_tested": 0} if i == 2 else {})}
            )
            crime.append(
                {"Zipcode": key, "County": f"County{i % 4} County", "Year": year, "Population": 10**6,
                 "total_population": 20_000, "Ratio": 0.02, "Total_Crime": 500,
                 **{c: rng.randint(1, 200) for c in CRIME_COUNTS}}
            )
            for kind in ("Coffee Shops", "Fitness", "Park", "Resturants")[: 3 if i == 3 else 4]:
                amenities.append(
                    {"zip": key, "year": year, "amenities": kind, "est": rng.randint(1, 30),
                     **{b: rng.randint(0, 5) for b in BUCKETS}}
                )
    wage = [
        {"City": f"City{c}", "County": f"County{c} County", "Year": y, "Minimum Wage": 10 + (y - 2016),
         "Ordinance Type": "State Law"}
        for c in range(4) for y in range(2016, years[-1] + 1)
    ] + [
        {"City": "Uptown", "County": "County1 County", "Year": y, "Minimum Wage": 12 + (y - 2016),
         "Ordinance Type": "County Ordinance"}
        for y in range(2017, years[-1] + 1)
    ]
    bridge = [
        {"GEOID_ZCTA5_20": key, "GEOID_COUNTY_20": f"060{i % 4:02d}", "NAMELSAD_COUNTY_20": f"County{i % 4} County",
         "AREALAND_PART": 850, "AREAWATER_PART": 5}
        for i, key in enumerate(keys)
    ] + [
        {"GEOID_ZCTA5_20": keys[0], "GEOID_COUNTY_20": "06001", "NAMELSAD_COUNTY_20": "County1 County",
         "AREALAND_PART": 150, "AREAWATER_PART": 0}
    ]
    return {
        "listings": text_frame(spark, LISTING_COLUMNS, listings),
        "demographics": text_frame(spark, ["year", "zcta5", "geo_id", "zcta_name", *DEMOGRAPHIC_COLUMNS], people),
        "school": text_frame(spark, ["zcta5", "year", "assessment_type", *SCHOOL_COLUMNS], school),
        "crime": text_frame(
            spark,
            ["Zipcode", "County", "Year", "Population", "total_population", "Ratio", "Total_Crime", *CRIME_COUNTS],
            crime,
        ),
        "amenities": text_frame(spark, ["zip", "year", "amenities", "est", *BUCKETS], amenities),
        "wage": text_frame(spark, ["City", "County", "Year", "Minimum Wage", "Ordinance Type"], wage),
        "bridge": text_frame(
            spark,
            ["GEOID_ZCTA5_20", "GEOID_COUNTY_20", "NAMELSAD_COUNTY_20", "AREALAND_PART", "AREAWATER_PART"],
            bridge,
        ),
    }
