"""Monthly observations -> yearly panel -> next-year target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.keys import pad_key
from panelloom.functions.scalars import (
    int_or_null,
    known,
    log_growth,
    months_of_supply,
    number_of,
    pct_growth,
)
from panelloom.operators.aggregates import first_known, last_known, month_set, weighted_mean
from panelloom.operators.joins import at_most_max_less_one, key_filter, next_period
from panelloom.operators.quality import require_unique
from panelloom.session import materialize


@dataclass(frozen=True)
class MonthlySpec:
    """Which monthly columns feed which yearly outputs."""

    totals: Mapping[str, str]
    observed: Mapping[str, str]
    weighted: Mapping[str, tuple[str, str]]
    stock: str
    stock_outputs: tuple[str, str, str]
    flow_output: str
    price_output: str
    label: tuple[str, str] | None = None
    entity: str = "zcta5"
    measures: Sequence[str] = field(default_factory=tuple)


# Columns of the monthly listings table and the names of the yearly outputs.
LISTINGS = MonthlySpec(
    totals={
        "HOMES_SOLD": "annual_homes_sold",
        "PENDING_SALES": "annual_pending_sales",
        "NEW_LISTINGS": "annual_new_listings",
    },
    observed={
        "MEDIAN_SALE_PRICE": "months_with_median_sale_price",
        "MEDIAN_LIST_PRICE": "months_with_median_list_price",
        "HOMES_SOLD": "months_with_homes_sold",
        "PENDING_SALES": "months_with_pending_sales",
        "NEW_LISTINGS": "months_with_new_listings",
        "INVENTORY": "months_with_inventory",
    },
    weighted={
        "annual_median_sale_price": ("MEDIAN_SALE_PRICE", "HOMES_SOLD"),
        "annual_median_list_price": ("MEDIAN_LIST_PRICE", "NEW_LISTINGS"),
        "annual_median_ppsf": ("MEDIAN_PPSF", "HOMES_SOLD"),
        "annual_median_list_ppsf": ("MEDIAN_LIST_PPSF", "NEW_LISTINGS"),
        "annual_avg_sale_to_list": ("AVG_SALE_TO_LIST", "HOMES_SOLD"),
        "annual_sold_above_list": ("SOLD_ABOVE_LIST", "HOMES_SOLD"),
        "annual_off_market_in_two_weeks": ("OFF_MARKET_IN_TWO_WEEKS", "NEW_LISTINGS"),
        "annual_median_dom": ("MEDIAN_DOM", "HOMES_SOLD"),
    },
    stock="INVENTORY",
    stock_outputs=("annual_inventory_mean", "annual_inventory_end", "annual_months_of_supply_est"),
    flow_output="annual_homes_sold",
    price_output="annual_median_sale_price",
    label=("PARENT_METRO_REGION", "parent_metro_region"),
    measures=(
        "MEDIAN_SALE_PRICE", "MEDIAN_LIST_PRICE", "MEDIAN_PPSF", "MEDIAN_LIST_PPSF", "HOMES_SOLD",
        "PENDING_SALES", "NEW_LISTINGS", "INVENTORY", "OFF_MARKET_IN_TWO_WEEKS", "AVG_SALE_TO_LIST",
        "SOLD_ABOVE_LIST", "MEDIAN_DOM",
    ),
)


def clean_monthly(raw: DataFrame, valid_keys: DataFrame, property_type: str = "All Residential") -> DataFrame:
    """Text listings -> typed monthly rows of one property type and the valid areas.

    The type filter runs on the raw column, so it reaches the scan; the semi-join follows
    before any typing.
    """
    rows = raw.filter(F.col("PROPERTY_TYPE") == property_type).withColumn(
        "zcta5", pad_key(F.col("REGION"), trim=True)
    )
    rows = key_filter(rows, valid_keys, ["zcta5"])
    ends = F.try_to_timestamp("PERIOD_END")
    return rows.select(
        "zcta5",
        int_or_null(F.col("YEAR")).alias("year"),
        ends.alias("period_end"),
        F.month(ends).alias("month"),
        "PARENT_METRO_REGION",
        *[number_of(rows, c).alias(c) for c in LISTINGS.measures],
    ).dropna(subset=["year", "period_end"])


def yearly_rollup(monthly: DataFrame, spec: MonthlySpec = LISTINGS) -> DataFrame:
    """One row per (entity, year) from monthly rows with ``year``, ``month``, ``period_end``.

    Every number comes from one partially aggregated pass with fixed-width buffers, which
    Spark keeps in a hash aggregate. A text label would force a sort, so it is found in a
    narrow pass of its own and joined on the grouping that both passes already have.
    """
    keys = [spec.entity, "year"]
    monthly = monthly.dropna(subset=keys)
    mean, end, supply = spec.stock_outputs
    order = F.col("period_end")
    yearly = monthly.groupBy(*keys).agg(
        month_set(F.col("month")).alias("_months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        *[F.count(c).alias(name) for c, name in spec.observed.items()],
        *[F.sum(c).alias(name) for c, name in spec.totals.items()],
        F.avg(spec.stock).alias(mean),
        last_known(F.col(spec.stock), order).alias(end),
        *[weighted_mean(F.col(v), F.col(w)).alias(name) for name, (v, w) in spec.weighted.items()],
    )
    yearly = yearly.withColumn("months_observed", F.bit_count("_months")).withColumn(
        "full_year_coverage", F.col("months_observed") == 12
    )
    yearly = yearly.withColumn(supply, months_of_supply(F.col(mean), F.col(spec.flow_output)))
    if spec.label:
        source, name = spec.label
        labels = (
            monthly.filter(F.col(source).isNotNull())
            .groupBy(*keys)
            .agg(first_known(F.col(source), order).alias(name))
        )
        yearly = yearly.join(labels, keys, "left")
    return yearly.select(
        *keys,
        *([spec.label[1]] if spec.label else []),
        "months_observed", "first_month", "last_month", "full_year_coverage",
        *spec.observed.values(), *spec.totals.values(), mean, end, supply, *spec.weighted,
    )


def add_next_year_target(yearly: DataFrame, periods: DataFrame, entity: str, price: str) -> DataFrame:
    """Next-year columns, growth targets and eligibility, without the last year found in ``periods``."""
    nxt = f"next_year_{price}"
    panel = next_period(
        yearly, entity, "year",
        {
            "months_observed": "next_year_months_observed",
            "full_year_coverage": "next_year_full_year_coverage",
            price: nxt,
        },
    )
    panel = at_most_max_less_one(panel, "year", periods)
    now, then = F.col(price), F.col(nxt)
    pct = "target_median_sale_price_pct_change_next_year"
    return (
        panel.withColumn(pct, pct_growth(now, then))
        .withColumn("target_median_sale_price_log_change_next_year", log_growth(now, then))
        .withColumn("has_next_year_target", F.col(pct).isNotNull())
        .withColumn("target_next_year_complete", known(F.col("next_year_full_year_coverage")))
        .withColumn(
            "baseline_model_eligible",
            F.col("full_year_coverage") & F.col("has_next_year_target") & F.col("target_next_year_complete"),
        )
    )


def build_annual_panel(
    raw: DataFrame, valid_keys: DataFrame, property_type: str = "All Residential"
) -> tuple[DataFrame, DataFrame]:
    """The yearly table and the modelling table; a repeated (area, year, period end) is an error.

    The text is parsed once: the key check, the roll-up and the last-year lookup read the
    typed rows.
    """
    monthly = materialize(clean_monthly(raw, valid_keys, property_type), "monthly")
    require_unique(monthly, ["zcta5", "year", "period_end"])
    yearly = yearly_rollup(monthly, LISTINGS)
    return yearly, add_next_year_target(yearly, monthly, "zcta5", LISTINGS.price_output)
