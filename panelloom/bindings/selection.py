"""Split, fold, profile, rule and correlation queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.bindings.common import fixed, fx, table, whole
from panelloom.bindings.panels import MONTHLY, MONTHLY_SQL, monthly_lines
from panelloom.functions.keys import pad_key
from panelloom.operators.profiling import (
    column_profile,
    correlation_audit,
    correlation_pairs,
    grouped_names,
    value_counts,
)
from panelloom.operators.rules import Rule, first_match, named
from panelloom.operators.splitting import fold_summary, split_summary, temporal_split, valid_target
from panelloom.plans.annual_panel import add_next_year_target, yearly_rollup
from panelloom.plans.model_data import ModelData, prepare_model_data, with_source_group
from panelloom.plans.select_features import (
    constant_column,
    exclusion_rules,
    feature_sets,
    select_features,
    select_schema,
)
from panelloom.session import materialize

TRAIN, TEST = (1995, 1999), 2000


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    return orders.select(
        "o_custkey", whole(F.year("o_orderdate")).alias("year"), "o_totalprice",
        F.when(F.col("o_orderstatus") != "P", F.log("o_totalprice")).alias("change"),
        (F.col("o_orderstatus") != "O").alias("complete"),
    )


def temporal_split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _dated_orders(spark, sf_dir)
    valid = orders.filter(valid_target(F.col("change"), F.col("o_totalprice"), None))
    rows = temporal_split(valid, "year", TRAIN, TEST)
    out = split_summary(rows, ["split", "year"], "o_custkey", "change")
    return out.select(
        "split", "year", "n_rows", "n_entities",
        *[fixed(F.col(c), 6).alias(c) for c in ("target_min", "target_median", "target_mean", "target_max")],
    )


def complete_target_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _dated_orders(spark, sf_dir)
    valid = orders.filter(valid_target(F.col("change"), F.col("o_totalprice"), F.col("complete")))
    return temporal_split(valid, "year", TRAIN, TEST).groupBy("split").agg(F.count("*").alias("n_rows"))


def cv_fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_summary(_dated_orders(spark, sf_dir), "o_custkey", "year", range(1997, 2001))


_PROFILED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "labels": ["quality", "toxic"],
}


def _profiled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", *_PROFILED["orders"])
    return orders.withColumn("constant", F.lit(1.5)).withColumn(
        "sparse", F.when(F.col("o_orderstatus") == "F", F.lit("yes"))
    ).withColumn("is_open", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "O"))


_ORDER_COLUMNS = [*_PROFILED["orders"], "constant", "sparse", "is_open"]


def _show_profile(df: DataFrame) -> DataFrame:
    return df.select("feature", "feature_kind", "preprocessing_kind", "n_rows",
                     fixed(F.col("missing_rate"), 6).alias("missing_rate"), "n_unique")


def column_profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_profile(column_profile(_profiled_orders(spark, sf_dir), _ORDER_COLUMNS))


def column_profile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_profile(column_profile(table(spark, sf_dir, "labels", *_PROFILED["labels"]), _PROFILED["labels"]))


_RULE_NAMES = {
    "o_custkey": "dominant_county_key", "o_orderstatus": "age_status", "o_totalprice": "annual_totalprice",
    "o_orderpriority": "phase2_has_minimum_wage", "constant": "crime_violent_est_per_1k",
    "sparse": "hispanic_or_latino_total_share", "is_open": "year",
}


def source_group_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name rules on the profile of renamed order columns."""
    renamed = _profiled_orders(spark, sf_dir).withColumnsRenamed(_RULE_NAMES)
    grouped = with_source_group(column_profile(renamed, renamed.columns))
    return grouped.select("feature", "source_group", "n_unique")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = column_profile(_profiled_orders(spark, sf_dir), _ORDER_COLUMNS)
    name = F.col("feature")
    grouped = first_match(
        profile, "feature",
        [Rule(named(name, ["constant"], ["o_order"]), "orders"), Rule(named(name, [], [], ["price"]), "money")],
        "source_group", "other",
    )
    rules = [
        Rule(named(name, ["o_orderpriority"]), None),
        Rule(F.col("source_group") == "money", "money_is_the_target"),
        Rule(named(name, ["o_orderpriority", "o_custkey"]), "listed"),
        constant_column(),
    ]
    return select_schema(grouped, rules)


def exclusion_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select(
        "feature", "source_group", "selected", "exclusion_reason", "preprocessing_kind"
    )


def selection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(_judged(spark, sf_dir), "source_group", "selected")


def selected_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_kind = grouped_names(_judged(spark, sf_dir).filter("selected"), "preprocessing_kind", order=["source_group"])
    return by_kind.select("preprocessing_kind", F.array_join("features", ",").alias("features"))


def named_feature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = _profiled_orders(spark, sf_dir).withColumnsRenamed(_RULE_NAMES)
    profile = with_source_group(column_profile(renamed, renamed.columns))
    sets = feature_sets(select_schema(profile, exclusion_rules()))
    return sets.select("feature_set", F.array_join("features", ",").alias("features"))


_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", *_LINE_NUMBERS, "l_returnflag")
    data = lines.select(
        F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity"), "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax", "l_linenumber",
        (F.col("l_returnflag") == "R").alias("returned"), F.lit(2.0).alias("flat"),
    )
    pairs = correlation_pairs(data, data.columns)
    return pairs.withColumn("abs_correlation", fixed(F.col("abs_correlation"), 6))


def _powers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", *_LINE_NUMBERS[:4])
    plain = {c: F.nullif(c, F.lit(0.0)) for c in _LINE_NUMBERS[:4]}
    out = lines.select(*[col.alias(c) for c, col in plain.items()])
    for c in _LINE_NUMBERS[:4]:
        out = out.withColumn(f"{c}_2", F.col(c) * F.col(c)).withColumn(f"{c}_log", F.ln(c))
    return out


_POWER_NAMES = [
    *_LINE_NUMBERS[:4], *[f"{c}_{s}" for c in _LINE_NUMBERS[:4] for s in ("2", "log")]
]


def corr_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = correlation_audit(_powers(spark, sf_dir), _POWER_NAMES, threshold=0.85)
    return audit.withColumn("abs_correlation", fixed(F.col("abs_correlation"), 6))


# Yearly columns of the supplier panel under the names the modelling jobs expect.
_PANEL_NAMES = {
    "first_flag": "parent_metro_region", "months_observed": "months_observed", "first_month": "first_month",
    "last_month": "last_month", "full_year_coverage": "full_year_coverage",
    "months_with_price": "months_with_median_sale_price", "months_with_sold": "months_with_homes_sold",
    "months_with_stock": "months_with_inventory", "annual_sold": "annual_homes_sold",
    "annual_listed": "annual_new_listings", "annual_stock_mean": "annual_inventory_mean",
    "annual_stock_end": "annual_inventory_end", "annual_months_of_supply": "annual_months_of_supply_est",
    "annual_price": "annual_median_sale_price", "annual_discount": "annual_median_dom",
}


def supplier_model_data(spark: SparkSession, sf_dir: str) -> ModelData:
    """Roll-up, target, split, profile and folds of the supplier panel in one job."""
    monthly = materialize(monthly_lines(spark, sf_dir), "monthly-lines")
    panel = add_next_year_target(yearly_rollup(monthly, MONTHLY), monthly, "l_suppkey", "annual_price")
    names = {**_PANEL_NAMES, "l_suppkey": "zcta5", "next_year_annual_price": "next_year_annual_median_sale_price"}
    keyed = panel.withColumn("l_suppkey", pad_key(F.col("l_suppkey"))).withColumnsRenamed(names)
    return prepare_model_data(keyed, train_years=TRAIN, test_year=TEST, first_validation_year=1997)


def model_data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = supplier_model_data(spark, sf_dir).profile
    # Distinct counts of sums depend on the order of addition, so only counted columns show theirs.
    counted = F.when(~F.col("feature").startswith("annual_"), F.col("n_unique"))
    return profile.select(
        "feature", "feature_kind", "source_group", fixed(F.col("missing_rate"), 6).alias("missing_rate"),
        counted.alias("n_unique"),
    )


def model_data_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_model_data(spark, sf_dir).folds


def selected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model rows projected to the selected features."""
    data = supplier_model_data(spark, sf_dir)
    rows = select_features(data.rows, data.profile).rows
    return rows.select(
        "zcta5", whole(F.col("year")).alias("year"), "split",
        *[
            fixed(F.col(c)).alias(c) if kind == "double" else (F.col(c) if kind != "int" else whole(F.col(c)).alias(c))
            for c, kind in rows.dtypes if c not in ("zcta5", "year", "split")
        ],
    )


QUERIES = {
    "model_data_profile": model_data_profile,
    "model_data_folds": model_data_folds,
    "selected_rows": selected_rows,
    "temporal_split_summary": temporal_split_summary,
    "complete_target_split": complete_target_split,
    "cv_fold_summary": cv_fold_summary,
    "column_profile": column_profile_orders,
    "column_profile_yes_no": column_profile_labels,
    "source_group_rules": source_group_rules,
    "exclusion_rules": exclusion_rules_query,
    "selection_summary": selection_summary,
    "selected_by_kind": selected_by_kind,
    "named_feature_sets": named_feature_sets,
    "corr_pairs": corr_pairs,
    "corr_audit": corr_audit,
}

_ORDERS_SQL = """
x AS (SELECT o_custkey, year(o_orderdate)::BIGINT AS year, o_totalprice,
             CASE WHEN o_orderstatus <> 'P' THEN ln(o_totalprice) END AS change,
             o_orderstatus <> 'O' AS complete FROM orders),
valid AS (SELECT * FROM x WHERE change IS NOT NULL AND o_totalprice > 0),
split AS (SELECT *, CASE WHEN year BETWEEN 1995 AND 1999 THEN 'train_1995_1999' ELSE 'test_2000' END AS split
          FROM valid WHERE year BETWEEN 1995 AND 2000)"""


def _fold_sql() -> str:
    parts = []
    for fold, v in enumerate(range(1997, 2001), start=1):
        parts.append(f"""
SELECT {fold}::BIGINT AS fold, {v}::BIGINT AS validation_year,
       min(year) FILTER (WHERE year < {v}) AS train_year_min, max(year) FILTER (WHERE year < {v}) AS train_year_max,
       count(*) FILTER (WHERE year < {v}) AS train_rows,
       count(DISTINCT o_custkey) FILTER (WHERE year < {v}) AS train_entities,
       count(*) FILTER (WHERE year = {v}) AS validation_rows,
       count(DISTINCT o_custkey) FILTER (WHERE year = {v}) AS validation_entities
FROM x""")
    return f"WITH {_ORDERS_SQL} " + " UNION ALL ".join(parts)


_PROFILE_EXPR = {
    "o_orderkey": ("o_orderkey", "numeric", "numeric"),
    "o_orderdate": ("o_orderdate", "categorical", "categorical"),
    "o_custkey": ("o_custkey", "numeric", "numeric"),
    "o_orderstatus": ("o_orderstatus", "categorical", "categorical"),
    "o_totalprice": ("o_totalprice", "numeric", "numeric"),
    "o_orderpriority": ("o_orderpriority", "categorical", "categorical"),
    "constant": ("1.5", "numeric", "numeric"),
    "sparse": ("CASE WHEN o_orderstatus = 'F' THEN 'yes' END", "categorical", "categorical"),
    "is_open": ("CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'O' END", "boolean", "boolean"),
}


def _profile_sql(names: dict[str, str] | None = None) -> str:
    rows = [
        f"SELECT '{(names or {}).get(c, c)}' AS feature, '{kind}' AS feature_kind, '{pre}' AS preprocessing_kind, "
        f"count(*) AS n_rows, {fx(f'(count(*) - count({e})) / count(*)::DOUBLE', 6)} AS missing_rate, "
        f"count(DISTINCT {e}) AS n_unique FROM orders"
        for c, (e, kind, pre) in _PROFILE_EXPR.items()
    ]
    return " UNION ALL ".join(rows)


_GROUPS_SQL = """CASE feature WHEN 'year' THEN 'time' WHEN 'dominant_county_key' THEN 'minimum_wage'
  WHEN 'age_status' THEN 'demographics' WHEN 'annual_totalprice' THEN 'listings'
  WHEN 'phase2_has_minimum_wage' THEN 'minimum_wage' WHEN 'crime_violent_est_per_1k' THEN 'crime'
  ELSE 'other' END"""

_JUDGED_SQL = f"""
p AS ({_profile_sql()}),
g AS (SELECT *, CASE WHEN feature = 'constant' OR feature LIKE 'o\\_order%' ESCAPE '\\' THEN 'orders'
                     WHEN feature LIKE '%price%' THEN 'money' ELSE 'other' END AS source_group FROM p),
judged AS (
  SELECT *, CASE WHEN feature = 'o_orderpriority' THEN '' WHEN source_group = 'money' THEN 'money_is_the_target'
                 WHEN feature IN ('o_orderpriority', 'o_custkey') THEN 'listed'
                 WHEN n_unique <= 1 AND missing_rate = 0 THEN 'constant_in_train_test_window' ELSE '' END
       AS exclusion_reason FROM g)"""


def _corr_sql(pairs: list[tuple[str, str]], source: str) -> str:
    rows = [
        f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, abs(corr({a}, {b})) AS r FROM {source}"
        for a, b in pairs
    ]
    return " UNION ALL ".join(rows)


_CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "returned"]

_SUPPLIER_SQL = f"""WITH {MONTHLY_SQL},
panel AS (
  SELECT a.*, b.annual_price AS next_price, ln(b.annual_price) - ln(a.annual_price) AS change,
         CASE WHEN a.year <= {TRAIN[1]} THEN 'train_{TRAIN[0]}_{TRAIN[1]}' ELSE 'test_{TEST}' END AS split
  FROM annual a JOIN annual b ON a.l_suppkey = b.l_suppkey AND b.year = a.year + 1
  WHERE a.annual_price > 0 AND b.annual_price > 0 AND b.full_year_coverage AND a.year BETWEEN {TRAIN[0]} AND {TEST})
"""


def _panel_profile_sql() -> str:
    kinds = {"first_flag": "categorical", "full_year_coverage": "boolean"}
    rows = [
        f"SELECT '{name}' AS feature, '{kinds.get(c, 'numeric')}' AS feature_kind, "
        f"'{'time' if c == 'year' else 'listings'}' AS source_group, "
        f"{fx(f'(count(*) - count({c})) / count(*)::DOUBLE', 6)} AS missing_rate, "
        f"{'NULL::BIGINT' if c.startswith('annual_') else f'count(DISTINCT {c})'} AS n_unique FROM panel"
        for c, name in {"year": "year", **_PANEL_NAMES}.items()
    ]
    return _SUPPLIER_SQL + " UNION ALL ".join(rows)


ORACLES = {
    "model_data_profile": _panel_profile_sql(),
    "model_data_folds": _SUPPLIER_SQL
    + " UNION ALL ".join(
        f"""SELECT {fold}::BIGINT AS fold, {v}::BIGINT AS validation_year,
       min(year) FILTER (WHERE year < {v})::BIGINT AS train_year_min,
       max(year) FILTER (WHERE year < {v})::BIGINT AS train_year_max,
       count(*) FILTER (WHERE year < {v}) AS train_rows,
       count(DISTINCT l_suppkey) FILTER (WHERE year < {v}) AS train_entities,
       count(*) FILTER (WHERE year = {v}) AS validation_rows,
       count(DISTINCT l_suppkey) FILTER (WHERE year = {v}) AS validation_entities
FROM panel WHERE split <> 'test_{TEST}'"""
        for fold, v in enumerate(range(1997, TRAIN[1] + 1), start=1)
    ),
    "selected_rows": _SUPPLIER_SQL
    + f"""SELECT lpad(l_suppkey::VARCHAR, 5, '0') AS zcta5, year::BIGINT AS year, split,
       {fx('next_price')} AS y_next_year_median_sale_price, {fx('change')} AS y_next_year_median_sale_price_log_change,
       first_flag AS parent_metro_region, months_observed::BIGINT AS months_observed, full_year_coverage,
       {fx('annual_sold')} AS annual_homes_sold, {fx('annual_stock_mean')} AS annual_inventory_mean,
       {fx('annual_months_of_supply')} AS annual_months_of_supply_est, {fx('annual_price')} AS annual_median_sale_price,
       {fx('annual_discount')} AS annual_median_dom
FROM panel""",
    "temporal_split_summary": f"""WITH {_ORDERS_SQL}
SELECT split, year, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities,
       {fx('min(change)', 6)} AS target_min, {fx('median(change)', 6)} AS target_median,
       {fx('avg(change)', 6)} AS target_mean, {fx('max(change)', 6)} AS target_max
FROM split GROUP BY 1, 2""",
    "complete_target_split": f"WITH {_ORDERS_SQL} SELECT split, count(*) AS n_rows FROM split WHERE complete GROUP BY 1",
    "cv_fold_summary": _fold_sql(),
    "column_profile": _profile_sql(),
    "column_profile_yes_no": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 'numeric' AS feature_kind, 'boolean' AS preprocessing_kind, count(*) AS n_rows, "
        f"{fx(f'(count(*) - count({c})) / count(*)::DOUBLE', 6)} AS missing_rate, "
        f"count(DISTINCT {c}) AS n_unique FROM labels"
        for c in _PROFILED["labels"]
    ),
    "source_group_rules": f"""WITH p AS ({_profile_sql(_RULE_NAMES)})
SELECT feature, {_GROUPS_SQL} AS source_group, n_unique FROM p""",
    "exclusion_rules": f"""WITH {_JUDGED_SQL}
SELECT feature, source_group, exclusion_reason = '' AS selected, exclusion_reason, preprocessing_kind
FROM judged""",
    "selection_summary": f"""WITH {_JUDGED_SQL}
SELECT source_group, exclusion_reason = '' AS selected, count(*) AS features FROM judged GROUP BY 1, 2""",
    "selected_by_kind": f"""WITH {_JUDGED_SQL}
SELECT preprocessing_kind, string_agg(feature, ',' ORDER BY source_group, feature) AS features
FROM judged WHERE exclusion_reason = '' GROUP BY 1""",
    "named_feature_sets": f"""WITH p AS ({_profile_sql(_RULE_NAMES)}),
g AS (SELECT feature, {_GROUPS_SQL} AS source_group FROM p WHERE feature NOT IN ('year', 'phase2_has_minimum_wage')),
m AS (
  SELECT 'all_selected_features' AS feature_set, feature, source_group FROM g
  UNION ALL SELECT 'baseline_features', feature, source_group FROM g WHERE source_group IN ('listings', 'demographics')
  UNION ALL SELECT 'phase2_features', feature, source_group FROM g
  UNION ALL SELECT 'neighborhood_features', feature, source_group FROM g WHERE source_group = 'crime'
  UNION ALL SELECT 'policy_features', feature, source_group FROM g WHERE source_group = 'minimum_wage'
  UNION ALL SELECT 'crime_features', feature, source_group FROM g WHERE source_group = 'crime')
SELECT feature_set, string_agg(feature, ',' ORDER BY source_group, feature) AS features FROM m GROUP BY 1""",
    "corr_pairs": f"""
WITH x AS (SELECT nullif(l_quantity, 1) AS l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, l_tax,
                  l_linenumber, (l_returnflag = 'R')::INT AS returned FROM lineitem),
c AS ({_corr_sql(list(combinations(_CORR_COLUMNS, 2)), 'x')})
SELECT left_feature, right_feature, {fx('r', 6)} AS abs_correlation FROM c
UNION ALL SELECT f, 'flat', NULL FROM unnest({_CORR_COLUMNS!r}) t(f)""",
    "corr_audit": "WITH x AS (SELECT "
    + ", ".join(
        f"nullif({c}, 0) AS {c}, nullif({c}, 0) * nullif({c}, 0) AS {c}_2, "
        f"CASE WHEN {c} > 0 THEN ln({c}) END AS {c}_log"
        for c in _LINE_NUMBERS[:4]
    )
    + f" FROM lineitem), c AS ({_corr_sql(list(combinations(_POWER_NAMES, 2)), 'x')}) "
    f"SELECT left_feature, right_feature, {fx('r', 6)} AS abs_correlation, "
    "'selected_numeric_pair_abs_corr_ge_0.85' AS audit_note FROM c WHERE r >= 0.85",
}
