"""Panel queries: keys, roll-ups, targets, joins and row sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.bindings.common import fixed, fx, table, whole
from panelloom.functions.keys import category_label, pad_key, strip_suffix_word
from panelloom.functions.scalars import (
    fill_from_difference,
    flag_number,
    int_or_null,
    known,
    month_of,
    non_negative,
    not_in,
    number_or_null,
    sentinels_to_null,
)
from panelloom.operators.aggregates import weighted_mean
from panelloom.operators.joins import assemble_panel, attach_features, join_many_to_one, key_filter
from panelloom.operators.quality import audit_counts, surplus_rows
from panelloom.operators.rowsets import keep_by_priority, union_missing
from panelloom.plans.annual_panel import MonthlySpec, add_next_year_target, yearly_rollup
from panelloom.session import materialize

MONTHLY = MonthlySpec(
    entity="l_suppkey",
    totals={"sold": "annual_sold", "listed": "annual_listed"},
    observed={"price": "months_with_price", "sold": "months_with_sold", "stock": "months_with_stock"},
    weighted={"annual_price": ("price", "sold"), "annual_discount": ("discount", "listed")},
    stock="stock",
    stock_outputs=("annual_stock_mean", "annual_stock_end", "annual_months_of_supply"),
    flow_output="annual_sold",
    price_output="annual_price",
    label=("flag", "first_flag"),
)


def monthly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as monthly observations of a supplier, with gaps where nothing qualified."""
    lines = table(
        spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus",
    )
    is_open = F.col("l_linestatus") == "O"
    kept = F.col("l_returnflag") != "R"
    return lines.groupBy(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.last_day("l_shipdate").alias("period_end"),
    ).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.sum(F.when(kept & is_open, F.col("l_quantity"))).alias("sold"),
        F.sum("l_quantity").alias("listed"),
        F.avg("l_discount").alias("discount"),
        F.sum(F.when(is_open, F.lit(1.0))).alias("stock"),
        # The flag is one letter; its code keeps the aggregate on fixed-width buffers.
        F.char(F.max(F.when(is_open, F.ascii("l_returnflag"))).cast("long")).alias("flag"),
    )


MONTHLY_SQL = """
monthly AS (
  SELECT l_suppkey, year(l_shipdate) AS year, month(l_shipdate) AS month,
         last_day(l_shipdate) AS period_end,
         avg(l_extendedprice / l_quantity) AS price,
         sum(CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'O' THEN l_quantity END) AS sold,
         sum(l_quantity) AS listed, avg(l_discount) AS discount,
         sum(CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE END) AS stock,
         max(CASE WHEN l_linestatus = 'O' THEN l_returnflag END) AS flag
  FROM lineitem GROUP BY 1, 2, 3, 4),
annual AS (
  SELECT l_suppkey, year, arg_min(flag, period_end) FILTER (WHERE flag IS NOT NULL) AS first_flag,
         count(DISTINCT month) AS months_observed, min(month) AS first_month, max(month) AS last_month,
         count(DISTINCT month) = 12 AS full_year_coverage,
         count(price) AS months_with_price, count(sold) AS months_with_sold,
         count(stock) AS months_with_stock,
         sum(sold) AS annual_sold, sum(listed) AS annual_listed, avg(stock) AS annual_stock_mean,
         arg_max(stock, period_end) FILTER (WHERE stock IS NOT NULL) AS annual_stock_end,
         CASE WHEN sum(sold) > 0 THEN avg(stock) / (sum(sold) / 12.0::DOUBLE) END AS annual_months_of_supply,
         coalesce(sum(price * sold) FILTER (WHERE price IS NOT NULL AND sold > 0)
                  / nullif(sum(sold) FILTER (WHERE price IS NOT NULL AND sold > 0), 0), avg(price))
           AS annual_price,
         coalesce(sum(discount * listed) FILTER (WHERE discount IS NOT NULL AND listed > 0)
                  / nullif(sum(listed) FILTER (WHERE discount IS NOT NULL AND listed > 0), 0), avg(discount))
           AS annual_discount
  FROM monthly GROUP BY 1, 2)
"""


def _show_annual(df: DataFrame) -> DataFrame:
    return df.select(
        "l_suppkey", whole(F.col("year")).alias("year"), "first_flag",
        *[whole(F.col(c)).alias(c) for c in (
            "months_observed", "first_month", "last_month", "months_with_price", "months_with_sold",
            "months_with_stock")],
        "full_year_coverage", "annual_sold", "annual_listed",
        fixed(F.col("annual_stock_mean")).alias("annual_stock_mean"), "annual_stock_end",
        fixed(F.col("annual_months_of_supply")).alias("annual_months_of_supply"),
        fixed(F.col("annual_price")).alias("annual_price"),
        fixed(F.col("annual_discount")).alias("annual_discount"),
    )


_SHOW_ANNUAL_SQL = f"""
SELECT l_suppkey, year::BIGINT AS year, first_flag, months_observed::BIGINT AS months_observed,
       first_month::BIGINT AS first_month, last_month::BIGINT AS last_month,
       months_with_price::BIGINT AS months_with_price, months_with_sold::BIGINT AS months_with_sold,
       months_with_stock::BIGINT AS months_with_stock, full_year_coverage, annual_sold, annual_listed,
       {fx('annual_stock_mean')} AS annual_stock_mean, annual_stock_end,
       {fx('annual_months_of_supply')} AS annual_months_of_supply,
       {fx('annual_price')} AS annual_price, {fx('annual_discount')} AS annual_discount
FROM annual"""


def annual_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two passes read the monthly rows: the totals and the labels.
    return _show_annual(yearly_rollup(materialize(monthly_lines(spark, sf_dir), "monthly-lines"), MONTHLY))


def next_year_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = monthly_lines(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("year"))
    panel = add_next_year_target(yearly_rollup(monthly, MONTHLY), lines, "l_suppkey", "annual_price")
    pct = "target_median_sale_price_pct_change_next_year"
    log = "target_median_sale_price_log_change_next_year"
    return panel.select(
        "l_suppkey", whole(F.col("year")).alias("year"), fixed(F.col("annual_price")).alias("annual_price"),
        whole(F.col("next_year_months_observed")).alias("next_year_months_observed"),
        "next_year_full_year_coverage",
        fixed(F.col("next_year_annual_price")).alias("next_year_annual_price"),
        fixed(F.col(pct), 6).alias("pct_change"), fixed(F.col(log), 6).alias("log_change"),
        "has_next_year_target", "target_next_year_complete", "baseline_model_eligible",
    )


_NEXT_YEAR_SQL = f"""WITH {MONTHLY_SQL}
SELECT a.l_suppkey, a.year::BIGINT AS year, {fx('a.annual_price')} AS annual_price,
       b.months_observed::BIGINT AS next_year_months_observed,
       b.full_year_coverage AS next_year_full_year_coverage,
       {fx('b.annual_price')} AS next_year_annual_price,
       {fx('CASE WHEN a.annual_price > 0 AND b.annual_price > 0 THEN b.annual_price / a.annual_price - 1 END', 6)}
         AS pct_change,
       {fx('CASE WHEN a.annual_price > 0 AND b.annual_price > 0 THEN ln(b.annual_price) - ln(a.annual_price) END', 6)}
         AS log_change,
       coalesce(a.annual_price > 0 AND b.annual_price > 0, false) AS has_next_year_target,
       coalesce(b.full_year_coverage, false) AS target_next_year_complete,
       a.full_year_coverage AND coalesce(a.annual_price > 0 AND b.annual_price > 0, false)
         AND coalesce(b.full_year_coverage, false) AS baseline_model_eligible
FROM annual a LEFT JOIN annual b ON a.l_suppkey = b.l_suppkey AND b.year = a.year + 1
WHERE a.year <= (SELECT max(year) FROM annual) - 1"""


def weighted_mean_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_partkey", "l_shipdate", "l_extendedprice", "l_discount")
    weight = F.nullif(F.col("l_discount"), F.lit(0.0))
    return lines.groupBy("l_partkey", whole(F.year("l_shipdate")).alias("year")).agg(
        fixed(weighted_mean(F.col("l_extendedprice"), weight)).alias("mean_price"),
        F.count(weight).alias("n_weights"),
    )


def valid_key_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    valid = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").filter(
        F.col("c_mktsegment") == "BUILDING"
    )
    return key_filter(orders, valid.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])


def pad_key_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(
        "o_orderkey", pad_key(F.col("o_custkey"), 4).alias("key")
    )
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey").select(
        pad_key(F.col("c_custkey"), 4).alias("key"), "c_name", whole(F.col("c_nationkey")).alias("c_nationkey")
    )
    return join_many_to_one(orders, customers, ["key"])


def category_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"1-URGENT": "urgent", "5-LOW": "low"}
    priorities = table(spark, sf_dir, "orders", "o_orderpriority").select(
        F.lit("priority").alias("kind"), category_label(F.col("o_orderpriority"), names).alias("label")
    )
    places = (
        table(spark, sf_dir, "customer", "c_nationkey", "c_mktsegment")
        .withColumnRenamed("c_nationkey", "n_nationkey")
        .join(table(spark, sf_dir, "nation", "n_nationkey", "n_name"), "n_nationkey")
        .select(
            F.lit("place").alias("kind"),
            strip_suffix_word(F.concat(F.lit("  "), "n_name", F.lit("   "), "c_mktsegment", F.lit("  County ")))
            .alias("label"),
        )
    )
    return priorities.unionByName(places).groupBy("kind", "label").agg(F.count("*").alias("n_rows"))


def sentinel_and_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    coded = F.when(F.col("c_mktsegment") == "FURNITURE", -666666666.0).when(
        F.col("c_mktsegment") == "MACHINERY", -999999999.0
    ).otherwise(F.col("c_acctbal"))
    other = F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_acctbal") / 2)
    typed = customers.select(
        "c_custkey",
        sentinels_to_null(coded, [-666666666, -888888888, -999999999]).alias("part"),
        (F.col("c_nationkey") * 100.0).alias("total"),
        other.alias("other"),
    )
    part, derived = fill_from_difference(F.col("part"), F.col("total"), F.col("other"))
    filled = typed.select(
        "c_custkey", part.alias("filled"), derived.alias("was_derived"), "total"
    )
    return filled.select(
        "c_custkey",
        fixed(non_negative(F.col("filled"))).alias("part"),
        "was_derived",
        known(F.col("total") > 0).alias("total_positive"),
        F.col("filled").isNull().alias("part_missing"),
        not_in(F.col("filled"), [0.0]).alias("part_not_zero"),
    )


def lossy_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(
        spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate", "o_orderstatus"
    )
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    rank = F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).otherwise(
        F.substring("o_orderpriority", 1, 1)
    )
    date = F.when(F.col("o_orderstatus") == "F", F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return orders.select(
        "o_orderkey",
        number_or_null(text).alias("price"),
        whole(int_or_null(rank)).alias("rank"),
        whole(month_of(date)).alias("month"),
        flag_number(F.col("o_orderstatus") == "O", "boolean").alias("is_open"),
    )


def presence_flag_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select(
        "doc_id", whole(F.col("quality")).alias("quality"), whole(F.col("toxic")).alias("toxic")
    )
    return attach_features(docs, labels, "labels", ["doc_id"])


def panel_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_tax")
    keyed = lines.withColumn("year", F.year("l_shipdate"))
    keys = ["l_suppkey", "year"]
    base = keyed.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    returned = keyed.filter(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.count("*").alias("n_returned"))
    taxed = keyed.filter(F.col("l_tax") >= 0.08).groupBy(*keys).agg(F.max("l_tax").alias("top_tax"))
    out = assemble_panel(base, {"returns": returned, "tax": taxed, "survey": None}, keys)
    return out.withColumn("year", whole(F.col("year")))


def duplicate_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surplus_rows(
        table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]
    )


def audit_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_discount", "l_tax", "l_returnflag", "l_quantity")
    return audit_counts(
        lines,
        {
            "n_discounted": F.nullif(F.col("l_discount"), F.lit(0.0)) > 0,
            "n_returned": F.col("l_returnflag") == "R",
            "n_tax_gap": F.abs(F.col("l_tax") - F.col("l_discount")) > 1e-9,
        },
    )


def priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    return keep_by_priority(orders, ["o_custkey"], F.col("o_orderpriority"), F.col("o_orderkey"))


def metric_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderstatus", "o_totalprice")
    parts = table(spark, sf_dir, "part", "p_brand", "p_retailprice", "p_size")
    a = orders.groupBy(F.col("o_orderstatus").alias("model")).agg(
        F.count("*").alias("n_rows"), fixed(F.avg("o_totalprice")).alias("mean_price")
    )
    b = parts.groupBy(F.col("p_brand").alias("model")).agg(
        F.count("*").alias("n_rows"), whole(F.max("p_size")).alias("max_size")
    )
    return union_missing(a, b)


QUERIES = {
    "annual_rollup": annual_rollup,
    "next_year_target": next_year_target,
    "weighted_mean_fallback": weighted_mean_fallback,
    "valid_key_semi_join": valid_key_semi_join,
    "pad_key_left_join": pad_key_left_join,
    "category_normalise": category_normalise,
    "sentinel_and_derive": sentinel_and_derive,
    "lossy_casts": lossy_casts,
    "presence_flag_join": presence_flag_join,
    "panel_assembly": panel_assembly,
    "duplicate_key_count": duplicate_key_count,
    "audit_counters": audit_counters,
    "priority_dedup": priority_dedup,
    "union_missing_columns": metric_union,
}

ORACLES = {
    "annual_rollup": f"WITH {MONTHLY_SQL} {_SHOW_ANNUAL_SQL}",
    "next_year_target": _NEXT_YEAR_SQL,
    "weighted_mean_fallback": f"""
SELECT l_partkey, year(l_shipdate)::BIGINT AS year,
       {fx('''coalesce(sum(l_extendedprice * nullif(l_discount, 0)) FILTER (WHERE l_discount > 0)
                / nullif(sum(l_discount) FILTER (WHERE l_discount > 0), 0), avg(l_extendedprice))''')}
         AS mean_price,
       count(nullif(l_discount, 0)) AS n_weights
FROM lineitem GROUP BY 1, 2""",
    "valid_key_semi_join": """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "pad_key_left_join": """
WITH c AS (SELECT CASE WHEN length(c_custkey::VARCHAR) < 4 THEN lpad(c_custkey::VARCHAR, 4, '0')
                       ELSE c_custkey::VARCHAR END AS key, c_name, c_nationkey::BIGINT AS c_nationkey
           FROM customer),
o AS (SELECT o_orderkey, CASE WHEN length(o_custkey::VARCHAR) < 4 THEN lpad(o_custkey::VARCHAR, 4, '0')
                       ELSE o_custkey::VARCHAR END AS key FROM orders)
SELECT o.key, o.o_orderkey, c.c_name, c.c_nationkey FROM o LEFT JOIN c ON o.key = c.key""",
    "category_normalise": """
SELECT 'priority' AS kind,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low'
            ELSE translate(replace(lower(trim(o_orderpriority)), '&', 'and'), '/- ', '___') END AS label,
       count(*) AS n_rows
FROM orders GROUP BY 1, 2
UNION ALL
SELECT 'place', n_name || ' ' || c_mktsegment, count(*)
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "sentinel_and_derive": f"""
WITH t AS (
  SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ('FURNITURE', 'MACHINERY') THEN c_acctbal END AS part,
         c_nationkey * 100.0::DOUBLE AS total,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal / 2 END AS other
  FROM customer),
f AS (SELECT c_custkey, coalesce(part, total - other) AS filled,
             part IS NULL AND total - other IS NOT NULL AS was_derived, total FROM t)
SELECT c_custkey, {fx('CASE WHEN filled >= 0 THEN filled END')} AS part, was_derived,
       coalesce(total > 0, false) AS total_positive, filled IS NULL AS part_missing,
       NOT coalesce(filled IN (0.0), false) AS part_not_zero
FROM f""",
    "lossy_casts": """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
       CASE WHEN o_orderstatus <> 'O' THEN try_cast(substr(o_orderpriority, 1, 1) AS BIGINT) END AS rank,
       CASE WHEN o_orderstatus <> 'F' THEN month(o_orderdate) END::BIGINT AS month,
       CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_open
FROM orders""",
    "presence_flag_join": """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality::BIGINT AS quality, l.toxic::BIGINT AS toxic,
       l.quality IS NOT NULL OR l.toxic IS NOT NULL AS has_labels
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "panel_assembly": """
WITH k AS (SELECT l_suppkey, year(l_shipdate)::BIGINT AS year, l_quantity, l_returnflag, l_tax FROM lineitem),
b AS (SELECT l_suppkey, year, sum(l_quantity) AS quantity FROM k GROUP BY 1, 2),
r AS (SELECT l_suppkey, year, count(*) AS n_returned FROM k WHERE l_returnflag = 'R' GROUP BY 1, 2),
t AS (SELECT l_suppkey, year, max(l_tax) AS top_tax FROM k WHERE l_tax >= 0.08 GROUP BY 1, 2)
SELECT b.*, r.n_returned, r.n_returned IS NOT NULL AS has_returns, t.top_tax,
       t.top_tax IS NOT NULL AS has_tax, false AS has_survey
FROM b LEFT JOIN r USING (l_suppkey, year) LEFT JOIN t USING (l_suppkey, year)""",
    "duplicate_key_count": """
SELECT coalesce(sum(n - 1), 0)::BIGINT AS surplus_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "audit_counters": """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_discount > 0) AS n_discounted,
       count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       count(*) FILTER (WHERE abs(l_tax - l_discount) > 1e-9) AS n_tax_gap
FROM lineitem""",
    "priority_dedup": """
SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) = 1""",
    "union_missing_columns": f"""
SELECT o_orderstatus AS model, count(*) AS n_rows, {fx('avg(o_totalprice)')} AS mean_price,
       NULL::BIGINT AS max_size FROM orders GROUP BY 1
UNION ALL
SELECT p_brand, count(*), NULL, max(p_size)::BIGINT FROM part GROUP BY 1""",
}
