"""Versioned and sorted tables: rewriting what is read, and the proof of order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.bindings import modelling
from panelloom.bindings.common import fixed, table
from panelloom.operators.evaluation import add_relative_errors
from panelloom.session import new_path
from panelloom.sources.versions import commit_version, describe, read_current, version_bounds


def rewritten_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts stored, then rewritten with their errors by a job that reads the table it writes."""
    base = new_path(spark, "forecasts")
    commit_version(modelling.predictions(spark, sf_dir), base)
    commit_version(add_relative_errors(read_current(spark, base), "actual", "predicted"), base, partition_by=["model"])
    errors = ["relative_error", "absolute_relative_error", "percentage_error", "absolute_percentage_error"]
    return read_current(spark, base).select(
        "o_orderkey", "model", "actual", fixed(F.col("predicted"), 2).alias("predicted"),
        *[fixed(F.col(c)).alias(c) for c in errors],
        F.lit(describe(spark, base).number).cast("long").alias("version"),
    )


def sorted_version_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines stored by ship year and in order of part, flag and price: the keys at the ends, and that all is in order."""
    lines = table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    flag = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag"))
    rows = lines.select(F.col("l_partkey").alias("part"), flag.alias("flag"), F.col("l_extendedprice").alias("price"), F.year("l_shipdate").alias("year"))
    base = new_path(spark, "lines")
    commit_version(rows, base, partition_by=["year"], sort_by=["part", "flag", "price"])
    files = version_bounds(spark, base)
    ends = files.groupBy(F.regexp_extract("folder", r"year=(\d+)$", 1).cast("long").alias("year")).agg(
        F.sum("rows").alias("n_rows"), F.bool_and("in_order").alias("in_order"),
        *[F.min_by(f"first_{k}", "number").alias(f"first_{k}") for k in ("part", "flag", "price")],
        *[F.max_by(f"last_{k}", "number").alias(f"last_{k}") for k in ("part", "flag", "price")],
    )
    return ends.select("year", "n_rows", "in_order", *[f"{e}_{k}" for e in ("first", "last") for k in ("part", "flag", "price")])


QUERIES = {"rewritten_errors": rewritten_errors, "sorted_version_bounds": sorted_version_bounds}

_ENDS = ", ".join(
    f"{pick}({k}, i) AS {end}_{k}" for end, pick in (("first", "arg_min_null"), ("last", "arg_max_null")) for k in ("part", "flag", "price")
)
ORACLES = {
    "rewritten_errors": f"SELECT *, 2::BIGINT AS version FROM ({modelling.ORACLES['relative_errors']})",
    "sorted_version_bounds": f"""
WITH x AS (
  SELECT l_partkey AS part, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag, l_extendedprice AS price,
         year(l_shipdate)::BIGINT AS year FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY part, flag NULLS FIRST, price) AS i FROM x)
SELECT year, count(*) AS n_rows, true AS in_order, {_ENDS} FROM n GROUP BY 1""",
}
