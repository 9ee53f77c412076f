"""Delimited text: what is written is what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.bindings.common import fixed, fx, table
from panelloom.session import new_path
from panelloom.sources.readers import read_keyed, read_text_table, read_typed_table
from panelloom.sources.writers import write_table


def _written(df: DataFrame, label: str, **options) -> str:
    path = new_path(df.sparkSession, label)
    write_table(df, path, fmt="csv", **options)
    return path


def text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages, full of quotes, commas and line ends, through delimited text and back."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    back = read_text_table(spark, _written(pages, "pages"), ["html", "page_id", "url"], multi_line=True)
    return back.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide file read by a few typed columns, with quotes, separators and outer blanks in a cell."""
    customers = table(spark, sf_dir, "customer")
    odd = F.concat(F.lit('  "'), F.col("c_name"), F.lit('", \\ ""'), F.col("c_mktsegment"), F.lit('"  '))
    path = _written(customers.withColumn("c_name", odd), "customers", sort_by=["c_custkey"])
    back = read_typed_table(spark, path, "c_acctbal double, c_custkey long, c_name string")
    return back.select("c_custkey", "c_name", fixed(F.col("c_acctbal"), 2).alias("c_acctbal"))


def keyed_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed panel in text with bars between cells and line breaks in them; keys are padded, years must be whole."""
    customers = table(spark, sf_dir, "customer")
    note = F.concat("c_name", F.lit('\n|"'), "c_mktsegment", F.lit('"\r\n'))
    panel = customers.select(
        F.col("c_custkey").cast("string").alias("zcta5"), (F.col("c_nationkey") + 2000).cast("string").alias("year"), note.alias("note"), "c_acctbal",
    )
    schema = "zcta5 string, year string, note string, c_acctbal double"
    back = read_keyed(spark, _written(panel, "keyed", sep="|"), schema, sep="|", multi_line=True)
    return back.select("zcta5", F.col("year").cast("long").alias("year"), "note", fixed(F.col("c_acctbal"), 2).alias("c_acctbal"))


QUERIES = {"text_round_trip": text_round_trip, "text_scan": text_scan, "keyed_text_scan": keyed_text_scan}
ORACLES = {
    "keyed_text_scan": f"""
SELECT CASE WHEN length(c_custkey::VARCHAR) < 5 THEN lpad(c_custkey::VARCHAR, 5, '0') ELSE c_custkey::VARCHAR END AS zcta5,
       2000 + c_nationkey AS year, c_name || chr(10) || '|"' || c_mktsegment || '"' || chr(13) || chr(10) AS note,
       {fx("c_acctbal", 2)} AS c_acctbal
FROM customer""",
    "text_round_trip": "SELECT page_id, url, html FROM pages",
    "text_scan": f"""
SELECT c_custkey, '  "' || c_name || '", \\ ""' || c_mktsegment || '"  ' AS c_name, {fx("c_acctbal", 2)} AS c_acctbal
FROM customer""",
}
