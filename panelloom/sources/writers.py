"""Table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (), mode: str = "overwrite", sep: str = ",",
) -> None:
    """Write a table, optionally partitioned by low-cardinality columns such as the year.

    ``sort_by`` range-partitions the rows, so the files (of each partition folder) are in total order;
    :func:`panelloom.sources.versions.key_bounds` proves it. In delimited text quotes are doubled and blanks kept;
    NULL is an empty cell and the empty text a pair of quotes.
    """
    if sort_by:
        df = df.orderBy(*partition_by, *sort_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(
            header=True, sep=sep, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_version(df: DataFrame, base: str, version: str, fmt: str = "parquet") -> str:
    """Write a new version beside the old ones; the path being read is never overwritten."""
    path = f"{base.rstrip('/')}/version={version}"
    write_table(df, path, fmt, mode="errorifexists")
    return path


def read_version(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/version={version}")
