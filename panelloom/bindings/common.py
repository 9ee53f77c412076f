"""Helpers shared by the bound queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import configure
from panelloom.sources.readers import read_table


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(configure(spark), f"{sf_dir}/{name}.parquet", columns or None)


def fixed(col: Column, digits: int = 4) -> Column:
    """Round for comparison; ties go up in both engines even when a sum differs in its last bit."""
    scale = float(10**digits)
    return F.floor(col * scale + 0.501) / scale


def fx(sql: str, digits: int = 4) -> str:
    """SQL counterpart of :func:`fixed`."""
    return f"(floor(({sql}) * 1e{digits} + 0.501) / 1e{digits})"


def whole(col: Column) -> Column:
    return col.cast("long")
