"""Scans with explicit types; nothing infers a schema from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.keys import pad_key
from panelloom.functions.scalars import missing_to_null, strict_int
from panelloom.sources.records import check_quotes, quoted_records


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ",", multi_line: bool = False,
) -> DataFrame:
    """Delimited files with a header, every column text; missing-value texts become NULL.

    A quote inside a quoted cell is doubled. A row with too many or too few cells, or a file whose header
    differs from the first file's, is an error. ``multi_line`` allows line breaks inside quotes; files are then
    split all the same (:mod:`panelloom.sources.records`), and a quote in a cell without quotes is an error.
    """
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns  # reads the first record only
    cells = T.StructType([T.StructField(c, T.StringType()) for c in header])
    if multi_line:
        df = _parse_records(quoted_records(spark, path), cells, sep)
    else:
        df = spark.read.schema(cells).options(**options, mode="FAILFAST", enforceSchema=False, columnPruning=False).csv(path)
    return df.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in columns or header])


def _parse_records(records: DataFrame, cells: T.StructType, sep: str) -> DataFrame:
    """Records to columns; the first of each file must be the header and goes."""
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    parsed = F.from_csv(check_quotes(F.col("record"), sep), _ddl(cells), options)
    rows = records.select("file", "first", parsed.alias("row"))
    names = F.to_json(F.array(*[F.lit(c) for c in cells.names]))
    found = F.to_json(F.array(*[F.coalesce(F.col("row").getField(c), F.lit(c)) for c in cells.names]))
    other = F.raise_error(F.concat(F.lit("another header in "), "file")).cast("boolean")
    body = F.when(F.col("first"), F.when(found == names, F.lit(False)).otherwise(other)).otherwise(F.lit(True))
    return rows.filter(body).select("row.*")


def _ddl(cells: T.StructType) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` STRING" for c in cells.names)


def read_typed_table(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """Delimited file with a header read under a declared schema; text that does not fit is an error."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = read_text_table(spark, path, wanted.fieldNames(), sep, multi_line)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of the listed columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def with_keys(df: DataFrame, entity: str = "zcta5", period: str = "year") -> DataFrame:
    """Pad the entity key and require an integer period.

    A period that is already an integer stays a bare column, so filters on it still reach
    the scan.
    """
    df = df.withColumn(entity, pad_key(F.col(entity)))
    if isinstance(df.schema[period].dataType, T.IntegerType):
        return df
    return df.withColumn(period, strict_int(F.col(period), period))


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    entity: str = "zcta5", period: str = "year", sep: str = ",", multi_line: bool = False,
) -> DataFrame:
    """Keyed panel table: Parquet, or delimited text when a schema is given."""
    df = read_table(spark, path) if schema is None else read_typed_table(spark, path, schema, sep, multi_line)
    return with_keys(df, entity, period)


def key_rows(df: DataFrame, keys: Mapping[str, int | None] | Sequence[str]) -> DataFrame:
    """Distinct known keys; a mapping gives the pad width of each text key."""
    widths = keys if isinstance(keys, Mapping) else dict.fromkeys(keys)
    cols = [pad_key(F.col(k), w).alias(k) if w else F.col(k) for k, w in widths.items()]
    return df.select(*cols).dropna().distinct()


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short constant table."""
    return spark.createDataFrame(list(rows), schema)
