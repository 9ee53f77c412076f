"""Imputation, scaling and one-hot encoding fitted on the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.scalars import flag_number, nan_to_null
from panelloom.operators.ordering import number_rows
from panelloom.operators.radix import exact_quantiles
from panelloom.operators.rowsets import keep_by_priority, union_same
from panelloom.session import materialize

FEATURES = "features"


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of every column, all in one range-partitioned pass; 0 for an empty column."""
    if not columns:
        return {}
    long = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    found = exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect()  # one row per column
    return dict.fromkeys(columns, 0.0) | {r["feature"]: r["median"] for r in found}


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored ``(feature, value, n)`` of the known texts of every column."""
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    return materialize(counts, "level-counts")


def column_modes(counts: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent known text of every column, of :func:`level_counts`; ties go to the smallest."""
    best = keep_by_priority(counts, ["feature"], -F.col("n"), F.col("value")).collect()  # one row per column
    return dict.fromkeys(columns, "") | {r["feature"]: r["value"] for r in best}


def level_table(counts: DataFrame, modes: dict[str, str]) -> DataFrame:
    """Stored ``(feature, value, level)``: the texts of every column, numbered from 0 in their order.

    A column without any known text has its fill as the one level.
    """
    seen = counts.select("feature").distinct()
    fills = counts.sparkSession.createDataFrame(list(modes.items()), "feature string, value string")
    known = counts.select("feature", "value")
    values = materialize(union_same(known, fills.join(seen, "feature", "left_anti").select("feature", "value")), "levels")
    numbered = number_rows(values, ["feature"], [F.col("value")], "level", stored=True)
    return materialize(numbered.withColumn("level", F.col("level") - 1), "level-numbers")


def one_hot(inputs: Sequence[str], outputs: Sequence[str], sizes: Sequence[int], spark: SparkSession) -> OneHotEncoderModel:
    """Encoder of whole numbers below the given sizes; the size itself stands for an unseen value, all zeros."""
    largest = spark.createDataFrame([tuple(float(n) for n in sizes)], ", ".join(f"`{c}` double" for c in inputs))
    return OneHotEncoder(inputCols=list(inputs), outputCols=list(outputs), dropLast=True).fit(largest)


@dataclass(frozen=True)
class Preprocessor:
    numeric: list[str]
    boolean: list[str]
    categorical: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    modes: dict[str, str]
    levels: DataFrame | None  # (feature, value, level); the driver knows only how many there are
    sizes: dict[str, int]

    @property
    def width(self) -> int:
        """Slots of the feature vector."""
        return len(self.numeric) + len(self.boolean) + sum(self.sizes.values())

    def terms(self, spark: SparkSession) -> DataFrame:
        """``(slot, feature, term)`` of every slot of the feature vector."""
        plain = [*self.numeric, *self.boolean]
        table = spark.createDataFrame([(i, c, c) for i, c in enumerate(plain)], "slot long, feature string, term string")
        if self.levels is None:
            return table
        offsets, at = [], len(plain)
        for c in self.categorical:
            offsets.append((c, at))
            at += self.sizes[c]
        placed = self.levels.join(spark.createDataFrame(offsets, "feature string, _at long"), "feature")
        hot = placed.select(
            (F.col("_at") + F.col("level")).alias("slot"), "feature", F.concat_ws("=", "feature", "value").alias("term")
        )
        return union_same(table, hot)

    def unit_vectors(self, spark: SparkSession) -> DataFrame:
        """The terms, each with the feature vector that is one in its slot and zero elsewhere."""
        numbered = self.terms(spark).withColumn("_slot", F.col("slot").cast("double"))
        return one_hot(["_slot"], [FEATURES], [self.width], spark).transform(numbered).drop("_slot")

    @property
    def sources(self) -> list[str]:
        return [*self.numeric, *self.boolean, *self.categorical]

    def filled(self, df: DataFrame) -> DataFrame:
        """Source columns as the encoder sees them: typed and without missing values."""
        return df.withColumns(_typed(df, self.numeric, self.boolean, self.categorical)).fillna(
            {**self.medians, **self.modes}
        )

    def encode(self, filled: DataFrame) -> DataFrame:
        """Add the feature vector to rows that went through :meth:`filled`."""
        scaled = {
            f"_z_{c}": (F.col(c) - F.lit(self.means[c])) / F.lit(self.scales[c])
            for c in [*self.numeric, *self.boolean]
        }
        df = filled.withColumns(scaled) if scaled else filled
        for c in self.categorical:
            level = F.col("level").cast("double").alias(f"_idx_{c}")
            found = self.levels.filter(F.col("feature") == c).select(F.col("value").alias(f"_value_{c}"), level)
            df = df.join(found, F.col(c) == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
            df = df.withColumn(f"_idx_{c}", F.coalesce(f"_idx_{c}", F.lit(float(self.sizes[c]))))
        if self.categorical:
            names = [f"_idx_{c}" for c in self.categorical]
            hot = [f"_hot_{c}" for c in self.categorical]
            df = one_hot(names, hot, [self.sizes[c] for c in self.categorical], df.sparkSession).transform(df)
        inputs = [*scaled, *[f"_hot_{c}" for c in self.categorical]]
        out = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(df)
        return out.drop(*inputs, *[f"_idx_{c}" for c in self.categorical])

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the feature vector; the source columns stay as they were."""
        keep = {f"_raw_{c}": F.col(c) for c in self.sources}
        encoded = self.encode(self.filled(df.withColumns(keep)))
        return encoded.drop(*self.sources).withColumnsRenamed({f"_raw_{c}": c for c in self.sources})


def _typed(
    df: DataFrame, numeric: Sequence[str], boolean: Sequence[str], categorical: Sequence[str]
) -> dict[str, Column]:
    types = dict(df.dtypes)
    return (
        {c: nan_to_null(F.col(c)) for c in numeric}
        | {c: flag_number(F.col(c), types[c]) for c in boolean}
        | {c: F.col(c).cast("string") for c in categorical}
    )


def fit_preprocessor(
    train: DataFrame, numeric: Sequence[str], boolean: Sequence[str] = (), categorical: Sequence[str] = ()
) -> Preprocessor:
    """Fit on the training rows only; what reaches the driver is one figure per column, no level."""
    numeric, boolean, categorical = list(numeric), list(boolean), list(categorical)
    typed = train.select(*[col.alias(c) for c, col in _typed(train, numeric, boolean, categorical).items()])
    medians = column_medians(typed, numeric)  # flags are never missing
    modes, levels, sizes = {}, None, {}
    if categorical:
        counts = level_counts(typed, categorical)
        modes = column_modes(counts, categorical)
        levels = level_table(counts, modes)
        sizes = {r["feature"]: r["count"] for r in levels.groupBy("feature").count().collect()}  # one row per column
    plain = [*numeric, *boolean]
    filled = typed.fillna(medians) if medians else typed
    moments = filled.agg(
        *[F.avg(c).alias(f"m_{c}") for c in plain], *[F.stddev_pop(c).alias(f"s_{c}") for c in plain]
    ).first() if plain else {}
    return Preprocessor(
        numeric, boolean, categorical, medians,
        means={c: moments[f"m_{c}"] for c in plain},
        scales={c: moments[f"s_{c}"] or 1.0 for c in plain},
        modes=modes, levels=levels, sizes=sizes,
    )
