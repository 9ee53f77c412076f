"""Bounded samples of labelled texts, and the folds that training may use."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALT = 32


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0)).cast("int")


def sample(labels: DataFrame, docs: DataFrame, per_class: int, max_chars: int) -> pd.DataFrame:
    """At most ``per_class`` texts of each label, chosen by a hash of the key: columns ``text``, ``label``.

    ``labels`` has ``key`` and ``label``; ``docs`` has ``key`` and ``text``. A label is picked in 32 parts, so
    a frequent one is not ranked in one task, and only its first rows leave the tasks that read it. Texts over
    ``max_chars`` are not learnt from. What reaches the driver is bounded by the parameters and the number of
    labels; a label with few rows is taken whole.
    """
    mark = F.xxhash64("key")
    ranked = labels.filter("key IS NOT NULL AND label IS NOT NULL").select("key", "label", mark.alias("mark")).withColumn(
        "n", F.row_number().over(Window.partitionBy("label", F.pmod("mark", F.lit(_SALT))).orderBy("mark", "key"))
    )
    chosen = ranked.filter(F.col("n") <= -(-per_class // _SALT)).select("key", "label", "mark")
    # Bounded by the number of labels times per_class.
    texts = docs.join(F.broadcast(chosen), "key").filter(F.length("text") <= max_chars)
    found = texts.select("mark", "label", "text").toPandas()
    return found.sort_values(["mark", "label", "text"]).reset_index(drop=True)[["text", "label"]]
