"""Mixing sources to target weights: words per source, repetition rates, whole copies and one coin per document.

1. Words are counted once per document and summed per source (aggregated before the shuffle).
2. Sources in code point order take the weights in turn and share ``share`` times all words by weight. A target
   above ``most`` times its source's words stops there, and what is over is shared again among the others.
3. A source's rate is its target over its words. Each document is emitted ``floor(rate)`` times, and once more if
   its coin, a hash of its id and text, falls below the fraction.

Only figures of a round reach the driver, however many sources there are. Rates meet the documents by an equi-join
on the source, so a source that holds a third of all rows is broadcast to or split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.operators.joins import match_nulls
from panelloom.operators.ordering import number_rows
from panelloom.session import materialize

WEIGHTS = (5, 2, 1)
SHARE, MOST, SEED = 1.5, 2, 42
_DIGITS = 13  # hexadecimal digits of the coin: 52 bits, exact in a double


def words_in(text: Column) -> Column:
    """Runs of anything but the six blanks of ASCII; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def coin(key: Column, text: Column, seed: int = SEED) -> Column:
    """A number from 0 up to 1 that depends on the id, the text and the seed alone."""
    known = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, text)]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *known)), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` of a table with ``source`` and ``size``; a null source comes last.

    Every round one scan of the per-source table finds who is above the limit at the present level; the set only
    grows, so the rounds end. Sources without words get no target; if all are at the limit, that is the mix.
    """
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    placed = number_rows(totals, [], [F.col("source").asc_nulls_last()], "place", stored=True)
    turn = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int"))
    weighed = materialize(placed.select("source", "source_size", turn.alias("weight")), "source-weights")
    limit = F.col("source_size") * F.lit(float(most))
    whole, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, stopped = share * (whole or 0), 0
    while weight:
        above = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight)) > limit
        n, held, free = weighed.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == stopped:
            break
        rest, weight, stopped = share * whole - most * held, free, n
    shared = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight)) if weight else limit
    return materialize(weighed.select("source", "source_size", F.least(shared, limit).alias("target")), "targets")


def _with_copies(rows: DataFrame, rates: DataFrame) -> DataFrame:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    met = match_nulls(rows, rates, ["source"]).withColumn("_rate", rate)
    extra = (F.col("coin") < F.col("_rate") - F.floor("_rate")).cast("long")
    return met.withColumn("copies", F.floor("_rate").cast("long") + extra).drop("_rate")


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
    text: str = "text", key: str = "doc_id", source: str = "source",
) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    A null or empty text has size 0; a null source is a source of its own, the last; an empty one is the first.
    Null ids count as empty ones. Rows that agree in id and text share their coin and so their copies; rows
    that agree in one of both do not. Long texts count whole. An empty table gives an empty result. Only the
    three columns are read, once; text leaves no task.
    """
    read = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size"),
        coin(F.col(key), F.col(text), seed).alias("coin"),
    )
    sized = materialize(read, "sizes")
    planned = _with_copies(sized, targets(sized, weights, share, most))
    return planned.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
    text: str = "text", key: str = "doc_id", source: str = "source",
) -> DataFrame:
    """The input rows, each as often as :func:`mix_plan` takes it; all columns as they were, whatever their names."""
    counted = docs.select(F.col(source).alias("source"), words_in(F.col(text)).alias("size"))
    rates = targets(counted, weights, share, most)
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(source).alias("source"), coin(F.col(key), F.col(text), seed).alias("coin")
    )
    taken = _with_copies(rows, rates).filter("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
