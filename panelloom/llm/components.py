"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.session import materialize


def _minima(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour per node, the node itself included; aggregated before the shuffle."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_minima(both), "u").filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from larger to smaller nodes."""
    linked = links.join(_minima(links), "u")
    spread = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return spread.union(linked.select("u", F.col("m").alias("v")))


def roots(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``links`` (u, v: long) to ``(node, root)``: the smallest node reachable, for each linked node but the roots.

    Every round is written to the shared folder; the driver sees two figures of it. The number of rounds
    grows with the logarithm of the largest component.
    """
    ordered = lambda df: df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = materialize(ordered(links), "links"), None
    for _ in range(most_rounds):
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == before or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(mark)
        now = materialize(ordered(_small_star(ordered(_large_star(now)))), "links")
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
