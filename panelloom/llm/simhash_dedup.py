"""Near duplicates by SimHash with covering locality-sensitive hashing.

Every bit position gets a non-zero vector of ``radius + 1`` bits, and every non-zero vector ``v`` a table whose
mask holds the positions whose vector has an odd product with ``v``. At most ``radius`` differing positions
span fewer than ``radius + 1`` dimensions, so some ``v`` is orthogonal to all of them: in its table the pair
agrees on the whole mask. No pair within the radius is missed.

A bucket of a table may be large, so its members are not compared pairwise. Two members differ only in
positions the mask leaves free, and two fingerprints at most 2 apart share a fingerprint that is at most one
flip from each. Members therefore meet at such midpoints, where all that meet are within the radius of each
other and no more than 65 fingerprints can meet; each is linked to the smallest.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.components import roots
from panelloom.llm.workers import tidy
from panelloom.session import materialize

BITS = 64
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = 1 << 15


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()  # splits at exactly the blanks of the contract
    if not words:
        return 0
    shingles = [b" ".join(g) for g in zip(*(words[i:] for i in range(width)), strict=False)] or [b" ".join(words)]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), _STEP):
        part = shingles[at : at + _STEP]
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in part), "<u8", len(part))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``fp`` (signed) per row; a null text has no words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(tidy(scan), "doc_id long, fp long")


def _fingerprint_of(width: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t if isinstance(t, str) else None, width))

    return of


def masks(radius: int) -> list[int]:
    """The covering masks as signed 64-bit numbers."""
    size = (1 << (radius + 1)) - 1
    vector = [i % size + 1 for i in range(BITS)]
    unsigned = [sum(1 << i for i in range(BITS) if (v & vector[i]).bit_count() & 1) for v in range(1, size + 1)]
    return [_signed(m) for m in unsigned]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def link_fingerprints(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(u, v)`` whose components are those of all pairs of distinct ``fp`` at most ``radius`` apart."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for t, m in enumerate(masks(radius))])
    rows = fps.select("fp", F.explode(tables).alias("b")).select("fp", "b.t", "b.part")
    shared = rows.groupBy("t", "part").count().filter("count > 1").select("t", "part")
    rows = rows.join(shared, ["t", "part"])
    # Midpoints: up to radius // 2 flips of free positions, and one more on one side if the radius is odd.
    flips = [_signed(sum(1 << i for i in c)) for n in range(-(-radius // 2) + 1) for c in combinations(range(BITS), n)]
    free = F.filter(F.array(*[F.lit(f) for f in flips]), lambda f: f.bitwiseAND(_mask_of(F.col("t"), radius)) == 0)
    met = rows.select("fp", "t", F.explode(free).alias("flip")).select(
        "fp", "t", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"), F.bit_count("flip").alias("far")
    )
    hub = F.min("fp").over(Window.partitionBy("t", "mid"))
    linked = met.select(F.col("fp").alias("u"), hub.alias("v")).filter("u <> v")
    if radius % 2 == 0:
        return linked.distinct()
    # With an odd radius two at a midpoint may be radius + 1 apart, so those on the outer shell meet the inner only.
    inner = F.min(F.when(F.col("far") <= radius // 2, F.col("fp"))).over(Window.partitionBy("t", "mid"))
    return met.select(F.col("fp").alias("u"), inner.alias("v")).filter("u <> v").distinct()


def _mask_of(t: Column, radius: int) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in masks(radius)]), t + 1)


def components(docs: DataFrame, width: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, fp, component_id (the smallest doc_id reachable).

    Equal fingerprints are one node, so copies are never compared. Texts without words share fingerprint 0 and
    are linked like any other. Null keys count for no component's smallest id; a component of null keys alone
    has a null id. Repeated rows are rows of their own. An empty table gives an empty result.
    """
    marked = materialize(fingerprints(docs, width, text, key), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    settled = roots(link_fingerprints(nodes.select("fp"), radius))
    rooted = nodes.join(settled.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The input rows less all but one of each component: the row with the smallest key, all columns as they were.

    If that key is repeated, the row with the smallest fingerprint stays, and of equal ones any. A component
    whose keys are all null keeps one row per fingerprint. ``docs`` must be a stored table: it is read twice.
    """
    labels = materialize(components(docs, width, radius, text, key), "labels")
    no_key = F.col("doc_id").isNull()
    winners = labels.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("apart")).agg(
        F.min_by(F.struct("doc_id", "fp"), F.struct(no_key, "doc_id", "fp")).alias("w"),
    )
    # Rows meet the keys that go, which are fewer than those that stay; a key that occurs more than once (hardly any
    # does) goes as well, and its winning rows are found by fingerprint.
    kept = winners.select(F.col("w.doc_id").alias("k"), F.col("w.fp").alias("f"))
    tally = labels.groupBy("doc_id").count().join(kept, F.col("doc_id").eqNullSafe(F.col("k")), "left")
    tally = materialize(tally.select("doc_id", "count", "f"), "tally")
    gone = materialize(tally.filter("count > 1 OR f IS NULL").select(F.col("doc_id").alias("k")).distinct(), "gone")
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    once = rows.join(gone, F.col("_key").eqNullSafe(F.col("k")), "left_anti").select("_row.*")
    winners = tally.filter("count > 1 AND f IS NOT NULL").select(F.col("doc_id").alias("k"), "f")
    if not winners.limit(1).count():
        return once
    again = rows.join(winners, F.col("_key").eqNullSafe(F.col("k")))
    again = again.withColumn("_fp", _fingerprint_of(width)("_text")).filter("_fp = f")
    return once.union(again.groupBy("k", "f").agg(F.any_value("_row").alias("_row")).select("_row.*"))
