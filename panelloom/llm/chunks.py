"""Rounds of question and answer between chunks of documents and buckets of hashes.

Documents are stored once as chunks of bounded size, bucketed by chunk number, so that joining answers to them
never shuffles a text. In a round every chunk asks about some hashes: it packs the distinct ones by bucket, one row
per bucket. A bucket sees all askers of a hash and answers each with one byte per hash asked. A hash that occurs
in a third of all documents costs one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.session import new_table

CHUNK_BYTES = 1 << 20
#: Text in a bucket, as Catalyst estimates it, and the most buckets its tables may have.
BUCKET_BYTES, MOST_BUCKETS = 1 << 30, 100_000
UNKNOWN_BYTES = 1 << 56
ANSWERS = "array<struct<bucket:int,answer:binary>>"
#: Sorts after every document: a null id is smaller than no other.
NO_ID = np.iinfo(np.int64).max
_CHUNK = "chunk long, doc_ids array<long>, texts array<string>"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[int, np.ndarray] = {}


def store_chunks(docs: DataFrame, text: str = "text", key: str = "doc_id", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, doc_ids, texts)`` as a table bucketed by chunk in the shared folder.

    A chunk ends with the document that reaches ``chunk_bytes``. Chunk numbers are fixed by being stored.
    """
    spark = docs.sparkSession

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 33, [], [], 0
        kinds = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string()))])
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(k)
                texts.append(t.as_py())
                size += len(texts[-1] or "")
                if size >= chunk_bytes or len(ids) >= 20_000:
                    yield pa.RecordBatch.from_pylist([{"chunk": number, "doc_ids": ids, "texts": texts}], schema=kinds)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([{"chunk": number, "doc_ids": ids, "texts": texts}], schema=kinds)

    n = text_buckets(docs)
    name, path = new_table(spark, "chunks")
    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    (
        chosen.mapInArrow(build, _CHUNK).repartition(n, "chunk")
        .write.bucketBy(n, "chunk").sortBy("chunk").option("path", path)
        .option("compression", "zstd").saveAsTable(name)
    )
    return spark.table(name)


def text_buckets(docs: DataFrame) -> int:
    """Buckets of the stored texts: by the size Catalyst sees, and no fewer than the session's partitions.

    Rows that come from no file have no size there; then the session's partitions are taken.
    """
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_BUCKETS, -(-size // BUCKET_BYTES))) if size < UNKNOWN_BYTES else least


def buckets_of(docs: DataFrame) -> int:
    """Buckets of hashes per round: enough that one fits a task, growing with the texts."""
    return 4 * text_buckets(docs)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of an odd factor modulo 2**64, or of its inverse."""
    base = pow(int(_ODD), -1, 1 << 64) if inverse else int(_ODD)
    if inverse not in _powers or len(_powers[inverse]) < n:
        steps = np.full(max(n, 1 << 21), base, np.uint64)
        steps[0] = 1
        _powers[inverse] = np.cumprod(steps)
    return _powers[inverse][:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running sums from which :func:`range_hashes` takes the hash of any stretch."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, powers(len(values)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch ``[start, end)``: equal values give equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), True)[starts] + (ends - starts).astype(np.uint64))


def windowed_min(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the smallest by its high bits, the first of equals."""
    bits = np.uint64(max(20, len(hashes).bit_length()))
    best = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span < width:  # minima of runs twice as long, the last step overlapping
        step = min(span, width - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def pack(hashes: np.ndarray, n_buckets: int, route: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``hashes`` (distinct) by bucket, then value; and the edges of the buckets in that order.

    The bucket is that of ``route``, another hash that goes with each, if given.
    """
    bucket = bucket_of(hashes if route is None else route, n_buckets)
    order = np.lexsort((hashes, bucket))
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(hashes ^ _ODD) % np.uint64(n_buckets)).astype(np.int64)


def answers_for(
    hashes: np.ndarray, replies: list[dict], n_buckets: int, route: np.ndarray | None = None
) -> np.ndarray:
    """One byte for each of the distinct ``hashes`` that were asked, in their order."""
    order, edges = pack(hashes, n_buckets, route)
    out = np.zeros(len(hashes), np.uint8)
    for r in replies:
        lo, hi = edges[r["bucket"]], edges[r["bucket"] + 1]
        out[order[lo:hi]] = np.frombuffer(r["answer"], np.uint8)
    return out


def ask(
    rows: DataFrame, question: Callable, answer: Callable, columns: dict[str, np.dtype], n_buckets: int
) -> DataFrame:
    """One round: ``(chunk, answers)`` for the chunk rows that asked something.

    ``question(row)`` gives distinct hashes and, for each of ``columns`` but the first, which is the hash as it
    travels, a value per hash; and, if the hash itself does not choose the bucket, one that does.
    ``answer(arrays, owners)`` sees the rows of one bucket as joined arrays, with the asker of each entry as a
    number, and returns a byte per entry.
    """
    kinds = list(columns.items())

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, values, *route = question(row)
                order, edges = pack(hashes, n_buckets, *route)
                arrays = [a[order].astype(d) for a, (_, d) in zip([hashes, *values], kinds, strict=True)]
                full = np.flatnonzero(np.diff(edges))
                cut = lambda a: [a[edges[b] : edges[b + 1]].tobytes() for b in full]  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([row["chunk"]] * len(full), pa.int64()), *[pa.array(cut(a), pa.binary()) for a in arrays]],
                    names=["bucket", "chunk", *columns],
                )

    def answered(group: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(b) // kinds[0][1].itemsize for b in group[kinds[0][0]]]
        arrays = [np.frombuffer(b"".join(group[name]), d) for name, d in kinds]
        found = answer(arrays, np.repeat(np.arange(len(group)), sizes)).astype(np.uint8)
        ends = np.cumsum(sizes)
        cut = [found[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
        return pd.DataFrame({"chunk": group["chunk"], "bucket": group["bucket"], "answer": cut})

    asked = rows.mapInArrow(questions, "bucket int, chunk long, " + ", ".join(f"{c} binary" for c in columns))
    replies = asked.groupBy("bucket").applyInPandas(answered, "chunk long, bucket int, answer binary")
    return replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))


def short(hashes: np.ndarray) -> np.ndarray:
    """The part of a hash that travels beside its bucket where a false match does no harm."""
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
