"""Token ids in a binary table: one wavelet matrix per shard.

A shard holds the ids of consecutive documents as bit planes. Plane ``b`` keeps bit ``b`` of every id in the
order in which the planes above it have split them, zeros before ones, with a running count of ones each
512 bits. That gives token access, counting and occurrence lookup without decoding the shard.

Documents are range-partitioned by id, each partition writes its shards in order, and shards end at documents,
so nothing but a table of shard lengths is needed to know where a document starts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.tokens import encoder, in_groups

BLOCK = 512
#: Pieces that a worker keeps between tasks (about 100 MB), as the tasks of a write all use the same tokenizer.
IDLE_PIECES = 400_000
SHARD_SCHEMA = (
    "part int, shard int, n long, bits int, zeros array<long>, planes array<binary>, ranks array<binary>, "
    "doc_ids array<long>, doc_tokens array<long>"
)


class WaveletMatrix:
    """Bit planes of a sequence of non-negative integers, highest bit first."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.bits, self.zeros = n, bits, list(zeros)
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        for b in range(bits - 1, -1, -1):
            ones = (ids & ids.dtype.type(1 << b)) != 0
            plane = np.packbits(ones)
            short = -len(plane) % (BLOCK // 8)
            words = np.pad(plane, (0, short)).view(np.uint64)
            counts = np.bitwise_count(words).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
            ranks.append(np.concatenate(([0], np.cumsum(counts))).astype("<u4").tobytes())
            high = np.compress(ones, ids)
            zeros.append(len(ids) - len(high))
            planes.append(plane.tobytes())
            ids = np.concatenate((np.compress(~ones, ids), high))
        return cls(len(ids), bits, zeros, planes, ranks)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        part = np.unpackbits(self.planes[level][block * (BLOCK // 8) : -(-i // 8)])[: i - block * BLOCK]
        return int(self.ranks[level][block]) + int(part.sum())

    def _bit(self, level: int, i: int) -> int:
        return (int(self.planes[level][i >> 3]) >> (7 - (i & 7))) & 1

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` among the first ``i`` ids."""
        if value >> self.bits:
            return 0
        lo, hi = 0, i
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            one = value >> (self.bits - 1 - level) & 1
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if one else (lo - a, hi - b)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Position of occurrence ``k`` of ``value``, from 0; -1 if there are fewer."""
        if not 0 <= k < self.count(value):
            return -1
        lo, hi = 0, self.n
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self.rank(value, mid) <= k else (lo, mid)
        return lo

    def decode(self) -> np.ndarray:
        """All ids in their order, by undoing the splits from the lowest plane up."""
        out = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            back = np.empty_like(out)
            back[np.flatnonzero(ones)] = out[self.zeros[level] :] | out.dtype.type(1 << (self.bits - 1 - level))
            back[np.flatnonzero(~ones)] = out[: self.zeros[level]]
            out = back
        return out


def write_token_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, bits: int = 16, shard_tokens: int = 1 << 21,
    text: str = "text", key: str = "doc_id",
) -> None:
    """Encode every text, append ``end_id``, and write the shards to ``path``.

    Documents lie in ascending order of ``key``, nulls first; equal keys by a hash of their text, then by text,
    repeated rows side by side. A null or empty text has the end id alone. An id that needs more than ``bits``
    bits is an error. A shard ends at the first document that reaches ``shard_tokens``, so its size is bounded
    by that and one document. Only the two columns are read; an empty table writes no shard.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer, idle=IDLE_PIECES) as e:
            yield from encode_with(e.ids_of, batches)

    def encode_with(ids_of, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        part, shard, held, keys, lengths, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            if len(ids) and int(ids.max()) >> bits:
                raise ValueError(f"token id {ids.max()} needs more than {bits} bits")
            matrix = WaveletMatrix.build(ids.astype(np.uint16 if bits <= 16 else np.uint32), bits)
            row = {
                "part": part, "shard": shard, "n": matrix.n, "bits": bits, "zeros": matrix.zeros,
                "planes": [p.tobytes() for p in matrix.planes], "ranks": [r.tobytes() for r in matrix.ranks],
                "doc_ids": keys, "doc_tokens": lengths,
            }
            return pa.RecordBatch.from_pylist([row], schema=SHARD_ARROW)

        for batch in batches:
            groups = in_groups(t.as_py() for t in batch.column(1))
            blobs = (blob + end for texts in groups for blob in ids_of(texts))
            for k, blob in zip(batch.column(0).to_pylist(), blobs, strict=True):
                held.append(blob)
                keys.append(k)
                lengths.append(len(blob) // 4)
                total += len(blob) // 4
                if total >= shard_tokens:
                    yield flush()
                    shard, held, keys, lengths, total = shard + 1, [], [], [], 0
        if held:
            yield flush()

    ordered = (
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
        .repartitionByRange("key", "tie")
        .sortWithinPartitions("key", "tie", "text")
        .select("key", "text")
    )
    ordered.mapInArrow(encode, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


SHARD_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("bits", pa.int32()),
        ("zeros", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ]
)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, WaveletMatrix]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, WaveletMatrix(row["n"], row["bits"], row["zeros"], row["planes"], row["ranks"])


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard: a running sum inside a part, and one over the parts (a row per task)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "shard", "n")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    # One row per written part: the number of tasks, not of documents.
    parts = parts.select("part", zero(F.sum("n").over(before.orderBy("part"))).alias("part_start"))
    inside = zero(F.sum("n").over(before.partitionBy("part").orderBy("shard")))
    return shards.withColumn("inside", inside).join(parts, "part").select(
        "part", "shard", (F.col("inside") + F.col("part_start")).alias("shard_start")
    )


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per written document: key, start, n_tokens, ids_crc32 and, if asked for, its ids as bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, matrix in _matrices(batches):
            ids = matrix.decode().astype("<u4")
            ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
            starts = ends - np.array(row["doc_tokens"], np.int64)
            for at in range(0, len(ends), 4096):
                s, e = starts[at : at + 4096], ends[at : at + 4096]
                cut = [ids[a:b].tobytes() for a, b in zip(s, e, strict=True)]
                out = [
                    pa.array([row["part"]] * len(s), pa.int32()), pa.array([row["shard"]] * len(s), pa.int32()),
                    pa.array(row["doc_ids"][at : at + 4096], pa.int64()), pa.array(s), pa.array(e - s),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                ]
                names = ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.array(cut, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    docs = spark.read.schema(SHARD_SCHEMA).parquet(path).mapInArrow(decode, schema + (", ids binary" if with_ids else ""))
    rest = ["n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return docs.join(shard_starts(spark, path), ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), *rest
    )


def find_token(spark: SparkSession, path: str, token: int, limit_per_shard: int | None = None) -> DataFrame:
    """Occurrences of a token per shard, by rank and select alone: count and first positions."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, matrix in _matrices(batches):
            n = matrix.count(token)
            shown = n if limit_per_shard is None else min(n, limit_per_shard)
            found = [matrix.select(token, k) for k in range(shown)]
            yield pa.RecordBatch.from_pylist(
                [{"part": row["part"], "shard": row["shard"], "n_found": n, "at": found}],
                schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_found", pa.int64()), ("at", pa.list_(pa.int64()))]),
            )

    found = spark.read.schema(SHARD_SCHEMA).parquet(path).mapInArrow(
        look, "part int, shard int, n_found long, at array<long>"
    )
    return found.join(shard_starts(spark, path), ["part", "shard"]).select(
        "part", "shard", "n_found", F.transform("at", lambda p: p + F.col("shard_start")).alias("positions")
    )
