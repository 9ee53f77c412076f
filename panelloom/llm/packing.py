"""Packing documents into sequences of one length by cutting-stock column generation.

1. Each document becomes token ids and an end id, cut into pieces of the full length and a shorter last piece.
2. The lengths of the pieces are counted; the histogram has at most ``capacity`` rows.
3. :mod:`cutting_stock` turns it into patterns and how many sequences follow each.
4. Pieces of a size class are ranked, and a rank picks its pattern, sequence and place.

The ids are made once and not shuffled: pieces carry their length and checksum, and only these narrow rows move.
A class that holds most pieces is ranked in as many buckets as there are shuffle partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm import cutting_stock
from panelloom.llm.tokens import encoder, in_groups
from panelloom.session import materialize

CAPACITY = 2048
#: Lengths are planned in units of so many tokens; a piece wastes less than one unit.
UNIT = 4
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document, with their ids as bytes (unsigned 32 bits, little-endian) if asked for.

    A null or empty text is one piece: the end id. Repeated rows and keys are documents of their own; a null
    key stays null. Only the two columns are read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(tokenizer) as e:
            yield from cut_with(e.ids_of, batches)

    def cut_with(ids_of, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            encoded = chain.from_iterable(map(ids_of, in_groups(t.as_py() for t in batch.column(1))))
            for k, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                blob = memoryview(ids + end)
                for at in range(0, len(blob), 4 * capacity):
                    piece = blob[at : at + 4 * capacity]
                    row = (k, at // 4, len(piece) // 4, zlib.crc32(piece), len(blob) // 4)
                    rows.append((*row, bytes(piece)) if with_ids else row)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, kinds, strict=True)], names=names)

    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """Give every piece a ``sequence_id`` and an ``offset``; all other columns stay.

    ``pieces`` must be a stored table: it is read twice. Pieces fill a sequence without gaps from 0, and none
    holds more than ``capacity``. Which of two pieces of one size class goes where follows a hash of their
    document, so repeated rows are placed side by side in no particular order.
    """
    spark = pieces.sparkSession
    size = F.least(F.ceil(F.col("length") / unit), F.lit(capacity // unit)).cast("int")
    units = capacity // unit
    slots = materialize(_slots(pieces.groupBy(size.alias("size")).count(), units), "slots")

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    sized = pieces.select(
        F.struct(*kept).alias("piece"), size.alias("size"),
        F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    offsets = sized.groupBy("size", "bucket").count()
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("size", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("size", "bucket").orderBy("piece.doc_id", "piece.start", "piece.length")
    ranked = (
        sized.withColumn("inside", F.row_number().over(inside) - 1)
        .join(offsets, ["size", "bucket"])
        .select("piece", "size", (F.col("inside") + F.col("before")).alias("rank"))
    )
    # The slot table has a few rows per pattern; patterns are no more than size classes and left-over bins.
    placed = ranked.join(
        F.broadcast(slots), (ranked["size"] == slots["slot_size"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    ).select(
        "piece",
        (F.col("first_sequence") + (F.col("rank") - F.col("lo")) % F.col("times")).alias("sequence_id"),
        (F.col("place") + F.floor((F.col("rank") - F.col("lo")) / F.col("times"))).alias("place"),
    )
    # A sequence has at most capacity pieces.
    filled = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("piece.length").over(filled), F.lit(0)).cast("long")
    return placed.select("piece", "sequence_id", offset.alias("offset")).select("piece.*", "sequence_id", "offset")


def _slots(histogram: DataFrame, units: int) -> DataFrame:
    """For each size class, the ranges of ranks that each pattern takes.

    ``histogram`` has at most ``units`` rows whatever the table, so one task plans from all of them.
    """

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        demand = np.zeros(units + 1, np.int64)
        for batch in batches:
            demand[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
        rows, taken, sequence = [], {}, 0
        for pattern, times in cutting_stock.plan(demand, units):
            place = 0
            for size, n in pattern:
                lo = taken.get(size, 0)
                rows.append((size, lo, lo + n * times, sequence, times, place))
                taken[size] = lo + n * times
                place += n
            sequence += times
        names = ["slot_size", "lo", "hi", "first_sequence", "times", "place"]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        kinds = [pa.int32(), *[pa.int64()] * 4, pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "slot_size int, lo long, hi long, first_sequence long, times long, place int"
    return histogram.coalesce(1).mapInArrow(planned, schema)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, unit: int = UNIT, text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    An empty table gives an empty result.
    """
    pieces = materialize(cut_pieces(docs, tokenizer, end_id, capacity, text, key), "pieces")
    return place_pieces(pieces, capacity, unit)


def sequences(placed: DataFrame, docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The token ids of each sequence, padded with nothing: sequence_id, length, ids as bytes.

    Needs distinct document ids; ids are made again rather than kept, as they outweigh the texts.
    """
    pieces = cut_pieces(docs, tokenizer, end_id, capacity, with_ids=True).select("doc_id", "start", "ids")
    joined = placed.select("doc_id", "start", "length", "sequence_id", "offset").join(pieces, ["doc_id", "start"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")
    )
