"""Delimited text whose quoted cells hold line breaks, read in byte splits.

A line break ends a record only outside quotes, that is where the number of quotes before it is even. A split cannot
see the quotes before it, so:

1. one scan counts the quotes of each split (aggregated in the tasks: one row per split);
2. running sums along each file give the parity at the start of every split;
3. a second scan joins lines into records within each split; what is cut by the end of a split, at most two pieces
   per split, is put together apart, from a scan of the splits that start or end inside quotes only.

Splits are named by file and first byte. A split of the second scan that the first did not have is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.session import materialize

_SPLIT = ["file", "block"]
_RECORD = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("record", pa.string()), ("first", pa.bool_())])
_DDL = "file string, block long, part int, record string, first boolean"
#: What a piece of text is: a whole record, or one that goes on into the next split, fills its split, or came from the last.
_WHOLE, _HEAD, _INSIDE, _TAIL = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def split_parities(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``(file, block, opens, closes)``: whether a split starts, and ends, inside quotes. A stored row per split."""
    n = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    odd = F.pmod(F.sum(n), F.lit(2)).cast("int")
    counted = _lines(spark, path).groupBy(*_SPLIT).agg(odd.alias("odd"))
    along = Window.partitionBy("file").orderBy("block")
    after = F.pmod(F.sum("odd").over(along), F.lit(2)) == 1
    placed = counted.withColumn("closes", after).withColumn("last", F.lead("block").over(along).isNull())
    shut = F.when(F.col("last") & F.col("closes"), F.raise_error(F.concat(F.lit("a quote is not closed in "), "file")).cast("boolean"))
    opens = F.coalesce(F.lag("closes").over(along), F.lit(False))
    return materialize(placed.select(*_SPLIT, opens.alias("opens"), F.coalesce(shut, "closes").alias("closes")), "split-parities")


def _joiner(quote: str, pieces: bool):
    """A task's lines, in order, to records: whole ones, or with ``pieces`` those cut by an end of the split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, odd, begun, number = None, [], 0, False, 0
        out: list[tuple] = []

        def put(lines: list[str], ends: bool) -> None:
            nonlocal begun, number
            part = _WHOLE if begun and ends else _HEAD if begun else _TAIL if ends else _INSIDE
            if (part != _WHOLE) == pieces:
                out.append((*now, part, lines[0] if len(lines) == 1 else "\n".join(lines), now[1] == 0 and number == 0))
            begun, number = True, number + 1

        for batch in batches:
            values = batch.column(0).to_pylist()
            counts = pc.count_substring(batch.column(0), quote).to_numpy(zero_copy_only=False)
            files, blocks, opens = batch.column(1), batch.column(2).to_numpy(), batch.column(3)
            changes = np.flatnonzero(np.diff(blocks) != 0) + 1
            # Splits of different files may start at the same byte.
            names = pc.dictionary_encode(files).indices.to_numpy() if batch.num_rows else np.zeros(0, np.int32)
            changes = np.union1d(changes, np.flatnonzero(np.diff(names) != 0) + 1).astype(int)
            for lo, hi in zip([0, *changes], [*changes, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                split = (files[int(lo)].as_py(), int(blocks[lo]))
                if split != now:
                    if held:
                        put(held, False)
                    now, held, number = split, [], 0
                    odd = int(opens[int(lo)].as_py())
                    begun = not odd
                state = (odd + np.cumsum(counts[lo:hi])) & 1
                odd, start = int(state[-1]), int(lo)
                for end in (np.flatnonzero(state == 0) + lo).tolist():
                    put(held + values[start : end + 1] if held else values[start : end + 1], True)
                    held, start = [], end + 1
                held = held + values[start:hi]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RECORD, strict=True)], schema=_RECORD)
                out.clear()
        if held:
            put(held, False)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RECORD, strict=True)], schema=_RECORD)

    return run


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``(file, record, first)``: every record of the files as one text, line breaks in quotes included.

    ``first`` marks the first record of a file. Records are not in order; empty ones are left out.
    """
    splits = split_parities(spark, path, quote)
    named = splits.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "opens", "closes")
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    unknown = F.raise_error(F.lit("the files were split differently in two scans; set spark.sql.files.minPartitionNum")).cast("boolean")
    lines = _lines(spark, path)
    # A row per split, as the driver's own list of splits has; a join that moved the lines would lose their order.
    each = lines.join(F.broadcast(named), same, "left").select("value", *_SPLIT, F.coalesce("opens", unknown).alias("opens"))
    cut = lines.join(F.broadcast(named.filter("opens OR closes")), same).select("value", *_SPLIT, "opens")
    whole = each.mapInArrow(_joiner(quote, False), _DDL).select("file", "record", "first")
    # Pieces in order: those before the next head belong to the head's record; at most two rows per split.
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("part") == _TAIL, 0).otherwise(1))
    pieces = cut.mapInArrow(_joiner(quote, True), _DDL).withColumn("number", F.sum((F.col("part") == _HEAD).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    mended = pieces.groupBy("file", "number").agg(parts.alias("parts"), F.bool_or("first").alias("first"))
    mended = mended.select("file", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), "first")
    bare = F.regexp_replace("record", "\r$", "")
    return whole.unionByName(mended).select("file", bare.alias("record"), "first").filter("record <> ''")


def check_quotes(record: Column, sep: str, quote: str = '"') -> Column:
    """The record; an error if a quote stands inside a cell that is not quoted, as its parity would mislead."""
    mark = "\x01"
    marked = F.regexp_replace(F.replace(record, F.lit(mark), F.lit("")), f"{quote}[^{quote}]*{quote}", mark)
    other = f"[^{mark}\\Q{sep}\\E]" if sep != "\\" else f"[^{mark}\\\\]"
    stray = marked.rlike(f"{other}{mark}|{mark}{other}|{quote}")
    return F.when(stray, F.raise_error(F.concat(F.lit("a quote inside a cell without quotes: "), record)).cast("string")).otherwise(record)
