"""Versioned tables: a reader sees whole versions, a writer may rewrite the table it reads.

Data folders are written once and never changed. A version exists from the moment its manifest, a small JSON file, is
renamed into place; the rename refuses a number that is taken, so of two writers that started from one version one
fails. On a store whose rename is not atomic two writers at once must be kept apart by other means; readers are
safe there too, as a manifest is written before it is renamed.

Folders below a base: ``data/<id>`` (Parquet), ``bounds/<id>`` (keys at the ends of the pieces of sorted files),
``versions/<number>.json``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.operators.radix import ordered_bits
from panelloom.sources.writers import write_table


class VersionConflict(RuntimeError):
    """Another writer has published a version since the one this writer began with."""


@dataclass(frozen=True)
class Version:
    number: int
    data: str
    bounds: str | None
    schema: T.StructType
    rows: int
    partition_by: list[str]
    sort_by: list[str]


class _Folder:
    """Files of a base folder through Hadoop's file systems, so any store Spark can write will do."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.base = base.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[tuple[str, float]]:
        """Names and times of change, in seconds."""
        if not self.fs.exists(self.path(folder)):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in self.fs.listStatus(self.path(folder))]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write ``text`` aside and rename it; fails where ``name`` exists."""
        aside = f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        self.fs.mkdirs(self.path(aside).getParent())
        stream = self.fs.create(self.path(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.jvm.java.lang.reflect.Array.newInstance(kinds.NONE.getClass(), 0)
        target = self.fs.makeQualified(self.path(name))
        try:
            context.rename(self.fs.makeQualified(self.path(aside)), target, none)
        except Exception as error:
            self.fs.delete(self.path(aside), False)
            if self.fs.exists(target):
                raise VersionConflict(f"{target} was published by another writer") from error
            raise


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(n[:-5]) for n, _ in folder.names("versions") if n.endswith(".json") and not n.startswith("."))


def _manifest(number: int) -> str:
    return f"versions/{number:020d}.json"


def describe(spark: SparkSession, base: str, number: int | None = None) -> Version:
    """A version, the last one if no number is given."""
    folder = _Folder(spark, base)
    numbers = _numbers(folder)
    if not numbers or (number is not None and number not in numbers):
        raise FileNotFoundError(f"{base} has no version {number or ''}".rstrip())
    found = json.loads(folder.read(_manifest(number or numbers[-1])))
    return Version(**{**found, "schema": T.StructType.fromJson(found["schema"])})


def read_current(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """Rows of a version. Versions that come later do not change what has been read."""
    version = describe(spark, base, number)
    return spark.read.schema(version.schema).parquet(f"{base.rstrip('/')}/{version.data}")


def commit_version(
    df: DataFrame, base: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> Version:
    """Write ``df`` as the next version; it may read any earlier one, the current one included.

    A write that fails leaves the current version as it is and removes its own files. With ``sort_by`` the rows are in
    order within each partition folder; that is proved from the files before the version is published.
    """
    spark = df.sparkSession
    folder = _Folder(spark, base)
    before = max(_numbers(folder), default=0)
    name = uuid.uuid4().hex
    data, bounds = f"data/{name}", f"bounds/{name}" if sort_by else None
    try:
        write_table(df, f"{folder.base}/{data}", "parquet", partition_by, sort_by, mode="errorifexists")
        back = spark.read.schema(df.schema).parquet(f"{folder.base}/{data}")
        if sort_by:
            file_pieces(back, sort_by).write.parquet(f"{folder.base}/{bounds}")
            pieces = spark.read.parquet(f"{folder.base}/{bounds}")
            if key_bounds(pieces, sort_by).filter("NOT in_order").limit(1).count():
                raise ValueError(f"rows are not in the order of {list(sort_by)}")
        found = {
            "number": before + 1, "data": data, "bounds": bounds, "schema": df.schema.jsonValue(), "rows": back.count(),
            "partition_by": list(partition_by), "sort_by": list(sort_by),
        }
        folder.publish(_manifest(before + 1), json.dumps(found))
    except BaseException:
        for part in (data, bounds):
            if part:
                folder.delete(part)
        raise
    return describe(spark, base, before + 1)


def expire_versions(spark: SparkSession, base: str, keep: int = 1, orphan_seconds: float = 7 * 86400) -> int:
    """Delete all but the last ``keep`` versions; returns how many went.

    Folders that no manifest names, left by a writer that died, go once they are ``orphan_seconds`` old.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    folder = _Folder(spark, base)
    numbers = _numbers(folder)
    gone = numbers[:-keep]
    kept = {describe(spark, base, n).data.split("/")[1] for n in numbers[-keep:]}
    for number in gone:
        version = describe(spark, base, number)
        folder.delete(_manifest(number))  # first the pointer, so that no reader meets half a version
        for part in (version.data, version.bounds):
            if part:
                folder.delete(part)
    for kind in ("data", "bounds"):
        for name, changed in folder.names(kind):
            if name not in kept and time.time() - changed >= orphan_seconds:
                folder.delete(f"{kind}/{name}")
    return len(gone)


# -- order of sorted files ------------------------------------------------------------------


def _comparable(name: str, kind: T.DataType) -> Column:
    """A column that Arrow compares as Spark sorts: NaN is the largest number and -0.0 equals 0.0."""
    col = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return ordered_bits(col.cast("double"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"cannot prove the order of {name}: {kind.simpleString()}")
    return col.cast("binary") if isinstance(kind, T.StringType) else col


def _steps_down(columns: Sequence[pa.Array]) -> np.ndarray:
    """For every row but the first, whether it sorts before the row above it; nulls come first."""
    n = len(columns[0]) - 1
    down, equal = np.zeros(n, bool), np.ones(n, bool)
    for col in columns:
        above, below = col.slice(0, n), col.slice(1, n)
        known_above, known_below = (x.is_valid().to_numpy(zero_copy_only=False) for x in (above, below))
        greater = pc.fill_null(pc.greater(above, below), False).to_numpy(zero_copy_only=False)
        same = pc.fill_null(pc.equal(above, below), False).to_numpy(zero_copy_only=False)
        down |= equal & (greater | (known_above & ~known_below))
        equal &= same | (~known_above & ~known_below)
    return down


def file_pieces(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per run of a file that a task reads: rows, keys at both ends, and whether no row steps down in between.

    One scan of the keys, no exchange. ``files`` is a plain scan of Parquet files.
    """
    types = {k: files.schema[k].dataType for k in keys}
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    codes = [_comparable(k, types[k]).alias(f"_code_{i}") for i, k in enumerate(keys)]
    values = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (("file", T.StringType()), ("start", T.LongType()), ("rows", T.LongType()), ("in_order", T.BooleanType()))]
        + [T.StructField(f"{end}_{k}", types[k]) for end in ("first", "last") for k in keys]
    )
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held = None, None  # the piece so far and, as a batch of one, its last row
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            skip = whole.num_rows - batch.num_rows
            file = whole.column(0)
            down = _steps_down(whole.columns[2 : 2 + width])
            at = whole.column(1).to_numpy(zero_copy_only=False)
            turns = pc.not_equal(file.slice(0, len(file) - 1), file.slice(1)).to_numpy(zero_copy_only=False) | (np.diff(at) != 1)
            ends = [skip, *[i + 1 for i in np.flatnonzero(turns) if i + 1 > skip], whole.num_rows]
            if skip and turns[0]:
                yield emit(piece)
                piece = None
            for begin, end in zip(ends, ends[1:]):
                if piece is not None and begin > skip:
                    yield emit(piece)
                    piece = None
                inner = down[begin : end - 1].any()
                joined = piece is not None and bool(down[begin - 1])
                if piece is None:
                    piece = {"file": file[begin].as_py(), "start": int(at[begin]), "rows": 0, "in_order": True, "first": ends_of(whole, begin)}
                piece["rows"] += end - begin
                piece["in_order"] &= not (inner or joined)
                piece["last"] = ends_of(whole, end - 1)
            held = whole.slice(whole.num_rows - 1)
        if piece is not None:
            yield emit(piece)

    def ends_of(whole: pa.RecordBatch, row: int) -> list[pa.Array]:
        return [c.slice(row, 1) for c in whole.columns[2 + width :]]

    def emit(piece: dict) -> pa.RecordBatch:
        fixed = [pa.array([piece[c]]) for c in ("file", "start", "rows", "in_order")]
        return pa.RecordBatch.from_arrays([*fixed, *piece["first"], *piece["last"]], names=schema.names)

    return files.select(*place, *codes, *values).mapInArrow(run, schema)


def key_bounds(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per folder and file: rows, first and last keys, and whether its rows and the file before are in order.

    Neighbours are compared over the pieces, of which there are as many as tasks that read the files.
    """
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("folder")
    number = F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).cast("long").alias("number")
    first, last = (F.struct(*[F.col(f"{end}_{k}") for k in keys]) for end in ("first", "last"))
    along = Window.partitionBy("folder").orderBy("number", "file", "start")
    placed = pieces.select("*", folder, number).withColumn("_before", F.lag(last).over(along))
    met = placed.withColumn("_met", F.col("_before").isNull() | (F.col("_before") <= first))
    at = F.struct("start")
    return met.groupBy("folder", "number", "file").agg(
        F.sum("rows").alias("rows"),
        *[F.min_by(f"first_{k}", at).alias(f"first_{k}") for k in keys],
        *[F.max_by(f"last_{k}", at).alias(f"last_{k}") for k in keys],
        F.bool_and(reduce(and_, [F.col("in_order"), F.col("_met")])).alias("in_order"),
    )


def version_bounds(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """:func:`key_bounds` of a sorted version, from what was stored with it."""
    version = describe(spark, base, number)
    if version.bounds is None:
        raise ValueError(f"version {version.number} of {base} is not sorted")
    return key_bounds(spark.read.parquet(f"{base.rstrip('/')}/{version.bounds}"), version.sort_by)
