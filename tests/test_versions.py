"""Versioned tables: whole versions only, rewriting what is read, proof of order."""

import pathlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom.sources import versions, writers


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "table")


def _folders(base, kind):
    folder = pathlib.Path(base, kind)
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) if folder.exists() else []


def test_a_job_rewrites_the_table_it_reads(spark, rows, base):
    versions.commit_version(spark.range(5), base)
    old = versions.read_current(spark, base)
    second = versions.commit_version(old.selectExpr("id", "id * 2 AS twice"), base)
    assert (second.number, second.rows) == (2, 5)
    assert rows(versions.read_current(spark, base), "id")[4] == {"id": 4, "twice": 8}
    assert old.columns == ["id"] and old.count() == 5  # a reader keeps the version it began with
    assert versions.read_current(spark, base, 1).columns == ["id"]


def test_a_failed_write_leaves_the_current_version(spark, rows, base):
    versions.commit_version(spark.range(5), base)
    bad = versions.read_current(spark, base).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        versions.commit_version(bad, base)
    assert versions.describe(spark, base).number == 1 and versions.read_current(spark, base).count() == 5
    assert len(_folders(base, "data")) == 1 and len(_folders(base, "versions")) == 1  # nothing is left behind


def test_of_two_writers_one_fails(spark, base, monkeypatch):
    versions.commit_version(spark.range(1), base)
    real, inner = versions.write_table, []

    def slow(df, *args, **options):
        if not inner:  # another writer is quicker
            inner.append(True)
            versions.commit_version(spark.range(7), base)
        return real(df, *args, **options)

    monkeypatch.setattr(versions, "write_table", slow)
    with pytest.raises(versions.VersionConflict):
        versions.commit_version(spark.range(3), base)
    assert versions.read_current(spark, base).count() == 7 and versions.describe(spark, base).number == 2
    assert len(_folders(base, "data")) == 2


def test_old_versions_and_orphans_go(spark, base):
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, base)
    for n in (1, 2, 3):
        versions.commit_version(spark.range(n), base, sort_by=["id"])
    spark.range(1).write.parquet(f"{base}/data/lost")
    assert versions.expire_versions(spark, base, keep=2) == 1
    assert "lost" in _folders(base, "data") and versions.read_current(spark, base, 2).count() == 2
    assert versions.expire_versions(spark, base, keep=1, orphan_seconds=0) == 1
    assert len(_folders(base, "data")) == len(_folders(base, "bounds")) == 1 and versions.read_current(spark, base).count() == 3
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, base, 1)


def _mixed(spark, n=3000):
    rng = random.Random(4)
    texts = ["", "a", "B", "\u00e9", "\U0001F600", "\uffff", None]
    numbers = [None, float("nan"), -0.0, 0.0, 1.5, -1.5, float("inf"), float("-inf")]
    data = [(rng.choice(texts), rng.choice(numbers), rng.randrange(5), i) for i in range(n)]
    return spark.createDataFrame(data, "s string, d double, k int, i long").repartition(7)


def test_sorted_files_of_every_kind_of_key(spark, rows, base):
    df = _mixed(spark)
    version = versions.commit_version(df, base, partition_by=["k"], sort_by=["s", "d", "i"])
    bounds = rows(versions.version_bounds(spark, base))
    assert sum(r["rows"] for r in bounds) == version.rows == 3000 and all(r["in_order"] for r in bounds)
    assert len({r["folder"] for r in bounds}) == 5
    empty = versions.commit_version(df.limit(0), base, sort_by=["s"])
    assert empty.rows == 0 and versions.version_bounds(spark, base).count() == 0
    versions.commit_version(df, base)
    with pytest.raises(ValueError, match="not sorted"):
        versions.version_bounds(spark, base)


@pytest.mark.parametrize("split", ["128MB", "4KB"])
def test_unsorted_files_are_found(spark, rows, base, split):
    """One row out of place inside a file, then two files in the wrong order; files read whole and in splits."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for name, moved in (("good", None), ("inside", 700), ("first", 0), ("last", 1999)):
            keys = F.when(F.col("id") == (-1 if moved is None else moved), 1000 if moved != 1000 else 5).otherwise(F.col("id"))
            df = spark.range(0, 2000, 1, 1).select(keys.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
            df.write.option("parquet.block.size", 16 << 10).parquet(f"{base}/{name}")
            pieces = versions.file_pieces(spark.read.parquet(f"{base}/{name}"), ["key"])
            (found,) = rows(versions.key_bounds(pieces, ["key"]))
            assert found["rows"] == 2000 and found["in_order"] == (moved is None), name
        for name, step in (("up", 1), ("down", -1)):
            df = spark.range(0, 4000, 1, 4).select((F.col("id") + F.lit(0) if step > 0 else (3 - F.floor(F.col("id") / 1000)) * 1000 + F.col("id") % 1000).alias("key"))
            df.write.parquet(f"{base}/{name}")
            found = rows(versions.key_bounds(versions.file_pieces(spark.read.parquet(f"{base}/{name}"), ["key"]), ["key"]), "number")
            assert [r["in_order"] for r in found] == ([True] * 4 if step > 0 else [True, False, False, False])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_disorder_stops_a_version(spark, base, monkeypatch):
    def unsorted(df, path, fmt="parquet", partition_by=(), sort_by=(), mode="overwrite"):
        df.write.parquet(path)

    monkeypatch.setattr(versions, "write_table", unsorted)
    with pytest.raises(ValueError, match="order"):
        versions.commit_version(spark.range(50, 0, -1, 1), base, sort_by=["id"])
    assert _folders(base, "data") == _folders(base, "bounds") == _folders(base, "versions") == []
    with pytest.raises(TypeError):
        versions.file_pieces(spark.createDataFrame([([1],)], "a array<int>"), ["a"])
    assert writers.write_table is not unsorted
