"""Session settings and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Table sizes are those of compressed files; what is broadcast is not compressed.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Split a hot join key even when the split costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; safe to call repeatedly."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the session names in ``spark.checkpoint.dir``.

    Only where driver and tasks are one process may it be left out; then it is a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dirs.setdefault(context.applicationId, tempfile.mkdtemp(prefix="panelloom-"))


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for an intermediate table; :func:`release` deletes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """Name and folder for an intermediate table of the catalog (a bucketed one); :func:`release` drops both."""
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name, path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    This freezes the rows (a lost executor cannot change what a second reader sees) and
    gives Catalyst the real size, so a later join broadcasts the table only when its
    files are below ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this application has written; returns how many.

    Call it once the results that read them are stored.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = hadoop.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[SparkSession]:
    """Deletes, at the end of the block, the intermediate tables written since the session began."""
    try:
        yield spark
    finally:
        release(spark)
