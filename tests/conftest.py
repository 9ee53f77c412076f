import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from panelloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as a list of dicts, sorted by the given columns."""

    def collect(df, *by):
        out = [r.asDict() for r in df.collect()]
        return sorted(out, key=lambda r: tuple((r[c] is None, r[c]) for c in by)) if by else out

    return collect
