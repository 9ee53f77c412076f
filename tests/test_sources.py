import pathlib

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from panelloom import session
from panelloom.sources import readers, writers


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text("zcta5,year,price\n1,2012,5.5\n00002,2013,NA\n123456,2014,\n")
    (tmp_path / "b.txt").write_text("GEOID|NAME|EXTRA\n06001|Alameda County|x\n|None|y\n")
    return tmp_path


def test_text_scan_projects_and_nulls(spark, folder, rows):
    df = readers.read_text_table(spark, str(folder / "a.csv"), ["price", "zcta5"])
    assert df.dtypes == [("price", "string"), ("zcta5", "string")]
    assert [r["price"] for r in rows(df, "zcta5")] == ["5.5" if r["zcta5"] == "1" else None for r in rows(df, "zcta5")]


def test_delimited_scan(spark, folder, rows):
    out = rows(readers.read_text_table(spark, str(folder / "b.txt"), ["GEOID", "NAME"], sep="|"), "GEOID")
    assert out == [{"GEOID": "06001", "NAME": "Alameda County"}, {"GEOID": None, "NAME": None}]


def test_keyed_scan_and_round_trip(spark, folder, rows):
    df = readers.read_keyed(spark, str(folder / "a.csv"), "zcta5 string, year string, price double")
    assert [(r["zcta5"], r["year"]) for r in rows(df, "year")] == [("00001", 2012), ("00002", 2013), ("123456", 2014)]
    out = str(folder / "panel")
    writers.write_table(df, out, partition_by=["year"], sort_by=["zcta5"])
    again = readers.read_keyed(spark, out)
    assert rows(again.select(*df.columns), "year") == rows(df, "year")
    writers.write_table(df, str(folder / "csv"), fmt="csv", sort_by=["zcta5", "year"])
    assert readers.read_text_table(spark, str(folder / "csv")).count() == 3


def test_bad_year_fails(spark, folder):
    (folder / "c.csv").write_text("zcta5,year\n1,soon\n")
    with pytest.raises(PySparkException):
        readers.read_keyed(spark, str(folder / "c.csv"), "zcta5 string, year string").collect()


def test_versions_never_overwrite(spark, folder, rows):
    base = str(folder / "metrics")
    writers.write_version(spark.range(2), base, "1")
    again = readers.read_table(spark, f"{base}/version=1")
    writers.write_version(again.selectExpr("id", "id * 2 AS twice"), base, "2")
    assert rows(writers.read_version(spark, base, "2"), "id")[1] == {"id": 1, "twice": 2}
    with pytest.raises(PySparkException):
        writers.write_version(again, base, "1")


def test_key_rows_and_literals(spark, rows):
    df = readers.literal_table(spark, [("1", 2012), ("1", 2012), (None, 2013)], "zcta5 string, year int")
    assert rows(readers.key_rows(df, {"zcta5": 5, "year": None})) == [{"zcta5": "00001", "year": 2012}]


def test_materialize_reads_what_it_wrote_and_releases(spark):
    df = session.materialize(spark.range(5).selectExpr("id", "id % 2 AS odd"), "probe")
    path = df.inputFiles()[0]
    assert df.count() == 5 and session.shared_dir(spark).rstrip("/") in path
    local = pathlib.Path(path.removeprefix("file://"))
    assert local.exists() and session.release(spark) >= 1 and not local.exists()
    assert session.release(spark) == 0


def test_shared_dir_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_quotes_line_breaks_and_blanks_survive(spark, tmp_path, rows):
    odd = [(1, 'a ""b"", c', " x "), (2, "line\nbreak, \"q\"", None), (3, "back\\slash", "")]
    df = spark.createDataFrame(odd, "k int, a string, b string")
    writers.write_table(df, str(tmp_path / "odd"), fmt="csv")
    got = rows(readers.read_text_table(spark, str(tmp_path / "odd"), multi_line=True), "k")
    assert [(int(r["k"]), r["a"]) for r in got] == [(k, a) for k, a, _ in odd]
    assert [r["b"] for r in got] == [" x ", None, None]


def test_other_header_or_cell_count_fails(spark, tmp_path):
    (tmp_path / "swapped").mkdir()
    (tmp_path / "swapped" / "1.csv").write_text("zip,v\n10,1\n")
    (tmp_path / "swapped" / "2.csv").write_text("v,zip\n2,20\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_text_table(spark, str(tmp_path / "swapped"), ["zip"]).collect()
    (tmp_path / "surplus.csv").write_text("zip,v\n10,1,7\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_text_table(spark, str(tmp_path / "surplus.csv"), ["zip"]).collect()
