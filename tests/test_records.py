"""Multi-line delimited text read in splits: rows equal to a plain parser's wherever the splits fall."""

import csv
import random
from collections import Counter

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom.sources import readers, records, writers

SPLIT = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def cells(seed, n):
    pick = random.Random(seed)
    bits = ["a", "b,c", '"', '""', "\n", "\r\n", "naïve 東京", "x" * 40, " ", "\\", "|", "\x01"]
    return [(str(i), "".join(pick.choices(bits, k=pick.randint(1, 30))) + "z", "t") for i in range(n)]


def save(path, rows, header=("k", "a", "b"), sep=",", end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, delimiter=sep, lineterminator=end).writerows([header, *rows])


@pytest.mark.parametrize(("sep", "end", "seed"), [(",", "\n", 1), ("|", "\r\n", 2), (";", "\n", 3), ("\t", "\n", 4)])
def test_one_file_in_many_tasks(small_splits, tmp_path, sep, end, seed):
    rows = cells(seed, 300) + [("long", '"line\n' * 2000 + "z", "t")]  # fills several splits
    save(tmp_path / "one.csv", rows, sep=sep, end=end)
    df = readers.read_text_table(small_splits, str(tmp_path / "one.csv"), sep=sep, multi_line=True)
    splits = records.split_parities(small_splits, str(tmp_path / "one.csv")).collect()
    assert len(splits) > 20 and any(r["opens"] for r in splits) and not all(r["opens"] for r in splits)
    assert records.quoted_records(small_splits, str(tmp_path / "one.csv")).rdd.getNumPartitions() > 8
    assert Counter(map(tuple, df.collect())) == Counter(rows)
    few = readers.read_text_table(small_splits, str(tmp_path / "one.csv"), ["b"], sep=sep, multi_line=True)
    assert few.filter("b = 't'").count() == len(rows)


def test_files_beside_each_other(small_splits, tmp_path):
    parts = [cells(s, 60) for s in (5, 6, 7)]
    (tmp_path / "all").mkdir()
    for i, rows in enumerate(parts):
        save(tmp_path / "all" / f"{i}.csv", rows)
    df = readers.read_text_table(small_splits, str(tmp_path / "all"), multi_line=True)
    assert Counter(map(tuple, df.collect())) == Counter(r for rows in parts for r in rows)


def test_written_and_read_again(small_splits, tmp_path):
    rows = cells(8, 200)
    df = small_splits.createDataFrame(rows, "k string, a string, b string").coalesce(1)
    writers.write_table(df, str(tmp_path / "out"), fmt="csv")
    again = readers.read_text_table(small_splits, str(tmp_path / "out"), multi_line=True)
    assert Counter(map(tuple, again.collect())) == Counter(rows)


def test_wrong_text_is_an_error(small_splits, tmp_path):
    wrong = {
        "open": 'k,a,b\n1,"x\ny,2\n', "stray": 'k,a,b\n1,5" pipe and 6" pipe,2\n', "short": 'k,a,b\n1,2\n', "long": 'k,a,b\n1,2,3,4\n',
    }
    for name, text in wrong.items():
        (tmp_path / name).write_text(text)
        with pytest.raises((PySparkException, Py4JJavaError)):
            readers.read_text_table(small_splits, str(tmp_path / name), ["k"], multi_line=True).collect()
    (tmp_path / "two").mkdir()
    save(tmp_path / "two" / "1.csv", [("1", "x", "y")])
    save(tmp_path / "two" / "2.csv", [("1", "x", "y")], header=("k", "b", "a"))
    with pytest.raises((PySparkException, Py4JJavaError), match="header"):
        readers.read_text_table(small_splits, str(tmp_path / "two"), multi_line=True).collect()


def test_header_alone_blank_lines_and_quoted_separators(small_splits, tmp_path):
    save(tmp_path / "none.csv", [])
    assert readers.read_text_table(small_splits, str(tmp_path / "none.csv"), multi_line=True).collect() == []
    (tmp_path / "gaps.csv").write_text('k,a,b\n\n"1","x,\n\ny",""\n\n2,,NA\n')
    got = readers.read_text_table(small_splits, str(tmp_path / "gaps.csv"), multi_line=True).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("1", "x,\n\ny", None), ("2", None, None)]


def test_parity_table_is_a_row_per_split(small_splits, tmp_path):
    save(tmp_path / "one.csv", cells(9, 400))
    plan = records._lines(small_splits, str(tmp_path / "one.csv")).groupBy("file", "block").agg(F.count("*"))
    assert "partial_count" in plan._jdf.queryExecution().executedPlan().toString()
