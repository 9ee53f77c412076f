import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelloom.functions import keys, scalars


def _one(spark, value, col, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, want",
    [("1", "00001"), ("00001", "00001"), ("123456", "123456"), (None, None), ("", "00000"), ("-12", "-0012"), ("+7", "+0007")],
)
def test_pad_key(spark, raw, want):
    assert _one(spark, raw, keys.pad_key) == want


def test_pad_key_trims_on_request(spark):
    assert _one(spark, " 9001\t", lambda c: keys.pad_key(c, trim=True)) == "09001"
    assert _one(spark, " 9001", keys.pad_key) == " 9001"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Los  Angeles County", "Los Angeles"), ("  Kern ", "Kern"), ("Orange County", "Orange"),
        ("County", "County"), ("County Line", "County Line"), (None, None),
    ],
)
def test_strip_suffix_word(spark, raw, want):
    assert _one(spark, raw, keys.strip_suffix_word) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        (" Resturants ", "restaurants"), ("Park", "parks"), ("park", "park"),
        ("Bars & Pubs/Clubs - Late", "bars_and_pubs_clubs___late"), (None, None),
    ],
)
def test_category_label(spark, raw, want):
    names = {"Park": "parks", "Resturants": "restaurants"}
    assert _one(spark, raw, lambda c: keys.category_label(c, names)) == want


def test_prefix_is_false_on_null(spark):
    assert _one(spark, None, lambda c: keys.has_prefix(c, "06")) is False
    assert _one(spark, "06037", lambda c: keys.has_prefix(c, "06")) is True


@pytest.mark.parametrize(
    "raw, want",
    [
        ("12.5", 12.5), (" -3 ", -3.0), ("1e3", 1000.0), (".5", 0.5), ("abc", None), ("", None), ("NaN", None),
        (None, None), ("1d", None), ("2.5f", None), ("inf", float("inf")), ("-inf", float("-inf")),
    ],
)
def test_number_or_null(spark, raw, want):
    assert _one(spark, raw, scalars.number_or_null) == want


@pytest.mark.parametrize("raw, want", [("2012", 2012), ("2012.0", 2012), ("2012.5", None), ("x", None), (None, None)])
def test_int_or_null(spark, raw, want):
    assert _one(spark, raw, scalars.int_or_null) == want


def test_strict_casts_fail_on_bad_text(spark):
    assert _one(spark, "2012.0", scalars.strict_int) == 2012
    for bad in ("x", None):
        with pytest.raises(PySparkException):
            _one(spark, bad, scalars.strict_int)
    with pytest.raises(PySparkException):
        _one(spark, "x", scalars.strict_number)
    assert _one(spark, float("nan"), scalars.strict_number, "double") is None


def test_month_of_bad_date_is_null(spark):
    assert _one(spark, "2015-04-30", scalars.month_of) == 4
    assert _one(spark, "April", scalars.month_of) is None
    assert _one(spark, datetime.datetime(2015, 12, 31, 23, 59), scalars.month_of, "timestamp") == 12


@pytest.mark.parametrize(
    "raw, dtype, want",
    [
        ("True", "string", 1.0), ("true", "string", 1.0), ("TRUE", "string", 0.0), ("1", "string", 0.0),
        (None, "string", 0.0), (True, "boolean", 1.0), (None, "boolean", 0.0), (1, "int", 1.0), (2, "int", 0.0),
        (1.0, "double", 1.0),
    ],
)
def test_flag_number(spark, raw, dtype, want):
    assert _one(spark, raw, lambda c: scalars.flag_number(c, dtype), dtype) == want


def test_null_rules(spark):
    assert _one(spark, -666666666.0, lambda c: scalars.sentinels_to_null(c, [-666666666]), "double") is None
    assert _one(spark, 5.0, lambda c: scalars.sentinels_to_null(c, [-666666666]), "double") == 5.0
    assert _one(spark, -1.0, scalars.non_negative, "double") is None
    assert _one(spark, 0.0, scalars.non_negative, "double") == 0.0
    assert _one(spark, 0.0, scalars.positive, "double") is None
    for x in (float("inf"), float("-inf"), float("nan")):
        assert _one(spark, x, scalars.finite, "double") is None


def test_arithmetic_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (1.0, None), (6.0, 3.0), (1.0, -2.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    out = df.select(
        scalars.safe_divide(a, b).alias("d"), scalars.sum_any([a, b]).alias("s"), scalars.sum_zero([a, b]).alias("z"),
        scalars.pct_growth(a, b).alias("g"), scalars.log_growth(a, b).alias("l"),
    ).collect()
    assert [r["d"] for r in out] == [None, None, None, 2.0, None]
    assert [r["s"] for r in out] == [1.0, 2.0, 1.0, 9.0, -1.0]
    assert [r["g"] for r in out] == [None, None, None, -0.5, None]
    assert out[0]["l"] is None and out[3]["l"] == pytest.approx(-0.6931471805599453)
    empty = spark.createDataFrame([(None, None)], "a double, b double")
    assert empty.select(scalars.sum_any([a, b])).first()[0] is None
    assert empty.select(scalars.sum_zero([a, b])).first()[0] == 0.0


def test_derived_part_keeps_its_flag_when_the_guard_drops_it(spark):
    df = spark.createDataFrame(
        [(None, 10.0, 4.0), (None, 3.0, 4.0), (None, None, 4.0), (2.0, 10.0, 4.0)], "p double, t double, o double"
    )
    part, flag = scalars.fill_from_difference(F.col("p"), F.col("t"), F.col("o"))
    out = df.select(scalars.non_negative(part), flag).collect()
    assert [tuple(r) for r in out] == [(6.0, True), (None, True), (None, False), (2.0, False)]


def test_flags_are_never_null(spark):
    df = spark.createDataFrame([(None,), (2014,), (2015,)], "y int")
    out = df.select(scalars.known(F.col("y") > 2014), scalars.not_in(F.col("y"), [2014, 2020])).collect()
    assert [tuple(r) for r in out] == [(False, True), (False, False), (True, True)]
