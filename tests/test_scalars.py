import pytest
from pyspark.sql import functions as F

from relload.functions import scalars as S


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "text,expected",
    [("12abc", 12), ("  -7 ", -7), ("+5", 5), ("abc", 0), ("", 0), (None, 0), ("99999999999", 0), ("2147483647", 2147483647),
     ("2147483648", 0), ("3-MEDIUM", 3)],
)
def test_parse_int(spark, text, expected):
    assert one(spark, S.parse_int, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("4294967297", 1), ("2147483648", -2147483648), ("12abc", 12), ("", None), ("  ", None), ("x", None),
     ("-2055328520", -2055328520), ("99999999999999999999", None)],
)
def test_parse_optional_int(spark, text, expected):
    assert one(spark, S.parse_optional_int, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [(" t ", True), ("YES", True), ("1", True), ("true", True), ("y", False), ("no", False), ("", False), (None, False)],
)
def test_parse_bool(spark, text, expected):
    assert one(spark, S.parse_bool, text) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("0.25abc", 0.25), ("1e3x", 1000.0), ("1e", 1.0), (".5", 0.5), ("abc", 0.0), ("inf", 0.0), ("1e999", 0.0),
     ("  -2.5  ", -2.5)],
)
def test_parse_double(spark, text, expected):
    assert one(spark, S.parse_double, text) == expected


def test_score6_rounds_like_c(spark):
    df = spark.createDataFrame([(12345.65,), (1234567.0,), (0.1234565,), (2.5,)], "x double")
    got = [r.v for r in df.select(S.score6("x").alias("v")).collect()]
    assert got == [float("%.6g" % v) for v in (12345.65, 1234567.0, 0.1234565, 2.5)]
    assert got[0] == 12345.6


def test_trim_sets(spark):
    assert one(spark, S.ctrim, " \t\x0b\x0cab \n") == "ab"
    assert one(spark, S.paren_trim, "\x0b ab \r\n") == "\x0b ab"


def test_blank_null_and_sentinel(spark):
    assert one(spark, lambda c: S.blank_to_null(c, trim_value=True), "  ") is None
    assert one(spark, S.blank_to_null, " x ") == " x "
    df = spark.createDataFrame([(0,), (-1,), (5,)], "d int")
    assert [r.v for r in df.select(S.docket_sentinel("d").alias("v")).collect()] == [2147483647, 2147483647, 5]


def test_timestamp_cast(spark):
    assert one(spark, lambda c: S.cast_timestamp(c).isNotNull(), "2013-10-30 07:13:39.78111+00") is True
    assert one(spark, lambda c: S.cast_failed(c, S.cast_timestamp(c)), "bad_date") is True
    assert one(spark, lambda c: S.cast_failed(c, S.cast_timestamp(c)), "") is False
