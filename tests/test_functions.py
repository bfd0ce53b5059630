"""Column expressions on hand-made values."""

import math

import pytest
from pyspark.sql import functions as F

from tablekit import functions as X
from tablekit.functions.labels import MPG_CLASSES


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def result(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_rate_of_zero_minutes_is_null(spark):
    df = spark.createDataFrame([(120.0, 60.0), (5.0, 0.0)], "d double, t double")
    assert result(df, X.rate_per_hour(F.col("d"), F.col("t"))) == [120.0, None]


def test_token_at(spark):
    df = column(spark, ["ford pinto", "ford"], "string")
    assert result(df, X.token_at(F.col("x"), " ", 1)) == ["ford", "ford"]
    assert result(df, X.token_at(F.col("x"), " ", 2)) == ["pinto", None]
    with pytest.raises(ValueError, match="from 1"):
        X.token_at(F.col("x"), " ", 0)


def test_bin_label_boundaries(spark):
    values = [-1.0, 20.0, 20.5, 30.0, 40.0, 40.5, math.inf, math.nan, None]
    labels = result(column(spark, values, "double"), X.bin_label(F.col("x"), MPG_CLASSES))
    assert labels == [
        "low", "low", "mid", "mid", "high", "very high", "very high", None, None,
    ]


def test_bin_label_skips_unknown_and_needs_no_bin(spark):
    bins = {"unknown": {"max_value": 100}, "some": {"min_value": 0, "max_value": 1}}
    df = column(spark, [1, 50], "int")
    assert result(df, X.bin_label(F.col("x"), bins)) == ["some", None]
    assert result(df, X.bin_label(F.col("x"), {})) == [None, None]


def test_range_label(spark):
    df = column(spark, [-1, 0, 6, 7, 12, 13, 30, 31, 50, 51, 99, None], "int")
    assert result(df, X.range_label(F.col("x"))) == [
        "Unknown", "[0-6]", "[0-6]", "(6-12]", "(6-12]", "(12-18]", "(18-30]", "(30-50]",
        "(30-50]", "50+", "50+", "Unknown",
    ]


def test_cleanse(spark):
    lines = [" Milk ,\tBread,", "", "A\xa0, b c\x0b", "x|y, Z"]
    assert result(column(spark, lines, "string"), X.cleanse(F.col("x"))) == [
        ["milk", "bread", ""],
        [""],
        ["a", "b c"],
        ["x|y", "z"],
    ]
    assert result(column(spark, ["a | B"], "string"), X.cleanse(F.col("x"), "|")) == [["a", "b"]]


def test_strip_agrees_with_python(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [f"{s}a{s}b{s}" for s in spaces]
    assert result(column(spark, values, "string"), X.strip(F.col("x"))) == [
        v.strip() for v in values
    ]


def test_dates(spark):
    df = column(spark, ["01-May-1995", "", "95"], "string")
    assert result(df, X.year_of(F.col("x"))) == ["1995", "", "95"]
    assert result(df, X.month_of(F.col("x"))) == ["may", "", ""]


def test_field_count_takes_the_delimiter_literally(spark):
    df = column(spark, ["a|b|c", "a|b|", "abc"], "string")
    assert result(df, X.field_count(F.col("x"), "|")) == [3, 3, 1]


def test_decode_flags_drops_unknown_positions(spark):
    names = F.create_map(F.lit(0), F.lit("Action"), F.lit(2), F.lit("Comedy"))
    df = column(spark, [["1", "1", "1"], ["0", "0", "0"], ["0", "0", "1"]], "array<string>")
    assert result(df, X.decode_flags(F.col("x"), names)) == [["Action", "Comedy"], [], ["Comedy"]]


def test_conditional_values(spark):
    df = column(spark, [-1.0, 0.0, 2.0, None], "double")
    assert result(df, X.nonneg(F.col("x"))) == [None, 0.0, 2.0, None]
    assert result(df, X.negative(F.col("x"))) == [-1.0, None, None, None]
