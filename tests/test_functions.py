"""Names, text, dates and value conversion on adversarial input."""

from __future__ import annotations

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import convert, dates, names, text


def column(spark, values, data_type=None):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType(
        [T.StructField("i", T.LongType()), T.StructField("c", data_type or T.StringType())]
    ))


def apply(spark, values, fn, data_type=None):
    df = column(spark, values, data_type).select("i", fn(F.col("c")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


def test_clean_names():
    raw = ["order id", "2nd", "__x__", "date", "a-b", "a b", "", "prix é", "A_B"]
    assert names.clean_names(raw) == ["order_id", "COL_2nd", "x", "date_COL", "a_b", "a_b_1", "UNNAMED_COLUMN", "prix_é", "A_B_2"]


def test_long_names_stay_apart():
    got = names.clean_names(["x" * 40 + "1", "x" * 40 + "2", "x" * 30])
    assert got == ["x" * 27 + "_01", "x" * 27 + "_02", "x" * 30]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=45), max_size=12))
def test_clean_names_properties(raw):
    got = names.clean_names(raw)
    assert len({n.upper() for n in got}) == len(raw)
    assert all(0 < len(n) <= 30 and not n[0].isdigit() and n.upper() not in names.RESERVED_WORDS for n in got)


def test_resolve_and_align():
    assert names.resolve(["ID", "name "], [" id", "Name"]) == [" id", "Name"]
    with pytest.raises(names.MissingColumns, match="nope"):
        names.resolve(["nope"], ["id"])
    assert names.align(["id", "x", "u_id"], ["ID", "U_ID", "y"]) == [("id", "ID")]


def test_strip_all_white_space(spark):
    got = apply(spark, ["\t a b \n", " x　", "   ", "", None], text.strip)
    assert got == ["a b", "x", "", "", None]


def test_row_text_is_unambiguous(spark):
    df = spark.createDataFrame([("a:1", "b"), ("a", "1:b"), ("a1", ":b"), ("", "a:1b")], "x string, y string")
    assert df.select(text.row_text([F.col("x"), F.col("y")]).alias("t")).distinct().count() == 4


@pytest.mark.parametrize(
    "keep, expected",
    [
        (True, ["12", "100000", "007", "7.5", "-3", "12345678901234567890", "1-URGENT", ".", None, "nan", "0", "007.0"]),
        (False, ["12", "100000", "7", "7.5", "-3", "12345678901234567890", "1-URGENT", ".", None, "nan", "0", "7"]),
    ],
)
def test_whole_number_text(spark, keep, expected):
    values = ["12.0", "1e5", "007", "7.5", "-3.00", "12345678901234567890.0", "1-URGENT", ".", "", "nan", "0.0", "007.0"]
    assert apply(spark, values, lambda c: text.whole_number_text(c, keep)) == expected


def test_parse_any(spark):
    values = [
        "2006-11-06", "2006-11-06 12:30:45", "2006-11-06 12:30:45.123456", "11/06/2006", "11/06/2006 12:30:45", "16/11/2006",
        "16/11/2006 12:30:45", "06-11-2006", "06-11-2006 12:30:45", "1/2/2006", "02/30/2006", "20061106", "12:30:45 x", None, " 2006-11-06\t",
    ]
    day = datetime.datetime(2006, 11, 6)
    noon = datetime.datetime(2006, 11, 6, 12, 30, 45)
    ten = datetime.timedelta(days=10)
    expected = [
        day, noon, noon.replace(microsecond=123456), day, noon, day + ten, noon + ten, day, noon,
        datetime.datetime(2006, 1, 2), None, None, None, None, day,
    ]
    got = apply(spark, values, lambda c: dates.parse_any(c).cast("timestamp_ntz"))
    assert got == expected


def test_integers(spark):
    got = apply(spark, ["123.0", "1e3", "9007199254740993", "abc", "nan", "inf", " 5 ", "-2.9", None, ""], lambda c: convert.to_integer(c, T.StringType()))
    assert got == [123, 1000, 9007199254740993, None, None, None, 5, -2, None, None]


def test_floats(spark):
    assert apply(spark, ["1.5", "nan", "x", None, "-.5"], lambda c: convert.to_float(c, T.StringType())) == [1.5, None, None, None, -0.5]
    assert apply(spark, ["inf"], lambda c: convert.to_float(c, T.StringType())) == [float("inf")]


def test_flags(spark):
    assert apply(spark, ["true", "Y", "0", "", None], lambda c: convert.to_flag(c, T.StringType())) == [1, 1, 0, 0, None]
    assert apply(spark, [True, False, None], lambda c: convert.to_flag(c, T.BooleanType()), T.BooleanType()) == [1, 0, None]


def test_text_of_doubles_and_limit(spark):
    got = apply(spark, [123.0, 0.5, float("nan"), float("-inf"), None], lambda c: convert.to_text(c, T.DoubleType()), T.DoubleType())
    assert got == ["123", "0.5", "", "-Infinity", None]
    assert [len(v) for v in apply(spark, ["é" * 4001, "x"], lambda c: convert.to_text(c, T.StringType()))] == [4000, 1]
    assert len(apply(spark, ["é" * 4001], lambda c: convert.to_text(c, T.StringType(), None))[0]) == 4001


def test_epoch_seconds(spark):
    got = apply(spark, [0.0, 86400.5, float("nan")], lambda c: dates.to_moment(c, T.DoubleType()).cast("timestamp_ntz"), T.DoubleType())
    assert got == [datetime.datetime(1970, 1, 1), datetime.datetime(1970, 1, 2, 0, 0, 0, 500000), None]
