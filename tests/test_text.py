import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from keyedflow import functions as K
from keyedflow.functions.state import decode_state, encode_state


def value(spark, text, expression, schema="x string"):
    return spark.createDataFrame([(text,)], schema).select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, sep, fields",
    [
        ("a,b,c", ",", ["a", "b", "c"]),
        ("a,b,,", ",", ["a", "b"]),
        (",a,,b", ",", ["", "a", "", "b"]),
        (",,,", ",", []),
        ("", ",", [""]),
        ("a", ",", ["a"]),
        ("a\t\tb\t", "\t", ["a", "", "b"]),
        ("a|b|", "|", ["a", "b"]),
        ("a.b", ".", ["a", "b"]),
        (None, ",", None),
    ],
)
def test_split_drops_trailing_empties(spark, text, sep, fields):
    assert value(spark, text, lambda x: K.split_fields(x, sep)) == fields


def test_split_wants_one_character(spark):
    with pytest.raises(ValueError):
        K.split_fields(F.col("x"), "::")


@pytest.mark.parametrize(
    "text, blank",
    [("", True), ("  ", True), ("\t\n", True), ("\u3000\u2003", True), (" a ", False),
     ("\u00a0", False), ("\x00", False), (None, True)],
)
def test_blank(spark, text, blank):
    assert value(spark, text, K.not_blank) is not blank


@pytest.mark.parametrize(
    "text, one, zero",
    [
        ("", 1, 0), ("  ", 1, None), ("+3", 3, 3), ("-2", -2, -2), ("007", 7, 7),
        ("x", None, None), ("1.5", None, None), (" 1", None, None), ("1\n", None, None),
        ("+", None, None), ("2147483647", 2147483647, 2147483647),
        ("2147483648", None, 2147483648), ("99999999999", None, 99999999999),
        ("9223372036854775808", None, None), ("1e3", None, None), ("1L", None, None),
    ],
)
def test_counts(spark, text, one, zero):
    assert value(spark, text, K.count_blank_is_one) == one
    assert value(spark, text, K.count_empty_is_zero) == zero


@pytest.mark.parametrize(
    "parts, bytes_of",
    [
        (("ab", "c"), "abc"), (("a", "bc"), "abc"), (("\t u", "s \n\x00"), "u" + "s"),
        (("a b", "\tc"), "a b\tc"), (("ü", "漢"), "ü漢"), (("\u3000", ""), "\u3000"),
    ],
)
def test_md5_key(spark, parts, bytes_of):
    df = spark.createDataFrame([parts], "a string, b string")
    key = df.select(K.md5_key(F.col("a"), F.col("b"))).first()[0]
    assert key == hashlib.md5(bytes_of.encode()).hexdigest()


def test_md5_key_with_separator_keeps_fields_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    assert df.select(K.md5_key(F.col("a"), F.col("b"), sep="|")).distinct().count() == 2


@pytest.mark.parametrize(
    "number, digits, text",
    [(0.12345, 2, "12.35%"), (12.5, 0, "1,250%"), (0.125, 0, "12%"), (-0.05, 1, "-5.0%"),
     (0.135, 0, "14%"), (float("nan"), 1, "NaN"), (0.0, 0, "0%")],
)
def test_percent(spark, number, digits, text):
    assert value(spark, number, lambda x: K.format_percent(x, digits), "x double") == text


@pytest.mark.parametrize(
    "day, month, week, iso",
    [("20120816", "201208", "201233", "201233"), ("20160101", "201601", "201653", "201553"),
     ("20160110", "201601", "20161", "201601"), ("20121231", "201212", "20121", "201301")],
)
def test_calendar_buckets(spark, day, month, week, iso):
    buckets = value(spark, day, K.calendar_buckets)
    assert [tuple(b) for b in buckets] == [("daily", day), ("monthly", month), ("weekly", week)]
    assert value(spark, day, lambda x: K.calendar_buckets(x, iso_year=True))[2].cq == iso


@pytest.mark.parametrize("day", ["20161301", "2016011", "201601010", "2016-1-1", "", None, "x"])
def test_invalid_day_has_no_buckets(spark, day):
    assert value(spark, day, K.calendar_buckets) is None
    assert value(spark, day, K.valid_day) is False


def test_today(spark):
    now = dt.datetime.now(dt.timezone.utc)
    today = value(spark, "", lambda x: K.today())
    assert abs(dt.datetime.strptime(today, "%Y%m%d").date() - now.date()) <= dt.timedelta(days=1)


def test_random_surrogates_differ_and_salted_do_not(spark):
    df = spark.range(100).select(F.lit("u").alias("x"))
    assert df.select(K.random_surrogate()).distinct().count() == 100
    assert df.select(K.timed_surrogate(F.col("x"))).distinct().count() == 100
    assert df.select(K.salted_surrogate(F.col("x"), "s")).distinct().count() == 1


def test_state_json(spark):
    df = spark.createDataFrame([(3, 10, 8), (4, 1, None)], "b bigint, v bigint, p bigint")
    b, v, p = F.col("b"), F.col("v"), F.col("p")
    rows = df.select(encode_state(v), encode_state(v, b), encode_state(v, b, p)).collect()
    assert tuple(rows[0]) == ("10", "[3,10]", "[3,10,8]")
    assert rows[1][2] == "[4,1,null]"
    back = [
        tuple(value(spark, text, decode_state)) for text in ("10", "[3,10]", "[3,10,8]", "[4,1,null]")
    ]
    assert back == [(None, 10, None), (3, 10, None), (3, 10, 8), (4, 1, None)]
