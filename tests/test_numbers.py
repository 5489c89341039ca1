import pytest
from pyspark.sql import functions as F

from quarry.functions.numbers import (
    char_class, money_to_double, parse_bigint, parse_double,
    thousands_to_bigint,
)


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr("s").alias("v")).first()["v"]


@pytest.mark.parametrize("text,expected", [
    ("1,234,567", 1234567), ("12", 12), (" 12 ", 12), ("-7", -7), ("1,234.9", 1234),
    ("", None), ("NA", None), (None, None), ("1.5d", None), ("NaN", None),
])
def test_thousands_to_bigint(spark, text, expected):
    assert one(spark, thousands_to_bigint, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("$1.50", 1.5), ("$1.50\n", 1.5), ("$ 2\n", 2.0), ("1e3", 1000.0), (".5", 0.5),
    ("$", None), ("", None), ("$NaN", None), ("Infinity", None), ("1.5d", None), ("$1,50", None),
])
def test_money_to_double(spark, text, expected):
    assert one(spark, money_to_double, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("12.7", 12), ("-12.7", -12), ("3000000000", 3000000000), ("1e30", None), ("", None),
])
def test_integer_text_goes_through_double(spark, text, expected):
    assert one(spark, parse_bigint, text) == expected


def test_parse_never_fails_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("x",), ("9" * 400,), ("--1",)], "s string")
    got = [r["v"] for r in df.select(parse_double("s").alias("v")).collect()]
    assert got == [None, None, None]


def test_char_class_escapes_specials():
    assert char_class("$]^\\-") == "[$\\]\\^\\\\\\-]"


def test_numbers_run_in_the_jvm(spark):
    df = spark.createDataFrame([("1,234",)], "s string").select(thousands_to_bigint("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert F  # imported for parity with other tests
