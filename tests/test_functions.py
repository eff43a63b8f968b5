from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anemos.functions import (
    FormulaError, cell_text, device_of, formula_column, level_number, level_text, number_text,
    parse_interval, report_time_of, sample_time_of, spark_time_pattern, time_bucket, time_text,
)


def one(spark, column, **values):
    columns = [F.lit(value).alias(name) for name, value in values.items()] or [F.lit(0).alias("_")]
    return spark.range(1).select(*columns).select(column.alias("v")).first()["v"]


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("text, expected", [
    ("10 minute", (10, "MINUTE")), ("1 HOUR", (1, "HOUR")), (" 2  Week ", (2, "WEEK")), ("3 QUARTER", (3, "QUARTER")),
])
def test_interval(text, expected):
    assert parse_interval(text) == expected


@pytest.mark.parametrize("text", ["10 SECOND", "HOUR", "0 DAY", "-1 DAY", "1.5 HOUR", "1 HOURS", "1 HOUR; DROP"])
def test_interval_refused(text):
    with pytest.raises(ValueError):
        parse_interval(text)


@pytest.mark.parametrize("interval, expected", [
    ("10 MINUTE", dt.datetime(2024, 5, 15, 13, 40)),
    ("1 DAY", dt.datetime(2024, 5, 15)),
    ("1 WEEK", dt.datetime(2024, 5, 13)),
    ("1 MONTH", dt.datetime(2024, 5, 1)),
    ("1 QUARTER", dt.datetime(2024, 4, 1)),
    ("1 YEAR", dt.datetime(2024, 1, 1)),
    ("4 YEAR", dt.datetime(2022, 1, 1)),
])
def test_bucket(spark, interval, expected):
    df = spark.range(1).select(at("2024-05-15 13:47:59.5").alias("t")).select(time_bucket("t", interval).alias("b"))
    assert df.first()["b"] == expected


def test_month_bucket_before_1970(spark):
    df = spark.range(1).select(at("1969-12-31 23:00:00").alias("t")).select(time_bucket("t", "5 MONTH").alias("b"))
    assert df.first()["b"] == dt.datetime(1969, 8, 1)


@pytest.mark.parametrize("number, text", [
    (3.0, "3"), (0.0, "0"), (-2.5, "-2.5"), (1234567.25, "1234567.25"), (12345678.0, "12345678"),
    (1.5e7, "15000000"), (123456789.125, "123456789.125"), (1e20, "100000000000000000000"), (1e21, "1e+21"),
    (1.5e22, "1.5e+22"), (0.001, "0.001"), (0.00025, "0.00025"), (0.0001, "0.0001"), (0.00001, "1e-05"),
    (1.25e-12, "1.25e-12"), (float("nan"), "NaN"), (float("inf"), "+Inf"), (None, ""),
])
def test_number_text(spark, number, text):
    assert one(spark, number_text(F.lit(number).cast("double"))) == text


def test_time_text(spark):
    moment = at("2024-05-15 13:47:09")
    assert one(spark, time_text(moment)) == "2024-05-15T13:47:09Z"
    assert one(spark, time_text(moment, "02/01/2006 03:04 PM")) == "15/05/2024 01:47 PM"
    assert one(spark, time_text(F.lit(None).cast("timestamp_ntz"))) == ""
    assert spark_time_pattern("2006-01-02T15:04:05") == "yyyy-MM-dd'T'HH:mm:ss"


def test_cell_text(spark):
    assert one(spark, cell_text(F.lit(7), "int")) == "7"
    assert one(spark, cell_text(F.lit(True), "boolean")) == "true"
    assert one(spark, cell_text(F.lit(None).cast("string"), "string")) == ""


def test_file_keys(spark):
    name = F.lit("WF01_012_202404101537_samples.parquet")
    assert one(spark, device_of(name)) == "WF01_012"
    assert one(spark, sample_time_of(name)) == dt.datetime(2024, 4, 10, 15, 37)
    assert one(spark, report_time_of(name)) == dt.datetime(2024, 4, 10, 15, 30)
    assert one(spark, device_of(F.lit("wf01_x.parquet"))) is None
    assert one(spark, sample_time_of(F.lit("WF01_012_2024.parquet"))) is None


@pytest.mark.parametrize("value, number", [("故障", 4), ("提示", 1), ("2", 2), ("9", 0), ("", 0), (3, 3)])
def test_level_number(spark, value, number):
    assert one(spark, level_number(F.lit(value))) == number


def test_level_text(spark):
    assert [one(spark, level_text(F.lit(n))) for n in (0, 1, 2, 3, 4)] == ["", "提示", "告警", "预警", "故障"]


@pytest.mark.parametrize("text, expected", [
    ("a + b * 2", 10.0), ("(a + b) / c", 2.0), ("a / 0", None), ("b % 2 == 1", True), ("a ** 2", 16.0),
    ("a > 3 && b < 4 ? 1 : 2", 1.0), ("a > 5 ? 1 : b > 2 ? 2 : 3", 2.0), ("!(a > 3) || b == 3", True),
    ("-a + [b]", -1.0), ("a != 4", False), ("a > 9 ? (b > 1 ? 5 : 6) + 1 : 7", 7.0), ("b % 0", None),
    ("a / 0 ?? b / 0 ?? 7", 7.0), ("a ?? 1", 4.0), ("a in (1, 2, b + 1)", True), ("b in (1, 2)", False), ("a > 9 ? 1", None),
    ("2 ** 3 ** 2", 512.0), ("-a ** 2", 16.0), ("a - b - 1", 0.0), ("a - b * 2 ** 2 / 3 % 3", 3.0), ("1 + 2 << 1", 6.0),
    ("6 & 3 | 8 ^ 1", 11.0), ("~0", -1.0), ("a & b == 0 && c > 3", True), ("a > 1 || b > 9 && c > 9", True), ("0x1F + .5 + 1e1", 41.5),
    ("a > 1 == true", True), ("a > 5 ? 1 : a > 3 ? b > 5 ? 2 : 3 : 4", 3.0),
])
def test_formula(spark, text, expected):
    assert one(spark, formula_column(text, ["a", "b", "c"]), a=4.0, b=3.0, c=3.5) == expected


@pytest.mark.parametrize("text", [
    "a + d", "abs(a)", "a.b", "a[0]", "lambda: 1", "a +", "a; b", "__import__('os')", "a if b", "{1: a}", "",
    "a in b", "a in ()", "a in (1", "(a", "a ? b :", "a =~ 1", "a + + + ", "'open", "a && 1 < 'x'", "true + 1", "[a", "in (1)",
])
def test_formula_refused(text):
    with pytest.raises(FormulaError):
        formula_column(text, ["a", "b"])


@pytest.mark.parametrize("value", ["A!B", "x&&y", "a(b", "p?q:r", "u||v", "c)", "it"])
def test_strings_in_formulas_stay_as_they_are(spark, value):
    for quote in "'\"":
        text = f"(n == {quote}{value}{quote}) && !(n == 'other') ? 1 : 0"
        assert one(spark, formula_column(text, ["n"]), n=value) == 1.0
        assert one(spark, formula_column(text, ["n"]), n=value + " ") == 0.0


def typed(spark, text, **row):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(
        f"`{name}` {'string' if isinstance(value, str) else 'timestamp_ntz' if isinstance(value, dt.datetime) else 'double'}"
        for name, value in row.items()))
    return df.select(formula_column(text, dict(df.dtypes))).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("n + '-' + a", "T1-4.5"), ("a + a + n", "9T1"), ("n =~ '[0-9]$'", True), ("n !~ '^t'", True), ("n in ('T1', 'T2')", True),
    ("n == 'T1' ? 'yes' : 'no'", "yes"), ("t < '2024-05-02' && t >= '2024-05-01 12:00:00'", True), ("[odd name] * 2", 6.0),
    ("n + '\\'q'", "T1'q"),
])
def test_formulas_that_know_types(spark, text, expected):
    assert typed(spark, text, n="T1", a=4.5, t=dt.datetime(2024, 5, 1, 12), **{"odd name": 3.0}) == expected


@pytest.mark.parametrize("text", ["n * 2", "n && true", "a =~ 'x'", "n < 3", "n ?? 1", "n > 'a' ? 1 : 'x'", "-n", "!a", "n in (1)", "a | n"])
def test_wrong_kinds_are_refused(spark, text):
    with pytest.raises(FormulaError):
        formula_column(text, {"n": "string", "a": "double"})
