"""Scalar functions and classifications (FIXTURES.md §C R5-R11, R19, R22)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from aqualedger.functions import codes
from aqualedger.functions.datekeys import date_key, elapsed_days, mdy_key, whole_days
from aqualedger.functions.text import trim_to_null, zero_if_null_sum


def one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))


def test_date_key_drops_time(spark):
    df = one_col(spark, [dt.datetime(2021, 3, 5, 23, 59), dt.datetime(1999, 12, 31), None], T.TimestampNTZType())
    assert [r[0] for r in df.select(date_key("v")).collect()] == [20210305, 19991231, None]


def test_mdy_key(spark):  # R5
    df = one_col(spark, [3012021, 12312021, None], T.IntegerType())
    assert [r[0] for r in df.select(mdy_key("v")).collect()] == [20210301, 20211231, None]


def test_mdy_key_ignores_sign_like_padded_offsets(spark):
    df = one_col(spark, [-3012021], T.IntegerType())
    assert df.select(mdy_key("v")).first()[0] == 20210301


def test_whole_days(spark):  # R6
    df = spark.createDataFrame([(3012021, 3312021)], "f int, t int")
    assert df.select(whole_days("f", "t")).first()[0] == 30


def test_invalid_mdy_strict_raises_lenient_nulls(spark):  # R7
    df = spark.createDataFrame([(0, 3312021)], "f int, t int")
    with pytest.raises(PySparkException):
        df.select(whole_days("f", "t")).collect()
    r = df.select(whole_days("f", "t", strict=False).alias("d"), mdy_key("f", strict=False).alias("k")).first()
    assert (r.d, r.k) == (None, 0)


def test_mdy_too_wide_raises(spark):
    df = one_col(spark, [123456789], T.IntegerType())
    with pytest.raises(PySparkException):
        df.select(mdy_key("v")).collect()
    assert df.select(mdy_key("v", strict=False)).first()[0] is None


def test_item_service_size_first_match(spark):  # R8
    rates = [210, 114, 205, 22, 260, 9, 19, 113, None]
    df = one_col(spark, rates, T.IntegerType())
    got = [r[0] for r in df.select(codes.item_service_size("v")).collect()]
    assert got == ["0075", "0400", "0300", "0125", "1200", "9999", "9999", "9999", "9999"]


def test_register_service_size(spark):  # R9
    df = one_col(spark, [1, 13, 12, 14, None], T.IntegerType())
    got = [r[0] for r in df.select(codes.register_service_size("v")).collect()]
    assert got == ["00625", "0125", "1600", "9999", "9999"]


def _classify(spark, pairs):
    df = spark.createDataFrame(pairs, "k int, r int")
    return [
        (x.u, x.s)
        for x in df.select(
            codes.utility_type("k", "r").alias("u"), codes.rate_schedule("k", "r").alias("s")
        ).collect()
    ]


def test_rate_kind_zero(spark):  # R10
    pairs = [(0, 1), (0, 210), (0, 900), (0, 999), (0, 2500), (0, 2501), (0, 2502)]
    assert _classify(spark, pairs) == [
        ("W", "RMWS"), ("W", "FPSD-DU"), ("W", "NO BILL"), ("W", None), ("W", "ITEM DRIVER"), (None, None), ("D", None),
    ]


def test_rate_kind_two(spark):  # R11
    pairs = [(2, 1), (2, 5), (2, 19), (2, 100), (2, 31), (2, 32), (2, 116), (2, 210), (2, 41), (2, 50), (2, None), (1, 1)]
    assert _classify(spark, pairs) == [
        ("U", "SUFR"), ("U", "MRFS"), ("U", "MRIS"), ("U", "RFWG"), ("F", "FPST"), (None, None),
        ("F", "FPSG"), ("F", "FPSD"), ("D", "DITCH"), ("B", "Backflow"), (None, None), (None, None),
    ]


def test_elapsed_days_fractional(spark):  # R19
    df = spark.createDataFrame(
        [(dt.datetime(2021, 3, 1), dt.datetime(2021, 3, 31, 12))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(elapsed_days("a", "b")).first()[0] == 30.5


def test_trim_to_null(spark):  # R20, R22
    df = one_col(spark, ["  A1 ", "    ", None], T.StringType())
    assert [r[0] for r in df.select(trim_to_null("v")).collect()] == ["A1", None, None]


def test_zero_if_null_sum(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(zero_if_null_sum(["a", "b"])).collect()] == [0, 1]


def test_case_rules_are_single_expression(spark):
    """Classifications fold into one CASE (no join, no UDF)."""
    df = one_col(spark, [1], T.IntegerType()).select(codes.item_service_size("v").alias("s"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "Join" not in plan
