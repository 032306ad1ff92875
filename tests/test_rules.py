"""Column rules at their edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendscope.functions import risk
from lendscope.functions import typing as t


def values(spark, column, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r.v for r in rows.orderBy("i").select(column.alias("v")).collect()]


def test_bigint(spark):
    texts = ["12.0", " 7 ", "abc", "", None, "2.5", "-2.5", "12d", "1e3", "inf", "nan", "1e400"]
    assert values(spark, t.to_bigint("x"), texts) == [
        12, 7, None, None, None, 3, -3, None, 1000, None, None, None,
    ]


def test_bigint_rounds_like_a_double(spark):
    texts = ["9007199254740993", "1e19", "-9007199254740993", "0.49999"]
    assert values(spark, t.to_bigint("x"), texts) == [2**53, None, -(2**53), 0]


def test_double_refuses_java_spellings(spark):
    texts = ["12d", "1f", "1e5D", "0x1p3", "1.5", " 2 ", "-inf", "x"]
    assert values(spark, t.to_double("x"), texts) == [
        None, None, None, None, 1.5, 2.0, float("-inf"), None,
    ]


def test_decimal_rounds_half_up(spark):
    got = values(spark, t.to_decimal("x"), ["1.00005", "-1.00005", "bad", None])
    assert [str(v) for v in got] == ["1.0001", "-1.0001", "None", "None"]


def test_flags(spark):
    texts = ["1", "0", "1.0", "2", None, "Y"]
    assert values(spark, t.to_bool_01("x"), texts) == [True, False, True, None, None, None]
    texts = ["Y", "N", "y", " Y", None]
    assert values(spark, t.to_bool_yn("x"), texts) == [True, False, None, None, None]


def test_codes_and_placeholders(spark):
    texts = [" XNA ", "XAP", "  ", None, " a "]
    assert values(spark, t.null_if_code("x"), texts) == [None, "XAP", None, None, "a"]
    assert values(spark, t.is_code("x"), texts) == [True, False, False, False, False]
    texts = ["365243.0", "365243", "-5", None]
    assert values(spark, t.null_if_sentinel("x"), texts) == [None, None, -5, None]
    assert values(spark, t.is_sentinel("x"), texts) == [True, True, False, False]


def test_surrogate_key_tells_null_positions_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    keys = [r.k for r in rows.select(t.surrogate_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == 2


@pytest.mark.parametrize(
    ("days", "label"),
    [(-10, "0"), (0, "0"), (1, "1-30"), (30, "1-30"), (31, "31-60"), (60, "31-60"),
     (61, "61-90"), (90, "61-90"), (91, "90+"), (None, None)],
)
def test_dpd_bucket(spark, days, label):
    assert values(spark, risk.dpd_bucket(F.col("x")), [days], "bigint") == [label]


def test_cohorts(spark):
    months = [0, 11, 12, 95, 96, 300, None]
    assert values(spark, risk.cohort_block(F.col("x")), months, "bigint") == [
        "00-11m", "00-11m", "12-23m", "84-95m", "96m+", "96m+", None,
    ]


def test_months_and_ages(spark):
    assert values(spark, risk.months_before(F.col("x")), [0, -30, -31, -365], "bigint") == [
        0, 0, 1, 11,
    ]
    days = [-9131, -9132, None]  # just below and above 25 years of 365.25 days
    assert values(spark, risk.age_band(F.col("x")), days, "bigint") == ["<25", "25-34", "unknown"]
    assert values(spark, risk.income_band(F.col("x")), [89999, 90000, None], "bigint") == [
        "1: <90k", "2: 90k-135k", "unknown",
    ]


def test_wilson_anchor(spark):
    counts = spark.createDataFrame([(230, 1598), (0, 5)], "k bigint, n bigint")
    low, high = risk.wilson_interval(F.col("k"), F.col("n"))
    first, second = counts.select(low.alias("low"), high.alias("high")).collect()
    assert (round(first.low, 4), round(first.high, 4)) == (0.1276, 0.1620)
    assert abs(second.low) < 1e-12 and 0 < second.high < 1
