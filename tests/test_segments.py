"""Segmented windows and packed maxima against plain Python and Spark's own."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendscope.functions import ordered
from lendscope.operators.monthly import monthly_loan_summary, status_as_of
from lendscope.operators.scd2 import scd2_backfill
from lendscope.operators.segments import Segments

SCHEMA = "loan bigint, month bigint, status string"


def _rows():
    rng = random.Random(4)
    rows = [(1, m, rng.choice(["a", "b", None])) for m in range(400)]  # most rows are of one loan
    rows += [(rng.choice([0, 2, 3, None]), m, rng.choice(["a", None])) for m in range(150)]
    return rows + [(9, None, "x"), (9, 1, "y")]


def test_scans_are_those_of_a_window(spark):
    rows = spark.createDataFrame(_rows(), SCHEMA)
    order = ["month", "status"]
    window = Window.partitionBy("loan").orderBy(*order)
    cases = {
        "lag": (lambda s: s.lag("v", F.col("status")), F.lag("status").over(window)),
        "lead": (lambda s: s.lead("v", F.col("month")), F.lead("month").over(window)),
        "row_number": (lambda s: s.row_number("v"), F.row_number().over(window)),
    }
    for name, (scan, plain) in cases.items():
        segments = Segments(rows, ["loan"], order)
        spread = segments.rows.where("loan = 1").select(Segments.PART).distinct().count()
        assert spread > 1
        got = scan(segments).select("loan", "month", "status", "v")
        want = rows.withColumn("v", plain)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count(), name


def test_scans_of_nothing(spark):
    segments = Segments(spark.createDataFrame([], SCHEMA), ["loan"], ["month"])
    assert segments.lag("v", F.col("status")).collect() == []
    assert segments.row_number("v").collect() == []


def test_packed_numbers_order_like_structs(spark):
    rng = random.Random(1)
    pick = [None, 0, 1, -1, 7, -7]
    rows = [(rng.choice([*pick, 511, -511]), rng.choice([*pick, 10**12, -(10**12)]), rng.choice([*pick, 2**63 - 1, -(2**63)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint")
    number = ordered.packed((F.col("a"), 10), (F.col("b"), 45))
    wide = ordered.with_id(number, F.col("c"))
    back, c = ordered.without_id(F.col("wide"))
    a, b = ordered.unpacked(F.col("number"), [10, 45])
    key = lambda *values: tuple((v is not None, v or 0) for v in values)
    found = df.select("a", "b", "c", number.alias("number"), wide.alias("wide")).select(
        "a", "b", "c", "number", "wide", a.alias("a2"), b.alias("b2"), c.alias("c2"), (back == F.col("number")).alias("same")
    ).collect()
    assert all((r.a, r.b, r.c, True) == (r.a2, r.b2, r.c2, r.same) for r in found)
    assert [key(r.a, r.b, r.c) for r in sorted(found, key=lambda r: r.wide)] == sorted(key(*r) for r in rows)
    with pytest.raises(Exception, match="more than 10 bits"):
        spark.range(1).select(ordered.packed((F.lit(512), 10))).collect()


@pytest.mark.parametrize("most", [0, 1000])
def test_latest_status_with_and_without_a_dictionary(spark, monkeypatch, most):
    monkeypatch.setattr(ordered.dictionary_of, "__defaults__", (most,))
    rows = [(1, 5, -3, "b"), (1, 5, -3, None), (1, 4, -3, "b"), (1, 5, -9, "z"), (2, None, -1, None), (3, 6, -1, "é")]
    pos = spark.createDataFrame(rows, "sk_id_prev bigint, sk_id_curr bigint, months_balance bigint, name_contract_status string")
    got = {r.sk_id_prev: (r.sk_id_curr, r.name_contract_status, r.observed_month) for r in status_as_of(pos).collect()}
    assert got == {1: (5, "b", -3), 2: (None, None, -1), 3: (6, "é", -1)}


def test_no_sort_aggregate_over_monthly_rows(spark):
    pos = spark.sql(
        "select 1L sk_id_prev, 5L sk_id_curr, -3L months_balance, 'b' name_contract_status, "
        "cast(1 as decimal(18,4)) cnt_instalment, 0L sk_dpd, 0L sk_dpd_def"
    )
    for df in (monthly_loan_summary(pos), status_as_of(pos), scd2_backfill(pos)):
        assert "SortAggregate" not in df._jdf.queryExecution().toString()
