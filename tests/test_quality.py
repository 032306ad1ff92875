"""Checks find planted defects, and pass clean data."""

from __future__ import annotations

from lendscope.operators import quality
from lendscope.plans import rules


def result(tables, *checks):
    return {
        r.kind: (r.failures, r.status) for r in quality.run_checks(tables, list(checks)).collect()
    }


def test_every_kind_counts_its_failures(spark):
    child = spark.createDataFrame(
        [(1, "a", 5.0), (1, "z", 50.0), (None, "z", None), (3, None, -1.0), (9, "y", 1.0)],
        "id int, label string, amount double",
    )
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    got = result(
        {"child": child, "parent": parent},
        quality.not_null("child", "id"),
        quality.unique("child", "id"),
        quality.accepted_values("child", "label", ["a", "b"]),
        quality.between("child", "amount", low=0, high=10, severity=quality.WARN),
        quality.relationship("child", "id", "parent", "id"),
        quality.expression("child", "amount < 40"),
    )
    assert got == {
        "not_null": (1, "fail"),
        "unique": (1, "fail"),
        "accepted_values": (2, "fail"),  # two distinct bad values on three rows
        "between": (2, "warn"),
        "relationships": (1, "fail"),
        "expression": (1, "fail"),
    }


def test_clean_rows_and_filtered_relationships_pass(spark):
    df = spark.createDataFrame([(1, True), (7, False)], "id int, known boolean")
    parent = spark.createDataFrame([(1,)], "id int")
    checks = [
        quality.not_null("t", "id"),
        quality.relationship("t", "id", "p", "id", only_where="known"),
    ]
    assert result({"t": df, "p": parent}, *checks) == {
        "not_null": (0, "pass"),
        "relationships": (0, "pass"),
    }
    assert quality.blocking(quality.run_checks({"t": df, "p": parent}, checks)).count() == 0


def test_composite_keys_count_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1)], "a int, b int")
    assert result({"t": df}, quality.unique("t", "a", "b")) == {"unique": (1, "fail")}


def test_declared_rules_are_complete():
    counts = {layer: len(checks) for layer, checks in rules.CHECKS.items()}
    assert counts == {"staging": 86, "intermediate": 20, "marts": 48, "snapshot": 2}
