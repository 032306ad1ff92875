"""Declarative checks over DataFrames.

A check counts what is wrong; its severity says whether that blocks (error) or is
reported (warn). Row-level checks of one table run together in one scan; key checks
reduce their table to one row per key first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED = "accepted_values"
BETWEEN = "between"
RELATIONSHIP = "relationships"
EXPRESSION = "expression"


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    severity: str = ERROR
    allowed: tuple[str, ...] = field(default=(), repr=False)
    low: float | None = None
    high: float | None = None
    predicate: str | None = None
    parent: tuple[str, str] | None = None
    only_where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{self.predicate or '+'.join(self.columns)}"


def not_null(table: str, column: str, severity: str = ERROR) -> Check:
    return Check(table, NOT_NULL, (column,), severity)


def unique(table: str, *columns: str, severity: str = ERROR) -> Check:
    return Check(table, UNIQUE, columns, severity)


def accepted_values(
    table: str, column: str, allowed: Iterable[str], severity: str = ERROR
) -> Check:
    return Check(table, ACCEPTED, (column,), severity, allowed=tuple(allowed))


def between(
    table: str,
    column: str,
    low: float | None = None,
    high: float | None = None,
    severity: str = ERROR,
) -> Check:
    """Bounds are inclusive and each may be absent. NULL is within any bounds."""
    return Check(table, BETWEEN, (column,), severity, low=low, high=high)


def expression(table: str, predicate: str, severity: str = ERROR) -> Check:
    return Check(table, EXPRESSION, (), severity, predicate=predicate)


def relationship(
    table: str,
    column: str,
    parent: str,
    parent_column: str,
    severity: str = ERROR,
    only_where: str | None = None,
) -> Check:
    return Check(
        table,
        RELATIONSHIP,
        (column,),
        severity,
        parent=(parent, parent_column),
        only_where=only_where,
    )


# ---------------------------------------------------------------- row-level checks


def _fails(check: Check) -> Column:
    """Whether a row fails. What cannot be decided (NULL) does not fail."""
    if check.kind == EXPRESSION:
        return F.coalesce(~F.expr(check.predicate), F.lit(False))
    column = F.col(check.columns[0])
    if check.kind == NOT_NULL:
        return column.isNull()
    if check.kind == ACCEPTED:
        return F.coalesce(~column.cast("string").isin(*check.allowed), F.lit(False))
    bad = F.lit(False)
    if check.low is not None:
        bad = bad | (column < check.low)
    if check.high is not None:
        bad = bad | (column > check.high)
    return F.coalesce(bad, F.lit(False))


def _bad_values(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, failures): distinct values outside the allowed ones.

    A row is repeated for the checks that it fails, and only for them.
    """
    found = (
        F.when(
            _fails(check),
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.col(check.columns[0]).cast("string").alias("value"),
            ),
        )
        for check in checks
    )
    bad = df.select(F.inline(F.array_compact(F.array(*found)))).distinct()
    return bad.groupBy("check_name").agg(F.count("*").alias("failures"))


def _bad_rows(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, failures): rows that fail, counted in one aggregate without a copy of them."""
    ids = {f"c{i}": check for i, check in enumerate(checks)}
    counts = df.agg(*(F.count_if(_fails(check)).alias(i) for i, check in ids.items()))
    rows = F.array(
        *(
            F.struct(F.lit(check.name).alias("check_name"), F.col(i).alias("failures"))
            for i, check in ids.items()
        )
    )
    return counts.select(F.inline(rows)).where(F.col("failures") > 0)


def row_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, failures) of the row-level checks that fail at least once.

    Accepted values count each bad value once, the other kinds count rows.
    """
    by_value = [check for check in checks if check.kind == ACCEPTED]
    by_row = [check for check in checks if check.kind != ACCEPTED]
    parts = [_bad_values(df, by_value)] if by_value else []
    parts += [_bad_rows(df, by_row)] if by_row else []
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- key checks


def duplicate_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once; a single NULL key is not a key."""
    keys = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return keys.groupBy(*columns).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key, n_rows) of child keys the parent lacks; NULL child keys are not orphans.

    Child rows are counted per key first, so a key shared by a third of the rows meets
    the parent as one row.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias("key"))
    return counted.join(known, "key", "left_anti")


def _one_failure_row(check: Check, failures: DataFrame) -> DataFrame:
    return failures.select(F.lit(check.name).alias("check_name"), "failures")


def _key_failures(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if check.kind == UNIQUE:
        found = duplicate_keys(df, *check.columns).agg(F.count("*").alias("failures"))
    else:
        child = df.where(check.only_where) if check.only_where else df
        parent, parent_column = check.parent
        orphans = orphan_keys(child, check.columns[0], tables[parent], parent_column)
        total = F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint"))
        found = orphans.agg(total.alias("failures"))
    return _one_failure_row(check, found)


# ---------------------------------------------------------------- suites


def failures(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, failures); row-level checks without failures are absent."""
    by_table: dict[str, list[Check]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if check.kind in (UNIQUE, RELATIONSHIP):
            parts.append(_key_failures(check, tables))
        else:
            by_table.setdefault(check.table, []).append(check)
    parts += [row_failures(tables[name], group) for name, group in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def run_checks(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: name, table, kind, severity, failures, status."""
    spark = next(iter(tables.values())).sparkSession
    declared = spark.createDataFrame(
        [(check.name, check.table, check.kind, check.severity) for check in checks],
        "check_name string, table_name string, kind string, severity string",
    )
    found = F.coalesce(F.col("failures"), F.lit(0)).cast("bigint")
    status = F.when(found == 0, "pass").otherwise(
        F.when(F.col("severity") == ERROR, "fail").otherwise("warn")
    )
    return declared.join(failures(tables, checks), "check_name", "left").select(
        "check_name",
        "table_name",
        "kind",
        "severity",
        found.alias("failures"),
        status.alias("status"),
    )


def blocking(results: DataFrame) -> DataFrame:
    """Checks that must stop the run."""
    return results.where(F.col("status") == "fail")
