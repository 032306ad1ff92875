"""Facts about the data that explain the checks: failed casts, placeholders, orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators.quality import orphan_keys
from lendscope.operators.staging import FLAGS, RULES, flag_name
from lendscope.sources import registry
from lendscope.sources.registry import TABLES_BY_NAME

_TEXT_KINDS = (registry.TEXT, registry.CODE)
_FLAG_KINDS = (registry.FLAG_01, registry.FLAG_YN)


def _count_per_column(df: DataFrame, table: str, conditions: dict[str, str], name: str) -> DataFrame:
    """(table_name, column_name, <name>): rows meeting each condition, in one pass."""
    counts = df.agg(*(F.expr(f"count_if({cond})").alias(c) for c, cond in conditions.items()))
    return counts.unpivot([], list(conditions), "column_name", name).select(
        F.lit(table).alias("table_name"), "column_name", name
    )


def cast_failures(raw: DataFrame, table: str) -> DataFrame:
    """Text that became NULL by typing, placeholders not counted, per typed column."""
    conditions = {}
    for column, kind in TABLES_BY_NAME[table].types.items():
        if kind in _TEXT_KINDS:
            continue
        lost = f"{column} is not null and {RULES[kind](column)} is null"
        if kind in FLAGS:
            lost += f" and not {FLAGS[kind][1](column)}"
        conditions[column] = lost
    return _count_per_column(raw, table, conditions, "n_failed")


def flag_domain(raw: DataFrame, table: str) -> DataFrame:
    """Values outside 0 / 1 / Y / N, per flag column."""
    conditions = {
        column: f"{column} is not null and {RULES[kind](column)} is null"
        for column, kind in TABLES_BY_NAME[table].types.items()
        if kind in _FLAG_KINDS
    }
    return _count_per_column(raw, table, conditions, "n_outside")


def placeholders(staged: DataFrame, table: str) -> DataFrame:
    """Rows whose value was a placeholder, per column."""
    conditions = {
        column: flag_name(column, kind)
        for column, kind in TABLES_BY_NAME[table].types.items()
        if kind in FLAGS
    }
    return _count_per_column(staged, table, conditions, "n_flagged")


def placeholder_overlap(train: DataFrame) -> DataFrame:
    """One row: how far the employment and employer placeholders are the same rows."""
    days, employer = F.col("is_days_employed_sentinel"), F.col("is_organization_type_xna")
    return train.agg(
        F.count_if(days).alias("n_days_employed"),
        F.count_if(employer).alias("n_organization_type"),
        F.count_if(days & employer).alias("n_both"),
    )


def _orphan_totals(
    relation: str, child: DataFrame, column: str, parent: DataFrame, known: DataFrame | None
) -> DataFrame:
    """Totals of the child rows whose key the parent lacks.

    `known` lists keys whose absence is explained. Keys are counted before any join.
    """
    orphans = orphan_keys(child, column, parent, column)
    if known is None:
        explained = orphans.withColumn("explained", F.lit(False))
    else:
        marks = known.select(F.col(column).alias("key"), F.lit(True).alias("_known"))
        explained = orphans.join(marks, "key", "left").withColumn(
            "explained", F.col("_known").isNotNull()
        )

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return explained.agg(
        total(F.col("n_rows")).alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
        total(F.when(F.col("explained"), F.col("n_rows"))).alias("explained_rows"),
        total(F.when(~F.col("explained"), F.col("n_rows"))).alias("unexplained_rows"),
    ).select(F.lit(relation).alias("relation"), "*")


def orphan_profile(
    train: DataFrame,
    test: DataFrame,
    bureau: DataFrame,
    bureau_balance: DataFrame,
    previous: DataFrame,
    payments: DataFrame,
    pos: DataFrame,
    cards: DataFrame,
) -> DataFrame:
    """Orphan rows and keys per relation; test clients explain missing train clients only."""
    client, loan = "sk_id_curr", "sk_id_prev"
    return reduce(
        DataFrame.unionByName,
        [
            _orphan_totals("bureau -> application", bureau, client, train, test),
            _orphan_totals("previous_application -> application", previous, client, train, test),
            _orphan_totals("installments -> previous_application", payments, loan, previous, None),
            _orphan_totals("pos_cash -> previous_application", pos, loan, previous, None),
            _orphan_totals("credit_card -> previous_application", cards, loan, previous, None),
            _orphan_totals("bureau_balance -> bureau", bureau_balance, "sk_id_bureau", bureau, None),
        ],
    )
