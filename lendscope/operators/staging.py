"""RAW text tables to typed tables, row for row.

A staged table is one projection over the RAW scan: no shuffle, and a consumer
that reads three columns makes the scan read three columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lendscope.functions import typing as t
from lendscope.sources import registry
from lendscope.sources.registry import SourceTable

RULES = {
    registry.BIGINT: t.to_bigint_sql,
    registry.DAY_OR_SENTINEL: t.null_if_sentinel_sql,
    registry.MONEY: t.to_decimal_sql,
    registry.DOUBLE: t.to_double_sql,
    registry.FLAG_01: t.to_bool_01_sql,
    registry.FLAG_YN: t.to_bool_yn_sql,
    registry.TEXT: t.clean_text_sql,
    registry.CODE: t.null_if_code_sql,
}

# Kinds whose rule drops a fact keep it in a flag column: suffix and rule.
FLAGS = {
    registry.CODE: ("xna", t.is_code_sql),
    registry.DAY_OR_SENTINEL: ("sentinel", t.is_sentinel_sql),
}

AUDIT_NAMES = {"_loaded_at": "loaded_at", "_source_file": "source_file"}


def flag_name(column: str, kind: str) -> str:
    return f"is_{column}_{FLAGS[kind][0]}"


def _typed_columns(table: SourceTable) -> list[str]:
    columns = []
    if table.row_key:
        columns.append(f"{t.surrogate_key_sql(*table.columns)} as {table.row_key}")
    for name, kind in table.types.items():
        columns.append(f"{RULES[kind](name)} as {name}")
        if kind in FLAGS:
            columns.append(f"{FLAGS[kind][1](name)} as {flag_name(name, kind)}")
    return columns


def rename_audit(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(AUDIT_NAMES)


def stage(raw: DataFrame, table_name: str) -> DataFrame:
    """Typed form of a RAW table; audit columns lose their leading underscore."""
    table = registry.TABLES_BY_NAME[table_name]
    return rename_audit(raw).selectExpr(*_typed_columns(table), *AUDIT_NAMES.values())
