"""Versioned Parquet tables, one at a time: `catalog` for a run of a single table.

A publish writes a new version, counts it back, and only then makes it current. Readers look up
the current version once, so they see the old table or the new one, and a table may be rebuilt
from its own current version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendscope.sources.catalog import (
    OvertakenError,
    ReconciliationError,
    Run,
    current,
    read_entry,
    reconcile_counts,
)

__all__ = [
    "OvertakenError",
    "ReconciliationError",
    "SchemaDriftError",
    "append",
    "current_note",
    "current_version",
    "publish",
    "read_current",
    "reconcile_counts",
    "require_same_columns",
]
#: Tables of one folder may be published side by side; each attempt starts from what is current.
ATTEMPTS = 20


class SchemaDriftError(RuntimeError):
    """The columns of a table changed between loads."""


def current_version(spark: SparkSession, root: str, table: str) -> str | None:
    """The newest version folder of a table."""
    entry = current(spark, root)[1].get(table)
    if entry is None or not entry.folders:
        return None
    return max(folder.split("/")[1] for folder in entry.folders.values())


def current_note(spark: SparkSession, root: str, table: str) -> str | None:
    """What was published together with the current version."""
    entry = current(spark, root)[1].get(table)
    return None if entry is None else entry.note


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The published rows, or None before the first publish."""
    entry = current(spark, root)[1].get(table)
    return None if entry is None else read_entry(spark, root, entry)


def _switch(run: Run, table: str) -> int:
    """Commit a run of one table. What other tables did meanwhile is no conflict."""
    began = run.entries.get(table)
    for _ in range(ATTEMPTS):
        try:
            run.commit([table])
            return run.entries[table].n_rows
        except OvertakenError:
            run.number, run.entries = current(run.spark, run.root)
            if run.entries.get(table) != began:
                raise
    raise OvertakenError(f"{table}: other tables of {run.root} are published all the time")


def publish(df: DataFrame, root: str, table: str, note: str | None = None) -> int:
    """Write a new version, verify it, make it current. Returns its row count.

    A note becomes current in the same step. The source rows are counted while they are written,
    not by a second pass.
    """
    run = Run(df.sparkSession, root)
    run.publish(table, df, note)
    return _switch(run, table)


def append(df: DataFrame, root: str, table: str, note: str | None = None) -> int:
    """Add rows to a table as a folder of their own. Returns the rows the table has now."""
    run = Run(df.sparkSession, root)
    run.append(table, df, note)
    return _switch(run, table)


def require_same_columns(name: str, existing: DataFrame, incoming: DataFrame) -> None:
    """Same columns, in the same order, of the same type."""
    before = [(f.name.lower(), f.dataType.simpleString()) for f in existing.schema.fields]
    after = [(f.name.lower(), f.dataType.simpleString()) for f in incoming.schema.fields]
    if before != after:
        raise SchemaDriftError(
            f"{name}: columns differ. Only in the table: {sorted(set(before) - set(after))}; "
            f"only in the source: {sorted(set(after) - set(before))}; or another order"
        )
