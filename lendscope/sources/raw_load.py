"""Landing source tables as RAW text: change detection, guards, ledger, freshness."""

from __future__ import annotations

import datetime
import hashlib
import json
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.upsert import upsert
from lendscope.sources import catalog, store
from lendscope.sources.registry import TABLES_BY_NAME, SourceTable

LEDGER = "_load_audit"
LEDGER_SCHEMA = (
    "table_name string, source_file string, digest string, row_count bigint, loaded_at timestamp"
)
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


# ---------------------------------------------------------------- change detection


class SourceChangedError(RuntimeError):
    """A source was not the same when it was loaded as when it was looked at."""


def digest_lanes(columns: list[str]) -> dict[str, Column]:
    """Aggregates that tell the rows as a bag: how many, and two sums over 60 bits of their hashes.

    Rows are hashed where they are read and the hashes are added up, so neither file
    layout nor row order matters, copies count, and nothing is sorted or collected. The lanes of
    two sets of rows add up to the lanes of both. Lengths and a NULL mark make the hashed text
    unambiguous across columns.
    """
    cells = ",".join(f"coalesce(length(`{c}`) || ':' || `{c}`, 'null')" for c in columns)
    row_hash = F.expr(f"md5(concat_ws(',', {cells}))")

    def lane(first: int):
        part = F.conv(F.substr(row_hash, F.lit(first), F.lit(15)), 16, 10)
        return F.coalesce(F.sum(part.cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)")

    return {"row_count": F.count("*"), "low": lane(1), "high": lane(16)}


def _lanes_of(df: DataFrame) -> DataFrame:
    return df.agg(*(lane.alias(name) for name, lane in digest_lanes(df.columns).items()))


def source_digest(df: DataFrame) -> DataFrame:
    """One row: a digest of the rows as a bag, and how many there are."""
    sums = _lanes_of(df)
    parts = [F.col(c).cast("string") for c in ("row_count", "low", "high")]
    return sums.select(F.md5(F.concat_ws("-", *parts)).alias("digest"), "row_count")


def _digest_of(lanes: Mapping[str, int]) -> str:
    """As `source_digest`, of lanes that are there already."""
    return hashlib.md5("-".join(str(lanes[c]) for c in ("row_count", "low", "high")).encode()).hexdigest()


def digests(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, digest, row_count) per source."""
    return reduce(
        DataFrame.unionByName,
        (source_digest(df).withColumn("table_name", F.lit(n)) for n, df in sources.items()),
    )


def skip_decision(
    sources: DataFrame, ledger: DataFrame, raw_counts: DataFrame, force: bool = False
) -> DataFrame:
    """(table_name, skip, reason): whether a source can be left alone.

    sources: table_name, digest. ledger: table_name, digest, row_count of the last good
    load. raw_counts: table_name, raw_rows as they are now.
    """
    known = ledger.select(
        "table_name",
        F.col("digest").alias("known_digest"),
        F.col("row_count").alias("known_rows"),
        F.lit(True).alias("on_record"),
    )
    rows = F.col("raw_rows")
    mismatch = F.concat(
        F.lit("RAW has "),
        rows.cast("string"),
        F.lit(" rows, audit recorded "),
        F.col("known_rows").cast("string"),
    )
    # The reasons, in order of precedence.
    reason = (
        F.when(F.lit(force), "forced")
        .when(F.col("on_record").isNull(), "no previous load on record")
        .when(F.col("known_digest") != F.col("digest"), "source file changed")
        .when(F.coalesce(rows, F.lit(0)) == 0, "RAW table is missing or empty")
        .when(rows != F.col("known_rows"), mismatch)
        .otherwise("unchanged")
    )
    return (
        sources.select("table_name", "digest")
        .join(known, "table_name", "left")
        .join(raw_counts.select("table_name", "raw_rows"), "table_name", "left")
        .select("table_name", (reason == "unchanged").alias("skip"), reason.alias("reason"))
    )


# ---------------------------------------------------------------- loading


def check_columns(columns: list[str], table: SourceTable) -> None:
    """Refuse unusable headers before anything is written."""
    for name in columns:
        if not _IDENTIFIER.fullmatch(name):
            raise ValueError(f"not usable as a column name: {name!r}")
    present = {name.lower() for name in columns}
    missing = [name for name in table.required if name not in present]
    if missing:
        raise ValueError(f"{table.file_name} lacks {missing}")


def with_audit(df: DataFrame, source_file: str, load_ts: datetime.datetime) -> DataFrame:
    """All text, with the load time and the file name as the last two columns."""
    texts = [F.col(f"`{name}`").cast("string").alias(name) for name in df.columns]
    return df.select(
        *texts, F.lit(load_ts).alias("_loaded_at"), F.lit(source_file).alias("_source_file")
    )


def _stage_raw(
    run: catalog.Run, df: DataFrame, table: str, source_file: str, load_ts: datetime.datetime, add: bool
) -> dict[str, int]:
    """Write a RAW table (or a further folder of it); the lanes of all it holds then.

    The source is read once: its lanes are observed while it is written, and kept as the note
    of the table.
    """
    check_columns(df.columns, TABLES_BY_NAME[table])
    raw = with_audit(df, source_file, load_ts)
    before = run.entry(table)
    if before is not None:
        store.require_same_columns(table, run.read(table, []), raw)
    add = add and before is not None
    (run.append if add else run.publish)(table, raw, metrics=digest_lanes(df.columns))
    lanes = {c: int(run.observed[table][c]) for c in ("row_count", "low", "high")}
    if add:
        # A table that was published by other means has no lanes on record.
        earlier = run.read(table, before.folders).select(*df.columns)
        known = json.loads(before.note) if before.note else _lanes_of(earlier).first().asDict()
        lanes = {c: n + int(known[c]) for c, n in lanes.items()}
    run.annotate(table, json.dumps(lanes))
    return lanes


def _record(run: catalog.Run, rows: list[tuple]) -> None:
    if rows:
        found = run.read(LEDGER)
        entries = run.spark.createDataFrame(rows, LEDGER_SCHEMA)
        run.publish(LEDGER, entries if found is None else ledger_upsert(found, entries))


def load_raw(
    df: DataFrame, table: str, source_file: str, load_ts: datetime.datetime, root: str
) -> int:
    """Replace a RAW table as a whole; readers never see part of it."""
    run = catalog.Run(df.sparkSession, root)
    lanes = _stage_raw(run, df, table, source_file, load_ts, add=False)
    run.commit()
    return lanes["row_count"]


def append_raw(
    df: DataFrame, table: str, source_file: str, load_ts: datetime.datetime, root: str
) -> int:
    """Add the rows of a further delivery to a RAW table, in a folder of their own; the rows the
    table has then. Table and ledger are switched together.

    The ledger gets the digest of everything that was delivered, so a later delivery of all of
    it in one is recognised as unchanged.
    """
    run = catalog.Run(df.sparkSession, root)
    lanes = _stage_raw(run, df, table, source_file, load_ts, add=True)
    _record(run, [(table, source_file, _digest_of(lanes), lanes["row_count"], load_ts)])
    run.commit()
    return lanes["row_count"]


def ledger_upsert(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger with one row per table replaced or added."""
    return upsert(ledger, rows, "table_name")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    found = store.read_current(spark, root, LEDGER)
    return spark.createDataFrame([], LEDGER_SCHEMA) if found is None else found


def raw_counts(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """(table_name, raw_rows) of the published RAW tables; NULL where there is none."""
    parts = []
    for name in tables:
        current = store.read_current(spark, root, name)
        if current is None:
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias("raw_rows"))
        else:
            rows = current.agg(F.count("*").alias("raw_rows"))
        parts.append(rows.withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def load_changed(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    load_ts: datetime.datetime,
    force: bool = False,
) -> dict[str, str]:
    """Load the sources that changed; table name to 'loaded' or 'skipped'.

    A source that is loaded anyway (forced, or not on record) is read once. Others are read to
    compare their digest and, if it is another, once more to load them; rows that are not the
    ones compared are refused. All tables and the ledger are switched together. The loop is over
    the declared tables, never over data.
    """
    known = read_ledger(spark, root)
    # One row per declared table.
    on_record = {row.table_name for row in known.select("table_name").collect()}
    compared = {n: df for n, df in sources.items() if n in on_record and not force}
    digest_of = (
        {row.table_name: row.digest for row in digests(compared).select("table_name", "digest").collect()}
        if compared
        else {}
    )
    found = spark.createDataFrame([(n, digest_of.get(n)) for n in sources], "table_name string, digest string")
    decisions = skip_decision(found, known, raw_counts(spark, root, list(sources)), force)
    skip = {row.table_name: row.skip for row in decisions.collect()}
    run, entries, outcome = catalog.Run(spark, root), [], {}
    for name, df in sources.items():
        outcome[name] = "skipped" if skip[name] else "loaded"
        if skip[name]:
            continue
        file_name = TABLES_BY_NAME[name].file_name
        lanes = _stage_raw(run, df, name, file_name, load_ts, add=False)
        if digest_of.get(name, _digest_of(lanes)) != _digest_of(lanes):
            raise SourceChangedError(f"{file_name} changed while it was loaded; nothing was switched")
        entries.append((name, file_name, _digest_of(lanes), lanes["row_count"], load_ts))
    _record(run, entries)
    run.commit()
    return outcome


# ---------------------------------------------------------------- freshness

# Days after which a source is reported, and after which it blocks.
WARN_DAYS, ERROR_DAYS = 2, 7


def freshness(
    df: DataFrame,
    now: datetime.datetime,
    warn_days: int = WARN_DAYS,
    error_days: int = ERROR_DAYS,
    loaded_at: str = "_loaded_at",
) -> DataFrame:
    """One row: the latest load and whether it is too old at `now`."""
    latest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.lit(now).cast(T.TimestampType()) - F.col("max_loaded_at")

    def older_than(days: int):
        return age > F.make_dt_interval(F.lit(days))

    status = (
        F.when(F.col("max_loaded_at").isNull() | older_than(error_days), "error")
        .when(older_than(warn_days), "warn")
        .otherwise("pass")
    )
    return latest.select("max_loaded_at", status.alias("status"))
