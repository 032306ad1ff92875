"""Slowly changing history (type 2) of a status, step by step or in closed form.

The business axis is the month a version was detected in (`as_of_month`), so the
validity columns hold months, and NULL `dbt_valid_to` marks the open version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.ordered import LatestStatus

# Names of the version columns in the published history.
SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
VERSION_COLUMNS = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def scd_id(key: str, moment: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), moment.cast("string")))


def _open_version(key: str, moment: Column) -> list[Column]:
    return [
        scd_id(key, moment).alias(SCD_ID),
        moment.alias(UPDATED_AT),
        moment.alias(VALID_FROM),
    ]


def start_history(batch: DataFrame, key: str, moment: Column) -> DataFrame:
    """History whose every version is open: the first load."""
    return batch.select(
        "*", *_open_version(key, moment), F.lit(None).cast("bigint").alias(VALID_TO)
    )


def scd2_apply(
    history: DataFrame,
    batch: DataFrame,
    key: str = "sk_id_prev",
    check_cols: Sequence[str] = ("name_contract_status",),
    moment: Column | None = None,
) -> DataFrame:
    """History after a batch of rows, one for each key and moment, of one or several moments.

    A row whose checked columns differ from the version before it (NULL counts as a value)
    closes that version and opens one; the first row of a new key opens one; an unchanged or
    absent key keeps its versions as they are. A row that says what the history says of its
    moment is already seen, so applying a batch again changes nothing. A row that says
    anything else of a moment the history has passed stops the job: versions are never
    rewritten.

    Versions and rows are brought in order once for each key (a key has at most one version
    or row for each moment), and the history is read once, so plans grow by the same amount
    with every load.
    """
    moment = F.col("as_of_month") if moment is None else moment
    incoming = start_history(batch, key, moment)
    both = history.withColumn("_new", F.lit(False)).unionByName(
        incoming.select(*history.columns).withColumn("_new", F.lit(True))
    )
    checked = F.struct(*check_cols)
    in_order = Window.partitionBy(key).orderBy(VALID_FROM, "_new", *check_cols)
    of_key = Window.partitionBy(key)
    known = F.max(F.when(~F.col("_new"), F.col(VALID_FROM))).over(of_key)
    seen = both.select(
        "*",
        F.lag(checked).over(in_order).alias("_before"),
        F.lag(VALID_FROM).over(in_order).alias("_since"),
        known.alias("_known"),
    )
    differs = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(checked)
    passed = F.coalesce(F.col("_known") >= F.col(VALID_FROM), F.lit(False)) | F.coalesce(
        F.col("_since") == F.col(VALID_FROM), F.lit(False)
    )
    refused = F.raise_error(
        F.concat(
            F.lit("status history is past moment "),
            F.col(VALID_FROM).cast("string"),
            F.lit(f" of {key} "),
            F.col(key).cast("string"),
        )
    ).cast("boolean")
    opens = F.when(differs & passed, refused).otherwise(differs)
    kept = seen.where(F.when(F.col("_new"), opens).otherwise(F.lit(True)))
    closes = F.coalesce(VALID_TO, F.lead(VALID_FROM).over(in_order))
    return kept.withColumn(VALID_TO, closes).select(*history.columns)


# What a row of a batch does to the history.
KIND, OPENS, PAST, REFUSED = "_kind", "opens", "past", "refused"


def scd2_changes(
    open_versions: DataFrame,
    batch: DataFrame,
    key: str = "sk_id_prev",
    check_cols: Sequence[str] = ("name_contract_status",),
    moment: Column | None = None,
) -> DataFrame:
    """The rows of a batch that matter, by kind, from the open versions alone.

    `opens`: a version that begins with this row; its end is set if a later row of the batch
    ends it. `past`: a row of a moment before the open version, which only closed versions can
    judge (`contradictions`). `refused`: a row that says something else than the open version, or
    another row of the batch, says of the same moment. Rows that say what is known are left out.

    The open versions (one for each key) meet the batch in one join on the key; the windows
    that follow are over the batch only, in the partitioning of that join.
    """
    moment = F.col("as_of_month") if moment is None else moment
    incoming = start_history(batch, key, moment)
    checked = F.struct(*check_cols)
    known = open_versions.select(
        F.col(key).alias("_key"), F.col(VALID_FROM).alias("_since"), checked.alias("_open")
    )
    met = incoming.join(known, F.col(key) == F.col("_key"), "left")
    of_moment = Window.partitionBy(key, VALID_FROM).orderBy(*check_cols)
    met = met.withColumn("_first", F.first(checked).over(of_moment)).withColumn(
        "_place", F.row_number().over(of_moment)
    )
    since = F.col("_since")
    kind = (
        F.when(F.col(VALID_FROM) < since, PAST)
        .when((F.col(VALID_FROM) == since) & ~checked.eqNullSafe(F.col("_open")), REFUSED)
        .when(F.col(VALID_FROM) == since, "seen")
        .when((F.col("_place") > 1) & ~checked.eqNullSafe(F.col("_first")), REFUSED)
        .when(F.col("_place") > 1, "seen")
        .otherwise("later")
    )
    sorted_out = met.withColumn(KIND, kind).where(F.col(KIND) != "seen")
    in_order = Window.partitionBy(key, KIND).orderBy(VALID_FROM)
    before = F.coalesce(F.lag(checked).over(in_order), F.col("_open"))
    later = F.col(KIND) == "later"
    differs = before.isNull() | ~before.eqNullSafe(checked)
    told = sorted_out.withColumn("_differs", differs).where(~later | F.col("_differs"))
    ends = F.when(later, F.lead(VALID_FROM).over(in_order))
    return told.withColumn(VALID_TO, ends).select(
        *incoming.columns, F.when(later, OPENS).otherwise(F.col(KIND)).alias(KIND)
    )


def closed_by(open_versions: DataFrame, changes: DataFrame, key: str = "sk_id_prev") -> DataFrame:
    """Versions that the changes close: open ones that end, and new ones that ended at once."""
    opened = changes.where(F.col(KIND) == OPENS)
    ends = opened.groupBy(key).agg(F.min(VALID_FROM).alias("_ends"))
    ended = open_versions.join(ends, key).withColumn(VALID_TO, F.col("_ends"))
    columns = open_versions.columns
    return ended.select(*columns).unionByName(
        opened.where(F.col(VALID_TO).isNotNull()).select(*columns)
    )


def open_after(open_versions: DataFrame, changes: DataFrame, key: str = "sk_id_prev") -> DataFrame:
    """The open versions after the changes."""
    opened = changes.where(F.col(KIND) == OPENS)
    columns = open_versions.columns
    return (
        open_versions.join(opened.select(key).distinct(), key, "left_anti")
        .select(*columns)
        .unionByName(opened.where(F.col(VALID_TO).isNull()).select(*columns))
    )


def contradictions(
    closed: DataFrame,
    changes: DataFrame,
    key: str = "sk_id_prev",
    check_cols: Sequence[str] = ("name_contract_status",),
) -> DataFrame:
    """Rows of the past that no closed version bears out, of the columns of `closed`."""
    past = changes.where(F.col(KIND) == PAST).drop(KIND)
    version = closed.select(
        F.col(key).alias("_key"),
        F.col(VALID_FROM).alias("_from"),
        F.col(VALID_TO).alias("_to"),
        F.struct(*check_cols).alias("_was"),
    )
    same = (
        (F.col(key) == F.col("_key"))
        & (F.col("_from") <= F.col(VALID_FROM))
        & (F.col(VALID_FROM) < F.col("_to"))
        & F.struct(*check_cols).eqNullSafe(F.col("_was"))
    )
    return past.join(version, same, "left_anti").select(*closed.columns)


def status_changes(pos: DataFrame, start: int, end: int) -> DataFrame:
    """One row per run of equal status per loan, seen through monthly loads start..end.

    Months up to `start` are seen at once, by the first load. Rows are first reduced to
    one per loan and load month (combined before the shuffle), so the window that
    follows holds at most end - start + 1 rows per loan.
    """
    load_month = F.greatest(F.col("months_balance"), F.lit(start).cast("bigint"))
    known = pos.where(F.col("months_balance") <= end)
    latest = LatestStatus(known, "months_balance", "name_contract_status", "sk_id_curr")
    seen = (
        known.groupBy("sk_id_prev", load_month.alias("as_of_month"))
        .agg(latest.of.alias("seen"))
        .select(
            "sk_id_prev",
            latest.id("seen").alias("sk_id_curr"),
            latest.status("seen").alias("name_contract_status"),
            latest.month("seen").alias("observed_month"),
            "as_of_month",
        )
    )
    in_order = Window.partitionBy("sk_id_prev").orderBy("as_of_month")
    before = F.lag(F.struct("name_contract_status")).over(in_order)
    return (
        seen.withColumn("_before", before)
        .where(
            F.col("_before").isNull()
            | ~F.col("_before.name_contract_status").eqNullSafe(F.col("name_contract_status"))
        )
        .drop("_before")
    )


def scd2_backfill(pos: DataFrame, start: int = -96, end: int = -1) -> DataFrame:
    """The history that monthly loads start..end would have left, in one pass."""
    if not -96 <= start <= end <= -1:
        raise ValueError(f"months must satisfy -96 <= start <= end <= -1, got {start}..{end}")
    in_order = Window.partitionBy("sk_id_prev").orderBy("as_of_month")
    return status_changes(pos, start, end).select(
        "sk_id_prev",
        "sk_id_curr",
        "name_contract_status",
        "observed_month",
        "as_of_month",
        *_open_version("sk_id_prev", F.col("as_of_month")),
        F.lead("as_of_month").over(in_order).alias(VALID_TO),
    )
