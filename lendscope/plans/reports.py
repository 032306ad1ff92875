"""Questions answered from the published tables. Percentages have two exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions import pairs
from lendscope.functions.risk import DPD_BUCKETS, dpd_bucket
from lendscope.operators.clients import NO_HISTORY, NO_PRIOR_LOAN, RECENT_DAYS, UNPAID
from lendscope.plans.marts import segment_risk

# The labels of the recency groups and of the unpaid comparison.
RECENT, PREVIOUS_YEAR, OLDER = (
    "1. last 12 months",
    "2. 12 to 24 months ago",
    "3. more than 24 months ago",
)
ALL_CLIENTS, WITHOUT_UNPAID, WITH_UNPAID = (
    "All clients",
    "Without unpaid installments",
    "With unpaid installments",
)
BILLION = 1e9


def _exact(value: Column, digits: int) -> Column:
    """Rounded as a decimal: doubles round differently from engine to engine."""
    return F.round(value.cast("decimal(28,10)"), digits).cast(f"decimal(28,{digits})")


def _percent(part: Column, whole: Column) -> Column:
    return _exact(100 * part.cast("double") / whole, 2)


def _dimension(segments: DataFrame, name: str) -> DataFrame:
    return segments.where(F.col("dimension") == name)


def global_rate(segments: DataFrame, dimension: str = "code_gender") -> DataFrame:
    """Clients, defaults, rate and exposure; any one dimension covers every client once."""
    clients, defaults = F.sum("n_clients"), F.sum("n_defaults")
    exposure = F.sum("exposure_application_credit").cast("double") / BILLION
    return _dimension(segments, dimension).agg(
        clients.alias("n_clients"),
        defaults.alias("n_defaults"),
        _percent(defaults, clients).alias("default_rate_pct"),
        _exact(exposure, 1).alias("exposure_bn"),
    )


def unpaid_vs_average(segments: DataFrame) -> DataFrame:
    """Rate of clients with an unpaid installment, and how many times the overall rate."""
    overall = (
        _dimension(segments, "name_contract_type")
        .agg(F.sum("n_defaults").cast("double") / F.sum("n_clients"))
        .scalar()
    )
    unpaid = _dimension(segments, "dpd_bucket").where(F.col("dimension_value") == UNPAID)
    return unpaid.select(
        "n_clients",
        _percent(F.col("n_defaults"), F.col("n_clients")).alias("default_rate_pct"),
        _exact(F.col("default_rate") / overall, 1).alias("times_average"),
    )


def unpaid_segments(segments: DataFrame) -> DataFrame:
    """Rates of all clients, of those without and of those with an unpaid installment."""
    is_unpaid = F.col("dimension_value") == UNPAID
    totals = _dimension(segments, "dpd_bucket").agg(
        F.sum("n_clients").alias("clients"),
        F.sum("n_defaults").alias("defaults"),
        F.sum(F.when(is_unpaid, F.col("n_clients"))).alias("unpaid_clients"),
        F.sum(F.when(is_unpaid, F.col("n_defaults"))).alias("unpaid_defaults"),
    )
    clients, defaults = F.col("clients"), F.col("defaults")
    unpaid_clients, unpaid_defaults = F.col("unpaid_clients"), F.col("unpaid_defaults")

    def line(order: int, segment: str, part: Column, whole: Column) -> Column:
        return F.struct(
            F.lit(segment).alias("segment"),
            F.lit(order).cast("bigint").alias("ord"),
            _exact(100 * F.try_divide(part.cast("double"), whole), 2).alias("default_rate_pct"),
        )

    lines = F.array(
        line(1, ALL_CLIENTS, defaults, clients),
        line(2, WITHOUT_UNPAID, defaults - unpaid_defaults, clients - unpaid_clients),
        F.when(unpaid_clients.isNotNull(), line(3, WITH_UNPAID, unpaid_defaults, unpaid_clients)),
    )
    return totals.select(F.inline(F.array_compact(lines))).orderBy("ord")


def worst_delay(installments: DataFrame, clients: DataFrame) -> DataFrame:
    """(client, worst days late, when it fell due, default flag) of labelled clients.

    The maximum of (days, due day) pairs finds the worst delay and the latest day it
    fell on in one hash aggregation. It also leaves one row per client for the join.
    """
    worst = (
        installments.where(F.col("dpd").isNotNull())
        .groupBy("sk_id_curr")
        .agg(F.max(pairs.pack(F.col("dpd"), F.col("due_day"))).alias("worst"))
        .select(
            "sk_id_curr",
            pairs.unpack_first(F.col("worst")).alias("dpd"),
            pairs.unpack_second(F.col("worst")).alias("due_day"),
        )
    )
    day = F.col("due_day")
    recency = (
        F.when(day >= -RECENT_DAYS, RECENT)
        .when(day >= -2 * RECENT_DAYS, PREVIOUS_YEAR)
        .otherwise(OLDER)
    )
    return worst.join(clients.select("sk_id_curr", "is_default"), "sk_id_curr").select(
        "sk_id_curr", "dpd", "due_day", "is_default", recency.alias("recency")
    )


def worst_dpd_recency(installments: DataFrame, clients: DataFrame, above: int = 90) -> DataFrame:
    """Default rate of clients once more than `above` days late, by how long ago that was."""
    late = worst_delay(installments, clients).where(F.col("dpd") > above)
    return (
        late.groupBy(F.col("recency").alias("when_worst_dpd_happened"))
        .agg(
            F.count("*").alias("n_clients"),
            _percent(F.count_if("is_default"), F.count("*")).alias("default_rate_pct"),
        )
        .orderBy("when_worst_dpd_happened")
    )


def recency_matrix(installments: DataFrame, clients: DataFrame) -> DataFrame:
    """Clients and default rate for each bucket (rows) and recency (column pairs)."""
    labels = {RECENT: "last_12m", PREVIOUS_YEAR: "m12_to_24", OLDER: "over_24m"}
    rows = worst_delay(installments, clients).withColumn("bucket", dpd_bucket(F.col("dpd")))
    measures = []
    for recency, name in labels.items():
        here = F.col("recency") == recency
        n, defaults = F.count_if(here), F.count_if(here & F.col("is_default"))
        measures.append(n.alias(f"n_{name}"))
        measures.append(
            _exact(100 * F.try_divide(defaults.cast("double"), n), 2).alias(f"rate_{name}_pct")
        )
    return rows.groupBy("bucket").agg(*measures).orderBy(_bucket_rank(F.col("bucket")))


def _bucket_rank(bucket: Column) -> Column:
    """Display order of the buckets: no history first, then by days."""
    rank = F.when(bucket == NO_HISTORY, 0)
    for position, label in enumerate(DPD_BUCKETS, start=1):
        rank = rank.when(bucket == label, position)
    return rank


def rate_by_bucket(segments: DataFrame) -> DataFrame:
    """Default rate by lifetime bucket, in display order; the unpaid bucket is left out."""
    rows = _dimension(segments, "dpd_bucket").where(F.col("dimension_value") != UNPAID)
    return rows.select(
        F.col("dimension_value").alias("dpd_bucket"),
        _percent(F.col("n_defaults"), F.col("n_clients")).alias("default_rate_pct"),
        "n_clients",
    ).orderBy(_bucket_rank(F.col("dpd_bucket")))


def rate_by_tenure(segments: DataFrame) -> DataFrame:
    """Default rate by time since the first loan, clients without one first."""
    cohort = F.col("tenure_cohort")
    return (
        _dimension(segments, "tenure_cohort")
        .select(
            F.col("dimension_value").alias("tenure_cohort"),
            _percent(F.col("n_defaults"), F.col("n_clients")).alias("default_rate_pct"),
            "n_clients",
        )
        .orderBy(F.when(cohort == NO_PRIOR_LOAN, "0").otherwise(cohort))
    )


def exposure_by_income(segments: DataFrame) -> DataFrame:
    exposure = F.col("exposure_application_credit").cast("double") / BILLION
    return (
        _dimension(segments, "income_band")
        .select(
            F.col("dimension_value").alias("income_band"),
            _exact(exposure, 2).alias("exposure_bn"),
            _percent(F.col("n_defaults"), F.col("n_clients")).alias("default_rate_pct"),
        )
        .orderBy("income_band")
    )


def worst_dpd_ci(universe: DataFrame) -> DataFrame:
    """Default rate with 95% bounds by the client's lifetime worst bucket."""
    return segment_risk(universe, ("worst_dpd_bucket",)).select(
        F.col("dimension_value").alias("worst_dpd_bucket"),
        "n_clients",
        "n_defaults",
        "default_rate",
        "default_rate_ci_low",
        "default_rate_ci_high",
    )
