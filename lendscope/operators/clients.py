"""Everything known about a client's past, one row per client.

Every input is reduced to one row per client before it meets the client spine. The
joins are therefore one-to-one on a key both sides are already partitioned by: a
client with a third of all installments is one row by then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.risk import cohort_block, dpd_bucket, money_sum, months_before

# The recent window in days, and the labels of the non-numeric buckets.
RECENT_DAYS = 365
NO_HISTORY = "no_history"
NONE_RECENT = "none_last_12m"
UNPAID = "unpaid"
NO_PRIOR_LOAN = "no_prior_loan"
APPROVED = "Approved"


def bureau_footprint(bureau: DataFrame) -> DataFrame:
    """Credit-bureau totals per client.

    Negative debts and overdue amounts are not exposure; overdue days longer than the
    credit has existed are a data error and do not count for the maximum.
    """
    active = F.col("credit_active") == "Active"
    debt = F.col("amt_credit_sum_debt")
    overdue = F.col("amt_credit_sum_overdue")
    days = F.col("credit_day_overdue")
    zero = F.lit(0).cast("decimal(18,4)")
    return bureau.groupBy("sk_id_curr").agg(
        F.count("*").alias("n_bureau_credits"),
        F.count_if(active).alias("n_active_bureau_credits"),
        F.count_if(F.col("credit_active") == "Bad debt").alias("n_bad_debt_bureau_credits"),
        money_sum(F.when(active & (debt > 0), debt).otherwise(zero)).alias("bureau_active_debt"),
        money_sum(F.when(overdue > 0, overdue).otherwise(zero)).alias("bureau_overdue_amount"),
        F.max(F.when(days <= -F.col("days_credit"), days)).alias("bureau_max_day_overdue"),
    )


def _installment_facts(schedule: DataFrame) -> DataFrame:
    return schedule.groupBy("sk_id_curr").agg(
        F.count("*").alias("n_installments"),
        F.count_if("is_unpaid").alias("n_unpaid_installments"),
        F.max("dpd").alias("max_dpd"),
        F.max(F.when(F.col("due_day") >= -RECENT_DAYS, F.col("dpd"))).alias("max_dpd_12m"),
    )


def _application_facts(previous: DataFrame) -> DataFrame:
    approved = F.col("name_contract_status") == APPROVED
    return previous.groupBy("sk_id_curr").agg(
        F.count("*").alias("n_previous_applications"),
        F.count_if(approved).alias("n_approved_loans"),
        F.min(F.when(approved, F.col("days_decision"))).alias("first_approved_decision_day"),
    )


def _worst_dpd(summary: DataFrame, name: str) -> DataFrame:
    return summary.groupBy("sk_id_curr").agg(F.max("max_sk_dpd_def").alias(name))


_COUNTS = (
    "n_installments",
    "n_unpaid_installments",
    "n_previous_applications",
    "n_approved_loans",
    "n_bureau_credits",
    "n_active_bureau_credits",
    "n_bad_debt_bureau_credits",
)
_AMOUNTS = ("bureau_active_debt", "bureau_overdue_amount")


def client_history(
    train: DataFrame,
    test: DataFrame,
    schedule: DataFrame,
    previous: DataFrame,
    pos_loans: DataFrame,
    cards: DataFrame,
    bureau_clients: DataFrame,
) -> DataFrame:
    """Credit history per client, labelled and unlabelled. Absent history is 0 or NULL."""
    spine = train.select("sk_id_curr").unionByName(test.select("sk_id_curr"))
    facts = [
        _installment_facts(schedule),
        _application_facts(previous),
        _worst_dpd(pos_loans, "pos_max_sk_dpd_def"),
        _worst_dpd(cards, "cc_max_sk_dpd_def"),
        bureau_clients,
    ]
    joined = reduce(lambda left, right: left.join(right, "sk_id_curr", "left"), facts, spine)
    filled = joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in _COUNTS}
        | {name: F.coalesce(F.col(name), F.lit(0).cast("decimal(38,4)")) for name in _AMOUNTS}
    ).withColumns(
        {
            "has_unpaid_installment": F.col("n_unpaid_installments") > 0,
            "tenure_months": months_before(F.col("first_approved_decision_day")),
        }
    )
    lifetime = F.coalesce(dpd_bucket(F.col("max_dpd")), F.lit(NO_HISTORY))
    recent = F.coalesce(dpd_bucket(F.col("max_dpd_12m")), F.lit(NONE_RECENT))
    return filled.withColumns(
        {
            "worst_dpd_bucket": lifetime,
            "worst_dpd_bucket_12m": F.when(F.col("n_installments") > 0, recent).otherwise(
                NO_HISTORY
            ),
            "dpd_bucket": F.when(F.col("has_unpaid_installment"), UNPAID).otherwise(lifetime),
            "tenure_cohort": F.when(
                F.col("tenure_months").isNotNull(), cohort_block(F.col("tenure_months"))
            ).otherwise(NO_PRIOR_LOAN),
        }
    )
