"""Monthly balance rows to one row per loan or card.

Each summary is a single groupBy. "Value in the latest month" is the maximum of (month, value),
so it needs neither a window nor a join back, combines before the shuffle, and resolves repeated
months the same way on every run. Month and status are packed into one number, so the aggregate
hashes; the card's latest amounts do not fit into one and stay a struct, for which Spark sorts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.ordered import LatestStatus

# First month of the observation window, raw days past due that
# count as a vintage event.
WINDOW_START = -96
EVENT_DPD = 30


def monthly_loan_summary(
    pos: DataFrame, window_start: int = WINDOW_START, with_status: bool = True
) -> DataFrame:
    """POS / cash loan: observation window, worst delinquency, first 30+ month, last status.

    Without `with_status` there is no `last_status`, and no dictionary of statuses is looked up.
    """
    month = F.col("months_balance")
    latest = LatestStatus(pos, "months_balance", "name_contract_status") if with_status else None
    per_loan = pos.groupBy("sk_id_prev").agg(
        F.max("sk_id_curr").alias("sk_id_curr"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
        F.count("*").alias("n_months_observed"),
        F.max("cnt_instalment").alias("cnt_instalment"),
        F.max("sk_dpd").alias("max_sk_dpd"),
        F.max("sk_dpd_def").alias("max_sk_dpd_def"),
        F.min(F.when(F.col("sk_dpd") >= EVENT_DPD, month)).alias("_event_month"),
        *([latest.of.alias("_latest")] if with_status else []),
    )
    return per_loan.where(F.col("sk_id_prev").isNotNull()).select(
        "sk_id_prev",
        "sk_id_curr",
        "first_month",
        "last_month",
        "n_months_observed",
        (F.col("last_month") - F.col("first_month")).alias("max_mob"),
        (F.col("first_month") == window_start).alias("is_left_censored"),
        "cnt_instalment",
        "max_sk_dpd",
        "max_sk_dpd_def",
        (F.col("_event_month") - F.col("first_month")).alias("first_dpd30_mob"),
        *([latest.status("_latest").alias("last_status")] if with_status else []),
    )


def card_summary(balances: DataFrame) -> DataFrame:
    """Card contract: window, worst delinquency, peak utilisation, last balance and limit."""
    limit = F.col("amt_credit_limit_actual")
    # Both sides as double: decimal / decimal would be a decimal here.
    utilization = F.when(limit > 0, F.col("amt_balance").cast("double") / limit.cast("double"))
    per_card = balances.groupBy("sk_id_prev").agg(
        F.max("sk_id_curr").alias("sk_id_curr"),
        F.min("months_balance").alias("first_month"),
        F.max("months_balance").alias("last_month"),
        F.count("*").alias("n_months_observed"),
        F.max("sk_dpd").alias("max_sk_dpd"),
        F.max("sk_dpd_def").alias("max_sk_dpd_def"),
        F.max(utilization).alias("max_utilization"),
        F.max(
            F.struct(
                "months_balance", "amt_balance", "amt_credit_limit_actual", "name_contract_status"
            )
        ).alias("_latest"),
    )
    return per_card.where(F.col("sk_id_prev").isNotNull()).select(
        "sk_id_prev",
        "sk_id_curr",
        "first_month",
        "last_month",
        "n_months_observed",
        "max_sk_dpd",
        "max_sk_dpd_def",
        "max_utilization",
        F.col("_latest.amt_balance").alias("last_amt_balance"),
        F.col("_latest.amt_credit_limit_actual").alias("last_credit_limit"),
        F.col("_latest.name_contract_status").alias("last_status"),
    )


def status_as_of(pos: DataFrame, as_of_month: int = -1) -> DataFrame:
    """Latest known status of each loan at a month; loans not yet seen are absent."""
    known = pos.where(F.col("months_balance") <= as_of_month)
    latest = LatestStatus(known, "months_balance", "name_contract_status", "sk_id_curr")
    return known.groupBy("sk_id_prev").agg(latest.of.alias("_latest")).select(
        "sk_id_prev",
        latest.id("_latest").alias("sk_id_curr"),
        latest.status("_latest").alias("name_contract_status"),
        latest.month("_latest").alias("observed_month"),
        F.lit(as_of_month).cast("bigint").alias("as_of_month"),
    )
