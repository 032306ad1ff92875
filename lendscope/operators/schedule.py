"""Payments to scheduled installments, and installments to loans.

The source repeats each payment in every schedule version while it splits the
amount due over the versions. So an installment's amount due is the sum over
versions, and its payments and due day come from the lowest version only.

Shape: two hash aggregations, no join, no window, no sort. The first combines
before it shuffles, so a loan, an installment or a version holding a large part
of all rows leaves each map task as one partial row for each version; the second
meets one row per version, dealt by installment. Repartitioning the raw rows
by loan would save the second exchange but send such a loan to a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions.risk import dpd_bucket, money_sum
from lendscope.functions.typing import surrogate_key

CENT = "0.01"


#: What an installment is known by, and a schedule version of it.
INSTALLMENT = ("sk_id_prev", "num_instalment_number")
VERSION = (*INSTALLMENT, "num_instalment_version")


def version_states(payments: DataFrame) -> DataFrame:
    """What the payments of each schedule version of an installment add up to.

    Every column is a maximum, a minimum, a sum or a count, so states of more payments can be
    merged into states of earlier ones (`merge_states`) without going back to those.
    """
    return (
        payments.where(" and ".join(f"{name} is not null" for name in INSTALLMENT))
        .groupBy(*VERSION)
        .agg(
            F.max("sk_id_curr").alias("sk_id_curr"),
            F.max("days_instalment").alias("due_day"),
            F.max("amt_instalment").alias("amt_due"),
            F.max("loaded_at").alias("loaded_at"),
            F.count("amt_payment").alias("n_payments"),
            money_sum(F.col("amt_payment")).alias("amt_paid"),
            F.min("days_entry_payment").alias("first_payment_day"),
            F.max("days_entry_payment").alias("last_payment_day"),
        )
    )


def merge_states(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """The states of all payments, from those of two sets of payments with none in common.

    Grouping takes NULL versions for one, as the aggregate over payments does.
    """
    return (
        earlier.unionByName(later)
        .groupBy(*VERSION)
        .agg(
            F.max("sk_id_curr").alias("sk_id_curr"),
            F.max("due_day").alias("due_day"),
            F.max("amt_due").alias("amt_due"),
            F.max("loaded_at").alias("loaded_at"),
            F.sum("n_payments").alias("n_payments"),
            money_sum(F.col("amt_paid")).alias("amt_paid"),
            F.min("first_payment_day").alias("first_payment_day"),
            F.max("last_payment_day").alias("last_payment_day"),
        )
    )


def _installments(versions: DataFrame) -> DataFrame:
    """One row per (loan, installment number) with due and paid facts."""

    # One min_by per scalar keeps every aggregation buffer fixed-width, which is what
    # lets Spark use a hash aggregate; a min_by over a struct would sort instead.
    def of_lowest_version(name: str) -> Column:
        return F.min_by(name, "num_instalment_version").alias(name)

    # One row per version travels: partial sums of an installment's few versions would be twice as
    # wide, a lowest version beside each of its facts, and hardly fewer.
    return (
        versions.repartition(*INSTALLMENT)
        .groupBy(*INSTALLMENT)
        .agg(
            F.max("sk_id_curr").alias("sk_id_curr"),
            F.count("*").alias("n_versions"),
            money_sum(F.col("amt_due")).alias("amt_due"),
            F.max("loaded_at").alias("loaded_at"),
            F.min("num_instalment_version").alias("_lowest_version"),
            of_lowest_version("due_day"),
            of_lowest_version("n_payments"),
            of_lowest_version("amt_paid"),
            of_lowest_version("first_payment_day"),
            of_lowest_version("last_payment_day"),
        )
        # Without any known version there is no "lowest" to take the payments from.
        .where(F.col("_lowest_version").isNotNull())
    )


def installment_schedule(payments: DataFrame) -> DataFrame:
    """Ledger of scheduled installments, from all payments."""
    return schedule_of_states(version_states(payments))


def schedule_of_states(versions: DataFrame) -> DataFrame:
    """Ledger of scheduled installments with days past due and payment flags."""
    return described(_installments(versions))


#: What is known of an installment; the ledger's other columns follow from these.
FACTS = (
    *INSTALLMENT, "sk_id_curr", "n_versions", "n_payments", "due_day", "amt_due", "amt_paid",
    "first_payment_day", "last_payment_day", "loaded_at",
)


def described(facts: DataFrame, *more: str) -> DataFrame:
    """The ledger's columns from FACTS, and further columns of the rows.

    Rows that are to be joined carry FACTS only and are described behind the join: the key's
    digest alone is as wide as four facts. Days past due of an unpaid installment stay NULL: no
    observation date is known.
    """
    cent = F.lit(CENT).cast("decimal(3,2)")
    has_payment = F.col("n_payments") > 0
    under = has_payment & (F.col("amt_paid") < F.col("amt_due") - cent)
    over = has_payment & (F.col("amt_paid") > F.col("amt_due") + cent)
    days_late = F.col("last_payment_day") - F.col("due_day")
    return facts.select(
        surrogate_key("sk_id_prev", "num_instalment_number").alias("installment_id"),
        "sk_id_prev",
        "sk_id_curr",
        "num_instalment_number",
        "n_versions",
        "n_payments",
        "due_day",
        "amt_due",
        "amt_paid",
        "first_payment_day",
        "last_payment_day",
        days_late.alias("days_past_due_raw"),
        # greatest() skips NULL and would turn "unknown" into 0.
        F.when(days_late.isNotNull(), F.greatest(days_late, F.lit(0))).alias("dpd"),
        dpd_bucket(days_late).alias("dpd_bucket"),
        F.col("last_payment_day").isNull().alias("is_unpaid"),
        F.coalesce(under, F.lit(False)).alias("is_underpaid"),
        F.coalesce(over, F.lit(False)).alias("is_overpaid"),
        F.when(under, F.col("amt_due") - F.col("amt_paid"))
        .cast("decimal(38,4)")
        .alias("amt_shortfall"),
        "loaded_at",
        *more,
    )


def loan_performance(schedule: DataFrame) -> DataFrame:
    """Payment behaviour per loan, loans without an application record included."""
    return (
        schedule.groupBy("sk_id_prev")
        .agg(
            F.max("sk_id_curr").alias("sk_id_curr"),
            F.count("*").alias("n_installments"),
            F.count_if("is_unpaid").alias("n_unpaid_installments"),
            F.count_if(F.col("dpd") > 0).alias("n_late_installments"),
            F.count_if(F.col("dpd") > 30).alias("n_late_30p_installments"),
            F.max("dpd").alias("max_dpd"),
            money_sum(F.col("amt_due")).alias("amt_due_total"),
            money_sum(F.col("amt_paid")).alias("amt_paid_total"),
        )
        .withColumn("dpd_bucket", dpd_bucket(F.col("max_dpd")))
    )
