"""Business rules across tables. Each function returns the rows that break its rule.

Totals of two tables are compared through scalar subqueries, so no rule needs a cross
join; rows are reduced to one per key before they meet another table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.risk import money_sum
from lendscope.operators.clients import UNPAID
from lendscope.operators.quality import ERROR, WARN
from lendscope.functions.ordered import LatestStatus
from lendscope.operators.scd2 import VALID_FROM, VALID_TO

CENT = "0.01"


def _cent() -> Column:
    return F.lit(CENT).cast("decimal(3,2)")


def _total(df: DataFrame, value: Column) -> Column:
    return df.agg(value).scalar()


def train_test_disjoint(train: DataFrame, test: DataFrame) -> DataFrame:
    """Clients in both application sets."""
    return train.select("sk_id_curr").join(test.select("sk_id_curr"), "sk_id_curr", "left_semi")


def bureau_overdue_age(bureau: DataFrame) -> DataFrame:
    """Credits overdue for longer than they have existed."""
    return bureau.where(F.col("credit_day_overdue") + F.col("days_credit") > 0).select(
        "sk_id_bureau", "credit_day_overdue", "days_credit"
    )


def client_keys(
    train: DataFrame, test: DataFrame, bureau: DataFrame, previous: DataFrame
) -> DataFrame:
    """Rows that name a client neither application set knows; a NULL client is unknown too."""
    known = train.select("sk_id_curr").unionByName(test.select("sk_id_curr"))

    def strangers(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.lit(name).alias("source_table"), "sk_id_curr")
        return rows.join(known, "sk_id_curr", "left_anti").select("source_table", "sk_id_curr")

    return strangers(bureau, "bureau").unionByName(strangers(previous, "previous_application"))


def unpaid_flag(
    installments: DataFrame, history: DataFrame, clients: DataFrame, segments: DataFrame
) -> DataFrame:
    """Clients whose unpaid count differs between fact and history, and the segment total
    if it differs from the flagged clients."""
    in_fact = installments.groupBy("sk_id_curr").agg(F.count_if("is_unpaid").alias("n_unpaid"))
    labelled = clients.where(F.col("client_source") == "train").select("sk_id_curr")
    of_train = history.select(
        "sk_id_curr", "n_unpaid_installments", "has_unpaid_installment"
    ).join(labelled, "sk_id_curr", "left_semi")
    counted = F.col("n_unpaid_installments")
    differs = (counted != F.coalesce("n_unpaid", F.lit(0))) | (
        F.col("has_unpaid_installment") != (counted > 0)
    )
    nothing = F.lit(None).cast("bigint")
    by_client = (
        of_train.join(in_fact, "sk_id_curr", "left")
        .where(differs)
        .select("sk_id_curr", nothing.alias("in_mart"), nothing.alias("in_history"))
    )
    bucket = segments.where(
        (F.col("dimension") == "dpd_bucket") & (F.col("dimension_value") == UNPAID)
    )
    flagged = of_train.agg(F.count_if("has_unpaid_installment").alias("in_history"))
    in_mart = _total(bucket, F.coalesce(F.sum("n_clients"), F.lit(0)))
    by_total = flagged.select(
        nothing.alias("sk_id_curr"), in_mart.cast("bigint").alias("in_mart"), "in_history"
    ).where(F.col("in_mart") != F.col("in_history"))
    return by_client.unionByName(by_total)


def dpd_possible(pos: DataFrame, cards: DataFrame, bureau: DataFrame) -> DataFrame:
    """Negative days past due, or tolerant days above raw days."""
    raw, tolerant = F.col("sk_dpd"), F.col("sk_dpd_def")
    impossible = (raw < 0) | (tolerant < 0) | (tolerant > raw)

    def monthly(df: DataFrame, name: str) -> DataFrame:
        return df.where(impossible).select(
            F.lit(name).alias("source_table"),
            F.col("sk_id_prev").alias("entity_id"),
            "months_balance",
        )

    credits = bureau.where(F.col("credit_day_overdue") < 0).select(
        F.lit("bureau").alias("source_table"), F.col("sk_id_bureau").alias("entity_id")
    )
    return (
        monthly(pos, "pos_cash_balance")
        .unionByName(monthly(cards, "credit_card_balance"))
        .unionByName(credits, allowMissingColumns=True)
    )


def _installment_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_installments"),
        money_sum(F.col("amt_due")).alias("amt_due"),
        money_sum(F.coalesce("amt_paid", F.lit(0).cast("decimal(38,4)"))).alias("amt_paid"),
        F.count_if("is_unpaid").alias("n_unpaid"),
    )


def fct_vs_schedule(schedule: DataFrame, train: DataFrame, installments: DataFrame) -> DataFrame:
    """The fact must hold exactly the schedule of the labelled clients.

    Guards the incremental merge: a lost or doubled row shows up here.
    """
    scheduled = schedule.join(train.select("sk_id_curr"), "sk_id_curr", "left_semi")
    expected, actual = (
        _installment_totals(df).select(F.struct("*").alias("totals"))
        for df in (scheduled, installments)
    )
    want = expected.select(F.col("totals").alias("want"))
    both = want.select("want", actual.scalar().alias("have"))

    def off(name: str) -> Column:
        return F.abs(F.col(f"want.{name}") - F.col(f"have.{name}")) > _cent()

    broken = (
        (F.col("want.n_installments") != F.col("have.n_installments"))
        | off("amt_due")
        | off("amt_paid")
        | (F.col("want.n_unpaid") != F.col("have.n_unpaid"))
    )
    return both.where(broken).select(
        F.col("want.n_installments").alias("expected_installments"),
        F.col("have.n_installments").alias("actual_installments"),
    )


def fct_loans_cover(
    previous: DataFrame, train: DataFrame, loans: DataFrame, installments: DataFrame
) -> DataFrame:
    """One loan row per labelled application, and installment counts that add up."""
    labelled = previous.join(train.select("sk_id_curr"), "sk_id_curr", "left_semi")
    with_record = installments.where("has_loan_record")
    return (
        loans.agg(
            F.count("*").alias("actual_loans"),
            F.sum("n_installments").alias("loan_installments"),
        )
        .select(
            _total(labelled, F.count("*")).alias("expected_loans"),
            "actual_loans",
            "loan_installments",
            _total(with_record, F.count("*")).alias("fact_installments"),
        )
        .where(
            (F.col("expected_loans") != F.col("actual_loans"))
            | (F.col("loan_installments") != F.col("fact_installments"))
        )
    )


def payment_before_decision(payments: DataFrame, previous: DataFrame) -> DataFrame:
    """Payments entered before the loan was decided."""
    decided = previous.select("sk_id_prev", "days_decision")
    return (
        payments.select("installment_payment_id", "sk_id_prev", "days_entry_payment")
        .join(decided, "sk_id_prev")
        .where(F.col("days_entry_payment") < F.col("days_decision"))
        .select("installment_payment_id", "sk_id_prev", "days_entry_payment", "days_decision")
    )


def schedule_amounts(schedule: DataFrame) -> DataFrame:
    """Installments paid short or over by more than a cent."""
    return schedule.where(F.col("is_underpaid") | F.col("is_overpaid")).select(
        "installment_id", "sk_id_prev", "num_instalment_number", "amt_due", "amt_paid"
    )


def mart_partition(segments: DataFrame, clients: DataFrame) -> DataFrame:
    """Dimensions that do not add up to the labelled clients."""
    labelled = clients.where(F.col("client_source") == "train")
    credit = F.coalesce(F.col("amt_credit"), F.lit(0).cast("decimal(18,4)"))
    per_dimension = segments.groupBy("dimension").agg(
        F.sum("n_clients").alias("n_clients"),
        F.sum("n_defaults").alias("n_defaults"),
        money_sum(F.col("exposure_application_credit")).alias("exposure"),
    )
    return per_dimension.select(
        "*",
        _total(labelled, F.count("*")).alias("expected_clients"),
        _total(labelled, F.count_if("is_default")).alias("expected_defaults"),
        _total(labelled, money_sum(credit)).alias("expected_exposure"),
    ).where(
        (F.col("n_clients") != F.col("expected_clients"))
        | (F.col("n_defaults") != F.col("expected_defaults"))
        | (F.abs(F.col("exposure") - F.col("expected_exposure")) > _cent())
    )


def _any_negative(*columns: str) -> Column:
    return F.least(*(F.coalesce(F.col(c), F.lit(0).cast("decimal(18,4)")) for c in columns)) < 0


def negative_bureau(bureau: DataFrame) -> DataFrame:
    """Negative debt, limit or overdue amounts."""
    shown = ("amt_credit_sum_debt", "amt_credit_sum_limit", "amt_credit_sum_overdue")
    return bureau.where(_any_negative(*shown, "amt_credit_max_overdue")).select(
        "sk_id_bureau", *shown
    )


def negative_card(cards: DataFrame) -> DataFrame:
    """Negative balances, drawings or receivables."""
    shown = (
        "amt_balance",
        "amt_drawings_current",
        "amt_drawings_atm_current",
        "amt_receivable_principal",
    )
    hidden = ("amt_drawings_pos_current", "amt_drawings_other_current")
    return cards.where(_any_negative(*shown, *hidden)).select(
        "sk_id_prev", "months_balance", *shown
    )


def scd2_one_current(history: DataFrame) -> DataFrame:
    """Loans without exactly one open version."""
    return (
        history.groupBy("sk_id_prev")
        .agg(F.count_if(F.col(VALID_TO).isNull()).alias("n_open"))
        .where(F.col("n_open") != 1)
        .select("sk_id_prev")
    )


def scd2_no_overlap(history: DataFrame) -> DataFrame:
    """Versions that do not end where the next one starts (a loan has few versions)."""
    following = F.lead(VALID_FROM).over(Window.partitionBy("sk_id_prev").orderBy(VALID_FROM))
    return (
        history.select("sk_id_prev", VALID_TO, following.alias("_next"))
        .where(F.col(VALID_TO) != F.col("_next"))
        .select("sk_id_prev")
    )


def scd2_transitions(pos: DataFrame, history: DataFrame) -> DataFrame:
    """Loans whose versions differ in number from their status runs, recounted from staging.

    The replayed months are read from the history. Staging rows are reduced to one per
    loan and load month first, so a loan's window is as short as the replay.
    """
    start = _total(history, F.min("as_of_month"))
    end = _total(history, F.max("as_of_month"))
    month = F.col("months_balance")
    latest = LatestStatus(pos, "months_balance", "name_contract_status")
    seen = (
        pos.where(month <= end)
        .groupBy("sk_id_prev", F.greatest(month, start).alias("load_month"))
        .agg(latest.of.alias("latest"))
        .select(
            "sk_id_prev",
            "load_month",
            F.coalesce(latest.status("latest"), F.lit("(null)")).alias("status"),
        )
    )
    before = F.lag("status").over(Window.partitionBy("sk_id_prev").orderBy("load_month"))
    runs = (
        seen.withColumn("before", before)
        .groupBy("sk_id_prev")
        .agg(
            F.count_if(F.col("before").isNull() | (F.col("before") != F.col("status"))).alias(
                "expected_versions"
            )
        )
    )
    versions = history.groupBy("sk_id_prev").agg(F.count("*").alias("actual_versions"))
    return runs.join(versions, "sk_id_prev", "left").where(
        ~F.col("expected_versions").eqNullSafe(F.col("actual_versions"))
    )


def vintage_monotone(curves: DataFrame) -> DataFrame:
    """Points where more loans are observable than before, or month 0 misses some.

    A cohort has at most as many points as the curve has months.
    """
    before = F.lag("n_loans_observable").over(
        Window.partitionBy("cohort").orderBy("months_on_book")
    )
    observable = F.col("n_loans_observable")
    return (
        curves.withColumn("previous_observable", before)
        .where(
            (observable > F.col("previous_observable"))
            | ((F.col("months_on_book") == 0) & (observable != F.col("n_loans_in_cohort")))
        )
        .select("cohort", "months_on_book", "n_loans_observable", "previous_observable")
    )


# Severity by rule: an error stops the job, a warning is reported.
SEVERITY = {
    "train_test_disjoint": ERROR,
    "bureau_overdue_age": WARN,
    "client_keys": ERROR,
    "unpaid_flag": ERROR,
    "dpd_possible": ERROR,
    "fct_vs_schedule": ERROR,
    "fct_loans_cover": ERROR,
    "payment_before_decision": WARN,
    "schedule_amounts": WARN,
    "mart_partition": ERROR,
    "negative_bureau": WARN,
    "negative_card": WARN,
    "scd2_one_current": ERROR,
    "scd2_no_overlap": ERROR,
    "scd2_transitions": ERROR,
    "vintage_monotone": ERROR,
}


def all_business_checks(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Offending rows of every rule over the named tables.

    The status-history rules run when the history is given.
    """
    train, test = t["stg_application_train"], t["stg_application_test"]
    bureau, previous = t["stg_bureau"], t["stg_previous_application"]
    payments, pos = t["stg_installments_payments"], t["stg_pos_cash_balance"]
    cards, schedule = t["stg_credit_card_balance"], t["int_installment_schedule"]
    clients, installments, loans = t["dim_client"], t["fct_installments"], t["fct_loans"]
    history, segments = t["int_client_credit_history"], t["mart_credit_risk"]
    checks = {
        "train_test_disjoint": train_test_disjoint(train, test),
        "bureau_overdue_age": bureau_overdue_age(bureau),
        "client_keys": client_keys(train, test, bureau, previous),
        "unpaid_flag": unpaid_flag(installments, history, clients, segments),
        "dpd_possible": dpd_possible(pos, cards, bureau),
        "fct_vs_schedule": fct_vs_schedule(schedule, train, installments),
        "fct_loans_cover": fct_loans_cover(previous, train, loans, installments),
        "payment_before_decision": payment_before_decision(payments, previous),
        "schedule_amounts": schedule_amounts(schedule),
        "mart_partition": mart_partition(segments, clients),
        "negative_bureau": negative_bureau(bureau),
        "negative_card": negative_card(cards),
        "vintage_monotone": vintage_monotone(t["mart_vintage_curves"]),
    }
    if "snp_loan_status" in t:
        versions = t["snp_loan_status"]
        checks |= {
            "scd2_one_current": scd2_one_current(versions),
            "scd2_no_overlap": scd2_no_overlap(versions),
            "scd2_transitions": scd2_transitions(pos, versions),
        }
    return checks


# ---------------------------------------------------------------- layers

MARTS = ("fct_loans", "fct_installments", "dim_client", "mart_credit_risk", "mart_vintage_curves")


def verify_layers(
    raw_train: DataFrame,
    staged_train: DataFrame,
    marts: Mapping[str, DataFrame],
    history: DataFrame | None = None,
) -> DataFrame:
    """One message per layer that is empty or does not reconcile; no rows when all is well."""

    def rows(df: DataFrame) -> Column:
        return _total(df, F.count("*"))

    gender = marts["mart_credit_risk"].where(F.col("dimension") == "code_gender")
    counts = {f"n_{name}": rows(marts[name]) for name in MARTS} | {
        "n_raw": rows(raw_train),
        "n_staged": rows(staged_train),
        "n_covered": _total(gender, F.coalesce(F.sum("n_clients"), F.lit(0))),
    }
    if history is not None:
        counts["n_history"] = rows(history)
    one_row = raw_train.sparkSession.range(1).select(*(c.alias(n) for n, c in counts.items()))

    raw, staged, covered = F.col("n_raw"), F.col("n_staged"), F.col("n_covered")
    messages = [F.when(F.col(f"n_{name}") == 0, f"no rows in {name}") for name in MARTS]
    messages += [
        F.when(raw == 0, "no rows landed for application_train"),
        F.when(
            raw != staged,
            F.format_string("%d clients landed, %d are staged", raw, staged),
        ),
        F.when(
            raw != covered,
            F.format_string("%d clients landed, %d stand in mart_credit_risk", raw, covered),
        ),
    ]
    if history is not None:
        messages.append(F.when(F.col("n_history") == 0, "no rows in the status history"))
    return one_row.select(F.explode(F.array_compact(F.array(*messages))).alias("message"))
