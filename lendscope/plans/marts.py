"""The published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.risk import (
    UNKNOWN,
    Z_95,
    age_band,
    age_in_years,
    cohort_block,
    income_band,
    money_sum,
    months_before,
    wilson_interval,
)
from lendscope.operators.clients import APPROVED
from lendscope.operators.schedule import FACTS, described

# Segment dimensions by the table they come from, curve length.
CLIENT_DIMENSIONS = (
    "name_contract_type",
    "code_gender",
    "age_band",
    "income_band",
    "name_education_type",
    "name_income_type",
    "region_rating_client",
)
HISTORY_DIMENSIONS = ("tenure_cohort", "dpd_bucket", "worst_dpd_bucket_12m")
DIMENSIONS = CLIENT_DIMENSIONS + HISTORY_DIMENSIONS
HORIZON = 96

_CLIENT_ATTRIBUTES = (
    "name_contract_type",
    "code_gender",
    "cnt_children",
    "amt_income_total",
    "amt_credit",
    "amt_annuity",
    "amt_goods_price",
    "name_income_type",
    "name_education_type",
    "name_family_status",
    "name_housing_type",
    "occupation_type",
    "organization_type",
    "region_rating_client",
    "days_employed",
    "is_days_employed_sentinel",
    "flag_own_car",
    "flag_own_realty",
)


def dim_client(train: DataFrame, test: DataFrame) -> DataFrame:
    """Clients with segment bands. The default flag is unknown (NULL) for test clients."""
    columns = ("sk_id_curr", "days_birth", *_CLIENT_ATTRIBUTES)
    labelled = train.select(
        *columns, (F.col("target") == 1).alias("is_default"), F.lit("train").alias("client_source")
    )
    unlabelled = test.select(*columns, F.lit("test").alias("client_source"))
    clients = labelled.unionByName(unlabelled, allowMissingColumns=True)
    return clients.select(
        "sk_id_curr",
        "client_source",
        "is_default",
        age_in_years(F.col("days_birth")).alias("age_years"),
        age_band(F.col("days_birth")).alias("age_band"),
        income_band(F.col("amt_income_total")).alias("income_band"),
        *_CLIENT_ATTRIBUTES,
    )


def _of_train_clients(rows: DataFrame, train: DataFrame) -> DataFrame:
    """Rows of labelled clients. The client key is unique, so a semi join filters exactly.

    Rows are unbounded per client; the session's skew-join handling splits a client
    that is too large for one task (the filter keeps the row side splittable).
    """
    return rows.join(train.select("sk_id_curr"), "sk_id_curr", "left_semi")


def fct_loans(
    previous: DataFrame,
    train: DataFrame,
    performance: DataFrame,
    pos_loans: DataFrame,
    cards: DataFrame,
) -> DataFrame:
    """Previous applications of labelled clients, with what happened to each loan.

    Every joined input has one row per loan, and so has the left side.
    """
    pos = pos_loans.select(
        "sk_id_prev",
        F.lit(True).alias("_in_pos"),
        F.col("max_sk_dpd_def").alias("pos_max_sk_dpd_def"),
    )
    card = cards.select(
        "sk_id_prev",
        F.lit(True).alias("_in_cards"),
        F.col("max_sk_dpd_def").alias("cc_max_sk_dpd_def"),
    )
    loans = (
        _of_train_clients(previous, train)
        .join(performance.drop("sk_id_curr"), "sk_id_prev", "left")
        .join(pos, "sk_id_prev", "left")
        .join(card, "sk_id_prev", "left")
    )
    age = months_before(F.col("days_decision"))

    def zero_if_absent(name: str):
        return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)

    return loans.select(
        "sk_id_prev",
        "sk_id_curr",
        "name_contract_type",
        "name_contract_status",
        "name_portfolio",
        "name_product_type",
        "amt_application",
        "amt_credit",
        "amt_down_payment",
        "amt_goods_price",
        "amt_annuity",
        "cnt_payment",
        "days_decision",
        age.alias("loan_age_months"),
        cohort_block(age).alias("decision_cohort"),
        (F.col("name_contract_status") == APPROVED).alias("is_approved"),
        zero_if_absent("n_installments"),
        zero_if_absent("n_unpaid_installments"),
        zero_if_absent("n_late_installments"),
        zero_if_absent("n_late_30p_installments"),
        "max_dpd",
        "dpd_bucket",
        "amt_due_total",
        "amt_paid_total",
        F.col("_in_pos").isNotNull().alias("has_pos_history"),
        "pos_max_sk_dpd_def",
        F.col("_in_cards").isNotNull().alias("has_card_history"),
        "cc_max_sk_dpd_def",
    )


def fct_installments(schedule: DataFrame, train: DataFrame, previous: DataFrame) -> DataFrame:
    """Installments of labelled clients; those of loans without a record are kept.

    The joins move what the schedule's other columns follow from; those are derived behind them.
    """
    decisions = previous.select(
        "sk_id_prev", F.col("days_decision").alias("_decided"), F.lit(True).alias("_has_record")
    )
    facts = _of_train_clients(schedule.select(*FACTS), train)
    rows = described(facts.join(decisions, "sk_id_prev", "left"), "_decided", "_has_record")
    return rows.select(
        "installment_id",
        "sk_id_prev",
        "sk_id_curr",
        "num_instalment_number",
        F.col("_has_record").isNotNull().alias("has_loan_record"),
        "n_versions",
        "n_payments",
        "due_day",
        "amt_due",
        "amt_paid",
        "amt_shortfall",
        "first_payment_day",
        "last_payment_day",
        "days_past_due_raw",
        "dpd",
        "dpd_bucket",
        "is_unpaid",
        "is_underpaid",
        "is_overpaid",
        F.coalesce(F.col("last_payment_day") < F.col("_decided"), F.lit(False)).alias(
            "is_paid_before_decision"
        ),
        "loaded_at",
    )


def risk_universe(clients: DataFrame, history: DataFrame) -> DataFrame:
    """Labelled clients with every segment dimension in one row."""
    labelled = clients.where(F.col("client_source") == "train").select(
        "sk_id_curr", "is_default", "amt_credit", *CLIENT_DIMENSIONS
    )
    past = history.select("sk_id_curr", "bureau_active_debt", *HISTORY_DIMENSIONS)
    return labelled.join(past, "sk_id_curr")


def segment_risk(
    universe: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, z: float = Z_95
) -> DataFrame:
    """Default rate, bounds and exposure for each value of each dimension.

    One pass over the clients: they are unpivoted in place and summed before the
    shuffle, so only (dimension, value) partial rows travel, however unequal the
    segments are.
    """
    measures = ("is_default", "amt_credit", "bureau_active_debt")
    labels = [
        F.coalesce(F.col(name).cast("string"), F.lit(UNKNOWN)).alias(name) for name in dimensions
    ]
    long = universe.select(*measures, *labels).unpivot(
        list(measures), list(dimensions), "dimension", "dimension_value"
    )
    credit = F.coalesce(F.col("amt_credit"), F.lit(0).cast("decimal(18,4)"))
    segments = long.groupBy("dimension", "dimension_value").agg(
        F.count("*").alias("n_clients"),
        F.count_if("is_default").alias("n_defaults"),
        money_sum(credit).alias("exposure_application_credit"),
        money_sum(F.col("bureau_active_debt")).alias("exposure_bureau_active_debt"),
    )
    # Rows here are distinct labels, no longer clients.
    in_dimension = F.sum("n_clients").over(Window.partitionBy("dimension"))
    low, high = wilson_interval(F.col("n_defaults"), F.col("n_clients"), z)
    return segments.select(
        "dimension",
        "dimension_value",
        "n_clients",
        "n_defaults",
        (F.col("n_defaults").cast("double") / F.col("n_clients")).alias("default_rate"),
        low.alias("default_rate_ci_low"),
        high.alias("default_rate_ci_high"),
        (F.col("n_clients").cast("double") / in_dimension).alias("share_of_clients"),
        "exposure_application_credit",
        "exposure_bureau_active_debt",
    )


def vintage_curves(loans: DataFrame, pos_loans: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Cumulative share of loans that reached 30+ days, by cohort and month on book.

    A loan is observable up to its last month and "ever late" from its first late
    month. Both are step functions, so each loan contributes at most three steps
    (enter, turn late, leave) instead of one row per month it was observed: the curve
    is the running sum of the steps. A late loan that leaves takes its late mark with
    it, which is exact because the first late month is never after the last month.
    """
    eligible = (
        loans.where(F.col("is_approved") & F.col("decision_cohort").isNotNull())
        .select("sk_id_prev", F.col("decision_cohort").alias("cohort"))
        .join(
            pos_loans.where(~F.col("is_left_censored")).select(
                "sk_id_prev", "max_mob", "first_dpd30_mob"
            ),
            "sk_id_prev",
        )
    )
    late = F.col("first_dpd30_mob").isNotNull().cast("bigint")

    def step(month, loans_in, observable, ever_late):
        return F.struct(
            month.cast("bigint").alias("month"),
            loans_in.cast("bigint").alias("loans"),
            observable.cast("bigint").alias("observable"),
            ever_late.cast("bigint").alias("late"),
        )

    zero, one = F.lit(0), F.lit(1)
    left_at = F.coalesce(F.col("max_mob") + 1, zero)
    steps = eligible.select(
        "cohort",
        F.inline(
            F.array(
                step(zero, one, one, zero),
                step(F.col("first_dpd30_mob"), zero, zero, late),
                step(left_at, zero, -one, -late),
            )
        ),
    ).where(F.col("month") < horizon)
    per_month = steps.groupBy("cohort", "month").agg(
        F.sum("loans").alias("loans"),
        F.sum("observable").alias("observable"),
        F.sum("late").alias("late"),
    )

    # At most `horizon` rows per cohort from here on.
    by_month = Window.partitionBy("cohort").orderBy("month")
    running = per_month.select(
        "cohort",
        "month",
        F.sum("loans").over(by_month).alias("n_loans_in_cohort"),
        F.sum("observable").over(by_month).alias("n_loans_observable"),
        F.sum("late").over(by_month).alias("n_loans_ever_30p"),
        F.coalesce(F.lead("month").over(by_month), F.lit(horizon)).alias("_next"),
    )
    # Months without a step repeat the values of the last step.
    months = F.sequence("month", F.col("_next") - 1)
    return (
        running.withColumn("months_on_book", F.explode(months))
        .where(F.col("n_loans_observable") > 0)
        .select(
            "cohort",
            "months_on_book",
            "n_loans_in_cohort",
            "n_loans_observable",
            "n_loans_ever_30p",
            (F.col("n_loans_ever_30p").cast("double") / F.col("n_loans_observable")).alias(
                "cumulative_30p_rate"
            ),
        )
    )
