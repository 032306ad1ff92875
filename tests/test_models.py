"""Ledger, summaries, history and marts on hand-made rows and against brute force."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendscope.operators import clients, monthly, scd2, schedule, upsert
from lendscope.plans import business_checks, marts

PAYMENT = (
    "sk_id_prev bigint, sk_id_curr bigint, num_instalment_number bigint, "
    "num_instalment_version bigint, days_instalment bigint, days_entry_payment bigint, "
    "amt_instalment decimal(18,4), amt_payment decimal(18,4), loaded_at timestamp"
)
POS = (
    "sk_id_prev bigint, sk_id_curr bigint, months_balance bigint, cnt_instalment bigint, "
    "sk_dpd bigint, sk_dpd_def bigint, name_contract_status string"
)


def payments(spark, rows):
    import datetime

    full = []
    for loan, number, version, due_day, paid_day, due, paid, *day in rows:
        stamp = datetime.datetime(2024, 1, day[0] if day else 1)
        full.append(
            (loan, loan and loan * 10, number, version, due_day, paid_day,
             None if due is None else Decimal(str(due)),
             None if paid is None else Decimal(str(paid)), stamp)
        )
    return spark.createDataFrame(full, PAYMENT)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_payments_count_once_over_versions(spark):
    row = one(schedule.installment_schedule(payments(spark, [
        (1, 1, 1, -100, -100, 11667.195, 11700),
        (1, 1, 2, -90, -90, 32.805, 11700),
    ])))
    assert (row.amt_due, row.amt_paid) == (Decimal("11700.0000"), Decimal("11700.0000"))
    assert (row.n_versions, row.n_payments, row.due_day) == (2, 1, -100)
    assert not row.is_underpaid and not row.is_overpaid and row.dpd == 0


def test_early_unpaid_and_short_installments(spark):
    rows = {r.sk_id_prev: r for r in schedule.installment_schedule(payments(spark, [
        (1, 1, 1, -50, -60, 100, 100),
        (2, 1, 1, -50, None, 100, None),
        (3, 1, 1, -50, -50, 100, 99.99),
        (4, 1, 1, -50, -50, 100, 99.98),
    ])).collect()}
    assert (rows[1].days_past_due_raw, rows[1].dpd, rows[1].dpd_bucket) == (-10, 0, "0")
    assert rows[2].is_unpaid and rows[2].dpd is None and rows[2].n_payments == 0
    assert not rows[2].is_underpaid
    assert not rows[3].is_underpaid
    assert rows[4].is_underpaid and rows[4].amt_shortfall == Decimal("0.0200")


def test_unknown_keys_and_versions_are_dropped(spark):
    rows = payments(spark, [
        (1, 1, None, -50, -50, 100, 100),
        (None, 1, 1, -50, -50, 100, 100),
        (2, None, 1, -50, -50, 100, 100),
        (3, 1, None, -50, -50, 5, 5),
        (3, 1, 2, -50, -50, 10, 10),
    ])
    row = one(schedule.installment_schedule(rows))
    assert (row.sk_id_prev, row.n_versions, row.amt_due) == (3, 2, Decimal("15.0000"))


def test_schedule_matches_brute_force_with_a_hot_loan(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(600):
        loan = 7 if rng.random() < 0.4 else rng.randint(1, 30)
        unpaid = rng.random() < 0.1
        rows.append((
            loan, rng.randint(1, 4), rng.choice([1, 2, 3, None]), -rng.randint(1, 900),
            None if unpaid else -rng.randint(1, 900), rng.randint(1, 500),
            None if unpaid else rng.randint(1, 500),
        ))
    groups = defaultdict(lambda: defaultdict(list))
    for row in rows:
        groups[row[0], row[1]][row[2]].append(row)
    expected = {}
    for key, versions in groups.items():
        known = [v for v in versions if v is not None]
        if not known:
            continue
        first = versions[min(known)]
        days = [r[4] for r in first if r[4] is not None]
        paid = [r[6] for r in first if r[6] is not None]
        expected[key] = (
            len(versions), sum(max(r[5] for r in v) for v in versions.values()),
            max(r[3] for r in first), len(paid), sum(paid) if paid else None,
            min(days, default=None), max(days, default=None),
        )
    got = {
        (r.sk_id_prev, r.num_instalment_number): (
            r.n_versions, int(r.amt_due), r.due_day, r.n_payments,
            None if r.amt_paid is None else int(r.amt_paid), r.first_payment_day,
            r.last_payment_day,
        )
        for r in schedule.installment_schedule(payments(spark, rows)).collect()
    }
    assert got == expected


def test_schedule_plan_has_two_exchanges_and_no_join_or_sort(spark):
    plan = schedule.installment_schedule(payments(spark, [(1, 1, 1, -1, -1, 1, 1)]))
    text = plan._jdf.queryExecution().sparkPlan().toString()
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 2
    assert "Join" not in text and "Sort" not in physical and "Window" not in text


def test_touched_installments_are_rebuilt_from_all_their_payments(spark):
    old = [(1, 1, 1, -50, None, 100, None), (2, 1, 1, -50, -50, 100, 100)]
    new = [(1, 1, 1, -50, -20, 100, 60, 2), (3, 1, 1, -10, -10, 5, 5, 2)]
    before = schedule.installment_schedule(payments(spark, old))
    everything = payments(spark, old + new)
    full = schedule.installment_schedule(everything)
    delta = upsert.schedule_delta(everything, before)
    assert {r.sk_id_prev for r in delta.collect()} == {1, 3}
    merged = upsert.upsert(before, delta, "installment_id")
    assert sorted(map(str, merged.collect())) == sorted(map(str, full.collect()))
    assert upsert.delta_since(full, full).count() == 0
    assert upsert.delta_since(full, full.where("false")).count() == full.count()


def pos(spark, rows):
    return spark.createDataFrame(
        [(loan, loan * 10, month, 12, dpd, 0, status) for loan, month, dpd, status in rows], POS
    )


def test_monthly_summary(spark):
    row = one(monthly.monthly_loan_summary(pos(spark, [
        (1, -96, 0, "Active"), (1, -95, 30, "Active"), (1, -93, 45, None),
    ])))
    assert (row.max_mob, row.is_left_censored, row.first_dpd30_mob) == (3, True, 1)
    assert row.last_status is None and row.n_months_observed == 3


def replay(pos_rows, start, end):
    history = scd2.start_history(
        monthly.status_as_of(pos_rows, start), "sk_id_prev", F.col("as_of_month")
    )
    for month in range(start + 1, end + 1):
        history = scd2.scd2_apply(history, monthly.status_as_of(pos_rows, month))
    return history


def as_set(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_status_runs_treat_null_as_a_value(spark):
    rows = pos(spark, [(1, -4, 0, "A"), (1, -3, 0, "A"), (1, -2, 0, None), (1, -1, 0, "A")])
    versions = scd2.scd2_backfill(rows, -4, -1).orderBy("as_of_month").collect()
    assert [v.name_contract_status for v in versions] == ["A", None, "A"]
    assert [v.dbt_valid_to for v in versions] == [-2, -1, None]


def test_backfill_equals_the_month_by_month_history(spark):
    rng = random.Random(3)
    rows = [
        (loan, month, 0, rng.choice(["A", "B", None]))
        for loan in range(1, 25) for month in range(-9, 0) if rng.random() < 0.6
    ]
    data = pos(spark, rows)
    stepped = replay(data, -6, -3)
    assert as_set(scd2.scd2_backfill(data, -6, -3)) == as_set(stepped)
    again = scd2.scd2_apply(stepped, monthly.status_as_of(data, -3))
    assert as_set(again) == as_set(stepped)
    assert business_checks.scd2_one_current(stepped).count() == 0
    assert business_checks.scd2_no_overlap(stepped).count() == 0
    assert business_checks.scd2_transitions(data, stepped).count() == 0


def test_vintage_curve_matches_brute_force(spark):
    rng = random.Random(11)
    loans, summaries = [], []
    for loan in range(1, 200):
        last = None if rng.random() < 0.03 else rng.choice([rng.randint(0, 20), 95, 120])
        first = rng.randint(0, last) if last is not None and rng.random() < 0.3 else None
        cohort = rng.choice(["00-11m", "12-23m", None])
        loans.append((loan, rng.random() < 0.8, cohort))
        summaries.append((loan, last, rng.random() < 0.1, first))
    expected = {}
    for (_, approved, cohort), (_, last, censored, first) in zip(loans, summaries, strict=True):
        if not approved or cohort is None or censored:
            continue
        for month in range(96):
            size, seen, late = expected.get((cohort, month), (0, 0, 0))
            alive = last is not None and last >= month
            ever = alive and first is not None and first <= month
            expected[cohort, month] = (size + 1, seen + alive, late + ever)
    expected = {k: v for k, v in expected.items() if v[1]}
    curves = marts.vintage_curves(
        spark.createDataFrame(loans, "sk_id_prev int, is_approved boolean, decision_cohort string"),
        spark.createDataFrame(
            summaries,
            "sk_id_prev int, max_mob bigint, is_left_censored boolean, first_dpd30_mob bigint",
        ),
    )
    got = {
        (r.cohort, r.months_on_book): (r.n_loans_in_cohort, r.n_loans_observable, r.n_loans_ever_30p)
        for r in curves.collect()
    }
    assert got == expected


def test_client_with_only_unpaid_installments(spark):
    ledger = schedule.installment_schedule(payments(spark, [(1, 1, 1, -50, None, 100, None)]))
    train = spark.createDataFrame([(10,), (20,)], "sk_id_curr bigint")
    nobody = train.where("false")
    previous = spark.createDataFrame(
        [], "sk_id_curr bigint, name_contract_status string, days_decision bigint"
    )
    loans = spark.createDataFrame([], "sk_id_curr bigint, max_sk_dpd_def bigint")
    bureau = spark.createDataFrame(
        [],
        "sk_id_curr bigint, credit_active string, amt_credit_sum_debt decimal(18,4), "
        "amt_credit_sum_overdue decimal(18,4), credit_day_overdue bigint, days_credit bigint",
    )
    history = {r.sk_id_curr: r for r in clients.client_history(
        train, nobody, ledger, previous, loans, loans, clients.bureau_footprint(bureau)
    ).collect()}
    assert (history[10].worst_dpd_bucket, history[10].worst_dpd_bucket_12m,
            history[10].dpd_bucket) == ("no_history", "none_last_12m", "unpaid")
    assert (history[20].worst_dpd_bucket_12m, history[20].dpd_bucket,
            history[20].tenure_cohort) == ("no_history", "no_history", "no_prior_loan")
    assert history[20].n_installments == 0 and history[20].bureau_active_debt == 0


WINDOW_ROWS = [  # a loan with months outside any horizon, repeated months and a NULL status
    (1, -400, "Active"), (1, -96, "Active"), (1, -3, None), (1, -3, "Signed"), (1, 0, "Signed"), (1, 7, "Active"),
]


def _month_rows(spark):
    rows = [(loan, month, status, 0) for loan, month, status in WINDOW_ROWS]
    return spark.createDataFrame(
        rows, "sk_id_prev bigint, months_balance bigint, name_contract_status string, sk_dpd bigint"
    )


def test_window_queries_read_every_month(spark):
    from verification import queries

    months = _month_rows(spark)
    order = [m for _, m, _ in WINDOW_ROWS]
    ranks = queries.rank_in_side(months).collect()
    assert sorted((r.months_balance, r.rank_in_side) for r in ranks) == [
        (-400, 2), (-96, 1), (-3, 3), (-3, 4), (0, 2), (7, 1)
    ]
    following = sorted((r.months_balance, r.next_month) for r in queries.next_month(months).collect() if r.next_month is not None)
    assert following == sorted(zip(order, order[1:], strict=False))
    before = [r.previous_status for r in queries.previous_status(months).orderBy("months_balance").collect()]
    assert len(before) == 6 and before.count(None) == 2
    assert queries.status_runs(months).first().n_runs == 4


def _loads(spark, rows):
    return spark.createDataFrame(
        rows, "sk_id_prev bigint, sk_id_curr bigint, name_contract_status string, "
        "observed_month bigint, as_of_month bigint",
    )


def _versions(history):
    return sorted((r.sk_id_prev, r.dbt_valid_from, r.dbt_valid_to, r.name_contract_status) for r in history.collect())


def test_a_batch_of_several_months_can_be_replayed(spark):
    batch = _loads(spark, [(1, 9, "A", -24, -24), (1, 9, "B", -1, -1), (2, 9, None, -24, -24), (2, 9, None, -1, -1)])
    empty = scd2.start_history(batch.where("false"), "sk_id_prev", batch["as_of_month"])
    once = scd2.scd2_apply(empty, batch)
    assert _versions(once) == [(1, -24, -1, "A"), (1, -1, None, "B"), (2, -24, None, None)]
    assert _versions(scd2.scd2_apply(once, batch)) == _versions(once)
    part = batch.where("as_of_month = -24")
    assert _versions(scd2.scd2_apply(once, part)) == _versions(once)


@pytest.mark.parametrize("row", [(1, 9, "C", -12, -12), (1, 9, "C", -1, -1), (1, 9, "A", -30, -30)])
def test_a_month_that_has_passed_is_refused(spark, row):
    batch = _loads(spark, [(1, 9, "A", -24, -24), (1, 9, "B", -1, -1)])
    history = scd2.scd2_apply(scd2.start_history(batch.where("false"), "sk_id_prev", batch["as_of_month"]), batch)
    with pytest.raises(Exception, match="is past moment"):
        scd2.scd2_apply(history, _loads(spark, [row])).collect()
    # Other loans do not mind.
    assert scd2.scd2_apply(history, _loads(spark, [(3, *row[1:])])).count() == 3


def test_two_statuses_of_one_month_are_refused(spark):
    batch = _loads(spark, [(1, 9, "A", -24, -24), (1, 9, "B", -24, -24)])
    empty = scd2.start_history(batch.where("false"), "sk_id_prev", batch["as_of_month"])
    with pytest.raises(Exception, match="is past moment"):
        scd2.scd2_apply(empty, batch).collect()


def test_the_plan_grows_by_the_same_amount_with_every_load(spark):
    rows = pos(spark, [(1, m, 0, "Active") for m in range(-14, 0)])
    history = scd2.start_history(monthly.status_as_of(rows, -13), "sk_id_prev", F.col("as_of_month"))
    sizes = []
    for month in range(-12, 0):
        history = scd2.scd2_apply(history, monthly.status_as_of(rows, month))
        plan = history._jdf.queryExecution().analyzed().toString()
        sizes.append(plan.count("LogicalRDD") + plan.count("LocalRelation"))
    steps = {b - a for a, b in zip(sizes, sizes[1:], strict=False)}
    assert len(steps) == 1, sizes


def test_pairs_keep_their_order_and_come_back(spark):
    from lendscope.functions import pairs

    rows = [(a, b) for a in (-5, 0, 7, 2**31 - 1) for b in (-(2**31), -1, 0, 2**31 - 1)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").withColumn("p", pairs.pack(F.col("a"), F.col("b")))
    back = df.select("a", "b", "p", pairs.unpack_first(F.col("p")).alias("x"), pairs.unpack_second(F.col("p")).alias("y")).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in back)
    assert [(r.a, r.b) for r in sorted(back, key=lambda r: r.p)] == sorted(rows)


@pytest.mark.parametrize("name", ["filter_rank_top1", "join_agg_back", "rpt_worst_dpd_recency"])
def test_aggregates_over_numbers_hash(spark, name):
    from verification.queries import REGISTRY

    plan = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_row_checks_do_not_multiply_rows(spark):
    from verification.queries import REGISTRY

    plan = REGISTRY["dq_suite"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
