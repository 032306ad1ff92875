"""The same results stated for DuckDB, as named fragments that build on each other.

A fragment refers to another with @name; `sql(name)` collects what it needs. The
statements are written for a reader checking the result, not for speed.
"""

from __future__ import annotations

import re

from lendscope.plans import rules
from lendscope.plans.marts import DIMENSIONS
from lendscope.sources import registry
from verification import mapping

_FRAGMENTS: dict[str, str] = {}
_REFERENCE = re.compile(r"@(\w+)")


def fragment(name: str, sql: str) -> None:
    if name in _FRAGMENTS:
        raise ValueError(f"fragment {name} is defined twice")
    _FRAGMENTS[name] = sql.strip()


def names() -> list[str]:
    return list(_FRAGMENTS)


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in _REFERENCE.findall(sql):
        if name not in seen:
            _needed(_FRAGMENTS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def render(sql: str) -> str:
    ctes = ", ".join(
        f"m_{name} as ({_REFERENCE.sub(r'm_\1', _FRAGMENTS[name])})"
        for name in _needed(sql, [])
    )
    body = _REFERENCE.sub(r"m_\1", sql)
    return f"with {ctes} {body}" if ctes else body


def sql(name: str) -> str:
    return render(_FRAGMENTS[name])


# ---------------------------------------------------------------- RAW and staging

for _name, _sql in mapping.raw_sql(mapping.DUCKDB).items():
    fragment(f"raw_{_name}", _sql)


def typed(kind: str, column: str) -> str:
    whole = f"try_cast(round(try_cast({column} as double), 0) as bigint)"
    return {
        registry.BIGINT: whole,
        registry.DAY_OR_SENTINEL: f"case when {whole} <> 365243 then {whole} end",
        registry.MONEY: f"try_cast({column} as decimal(18,4))",
        registry.DOUBLE: f"try_cast({column} as double)",
        registry.FLAG_01: f"case when {whole} in (0, 1) then {whole} = 1 end",
        registry.FLAG_YN: f"case when {column} in ('Y', 'N') then {column} = 'Y' end",
        registry.TEXT: f"case when trim({column}) <> '' then trim({column}) end",
        registry.CODE: f"case when trim({column}) not in ('', 'XNA') then trim({column}) end",
    }[kind]


def flag(kind: str, column: str) -> str | None:
    if kind == registry.CODE:
        return f"coalesce(trim({column}), '') = 'XNA' as is_{column}_xna"
    if kind == registry.DAY_OR_SENTINEL:
        whole = typed(registry.BIGINT, column)
        return f"coalesce({whole}, 0) = 365243 as is_{column}_sentinel"
    return None


def hashed(*parts: str) -> str:
    texts = (f"coalesce(cast({p} as varchar), '_dbt_utils_surrogate_key_null_')" for p in parts)
    return "md5(" + " || '-' || ".join(texts) + ")"


for _table in registry.TABLES:
    _items = [f"{typed(kind, c)} as {c}" for c, kind in _table.types.items()]
    _items += [f for c, kind in _table.types.items() if (f := flag(kind, c))]
    if _table.row_key:
        _items.append(f"{hashed(*_table.columns)} as {_table.row_key}")
    _items += ["_loaded_at as loaded_at", "_source_file as source_file"]
    fragment(f"stg_{_table.name}", f"select {', '.join(_items)} from @raw_{_table.name}")


# ---------------------------------------------------------------- rules


def bucket(days: str) -> str:
    return (
        f"case when {days} <= 0 then '0' when {days} <= 30 then '1-30' "
        f"when {days} <= 60 then '31-60' when {days} <= 90 then '61-90' "
        f"when {days} > 90 then '90+' end"
    )


def months_before(days: str) -> str:
    return f"cast(floor(cast(-{days} as double) / cast(30.4375 as double)) as bigint)"


def cohort(months: str) -> str:
    return (
        f"case when {months} < 96 then lpad(cast({months} // 12 * 12 as varchar), 2, '0') "
        f"|| '-' || lpad(cast({months} // 12 * 12 + 11 as varchar), 2, '0') || 'm' "
        f"when {months} >= 96 then '96m+' end"
    )


def age_band(days: str) -> str:
    years = f"(cast(-{days} as double) / cast(365.25 as double))"
    return (
        f"case when {years} < 25 then '<25' when {years} < 35 then '25-34' "
        f"when {years} < 45 then '35-44' when {years} < 55 then '45-54' "
        f"when {years} < 65 then '55-64' when {years} >= 65 then '65+' else 'unknown' end"
    )


def income_band(income: str) -> str:
    return (
        f"case when {income} < 90000 then '1: <90k' when {income} < 135000 then '2: 90k-135k' "
        f"when {income} < 180000 then '3: 135k-180k' when {income} < 270000 then '4: 180k-270k' "
        f"when {income} >= 270000 then '5: 270k+' else 'unknown' end"
    )


def wilson(k: str, n: str, sign: str) -> str:
    n = f"cast({n} as double)"
    p = f"(cast({k} as double) / {n})"
    z, z2 = "cast(1.96 as double)", f"cast({1.96 * 1.96!r} as double)"
    shrink = f"(1 + {z2} / {n})"
    return (
        f"({p} + {z2} / (2 * {n})) / {shrink} {sign} "
        f"{z} * sqrt({p} * (1 - {p}) / {n} + {z2} / (4 * {n} * {n})) / {shrink}"
    )


def total(amount: str) -> str:
    return f"cast(sum({amount}) as decimal(38,4))"


# ---------------------------------------------------------------- models

fragment(
    "int_installment_schedule",
    f"""
select {hashed('sk_id_prev', 'num_instalment_number')} as installment_id, sk_id_prev, sk_id_curr,
    num_instalment_number, n_versions, n_payments, due_day, amt_due, amt_paid,
    first_payment_day, last_payment_day, late as days_past_due_raw,
    case when late < 0 then 0 else late end as dpd, {bucket('late')} as dpd_bucket,
    last_payment_day is null as is_unpaid,
    coalesce(n_payments > 0 and amt_due - amt_paid > 0.01, false) as is_underpaid,
    coalesce(n_payments > 0 and amt_paid - amt_due > 0.01, false) as is_overpaid,
    cast(case when n_payments > 0 and amt_due - amt_paid > 0.01 then amt_due - amt_paid end
        as decimal(38,4)) as amt_shortfall,
    loaded_at
from (
    select *, last_payment_day - due_day as late
    from (
        select sk_id_prev, num_instalment_number, max(sk_id_curr) as sk_id_curr,
            count(distinct num_instalment_version) as n_versions,
            -- the amount of a version is repeated on its rows
            cast(list_sum(map_values(map_from_entries(list(distinct
                {{'k': num_instalment_version, 'v': version_amount}})))) as decimal(38,4)) as amt_due,
            max(days_instalment) filter (is_first) as due_day,
            count(amt_payment) filter (is_first) as n_payments,
            cast(sum(amt_payment) filter (is_first) as decimal(38,4)) as amt_paid,
            min(days_entry_payment) filter (is_first) as first_payment_day,
            max(days_entry_payment) filter (is_first) as last_payment_day,
            max(loaded_at) as loaded_at
        from (
            select *,
                num_instalment_version = min(num_instalment_version)
                    over (partition by sk_id_prev, num_instalment_number) as is_first,
                max(amt_instalment) over (partition by sk_id_prev, num_instalment_number,
                    num_instalment_version) as version_amount
            from @stg_installments_payments
        )
        group by sk_id_prev, num_instalment_number
    )
)
""",
)

fragment(
    "int_loan_payment_performance",
    f"""
select sk_id_prev, max(sk_id_curr) as sk_id_curr, count(*) as n_installments,
    count(*) filter (is_unpaid) as n_unpaid_installments,
    count(*) filter (dpd > 0) as n_late_installments,
    count(*) filter (dpd > 30) as n_late_30p_installments,
    max(dpd) as max_dpd, {bucket('max(dpd)')} as dpd_bucket,
    {total('amt_due')} as amt_due_total, {total('amt_paid')} as amt_paid_total
from @int_installment_schedule group by sk_id_prev
""",
)

fragment(
    "int_pos_cash_loan",
    f"""
select sk_id_prev, max(sk_id_curr) as sk_id_curr, min(months_balance) as first_month,
    max(months_balance) as last_month, count(*) as n_months_observed,
    max(months_balance) - min(months_balance) as max_mob,
    min(months_balance) = {mapping.POS_WINDOW_START} as is_left_censored,
    max(cnt_instalment) as cnt_instalment, max(sk_dpd) as max_sk_dpd,
    max(sk_dpd_def) as max_sk_dpd_def,
    min(months_balance) filter (sk_dpd >= 30) - min(months_balance) as first_dpd30_mob,
    arg_max_null(name_contract_status, months_balance) as last_status
from @stg_pos_cash_balance group by sk_id_prev
""",
)

fragment(
    "int_credit_card_loan",
    """
select sk_id_prev, max(sk_id_curr) as sk_id_curr, min(months_balance) as first_month,
    max(months_balance) as last_month, count(*) as n_months_observed,
    max(sk_dpd) as max_sk_dpd, max(sk_dpd_def) as max_sk_dpd_def,
    max(cast(amt_balance as double) / cast(amt_credit_limit_actual as double))
        filter (amt_credit_limit_actual > 0) as max_utilization,
    arg_max_null(amt_balance, months_balance) as last_amt_balance,
    arg_max_null(amt_credit_limit_actual, months_balance) as last_credit_limit,
    arg_max_null(name_contract_status, months_balance) as last_status
from @stg_credit_card_balance group by sk_id_prev
""",
)

fragment(
    "int_bureau_client",
    f"""
select sk_id_curr, count(*) as n_bureau_credits,
    count(*) filter (credit_active = 'Active') as n_active_bureau_credits,
    count(*) filter (credit_active = 'Bad debt') as n_bad_debt_bureau_credits,
    coalesce(cast(sum(amt_credit_sum_debt) filter (credit_active = 'Active'
        and amt_credit_sum_debt > 0) as decimal(38,4)), 0) as bureau_active_debt,
    coalesce(cast(sum(amt_credit_sum_overdue) filter (amt_credit_sum_overdue > 0)
        as decimal(38,4)), 0) as bureau_overdue_amount,
    max(credit_day_overdue) filter (credit_day_overdue + days_credit <= 0)
        as bureau_max_day_overdue
from @stg_bureau group by sk_id_curr
""",
)

fragment(
    "int_client_credit_history",
    f"""
select *,
    case when max_dpd is null then 'no_history' else {bucket('max_dpd')} end as worst_dpd_bucket,
    case when n_installments = 0 then 'no_history' when max_dpd_12m is null then 'none_last_12m'
        else {bucket('max_dpd_12m')} end as worst_dpd_bucket_12m,
    case when n_unpaid_installments > 0 then 'unpaid' when max_dpd is null then 'no_history'
        else {bucket('max_dpd')} end as dpd_bucket,
    coalesce({cohort('tenure_months')}, 'no_prior_loan') as tenure_cohort
from (
    select k.sk_id_curr,
        coalesce(n_installments, 0) as n_installments,
        coalesce(n_unpaid, 0) as n_unpaid_installments,
        coalesce(n_unpaid, 0) > 0 as has_unpaid_installment,
        max_dpd, max_dpd_12m,
        coalesce(n_applications, 0) as n_previous_applications,
        coalesce(n_approved, 0) as n_approved_loans,
        first_approved as first_approved_decision_day,
        {months_before('first_approved')} as tenure_months,
        pos_worst as pos_max_sk_dpd_def, card_worst as cc_max_sk_dpd_def,
        coalesce(n_bureau_credits, 0) as n_bureau_credits,
        coalesce(n_active_bureau_credits, 0) as n_active_bureau_credits,
        coalesce(n_bad_debt_bureau_credits, 0) as n_bad_debt_bureau_credits,
        coalesce(bureau_active_debt, 0) as bureau_active_debt,
        coalesce(bureau_overdue_amount, 0) as bureau_overdue_amount,
        bureau_max_day_overdue
    from (select sk_id_curr from @stg_application_train
          union all select sk_id_curr from @stg_application_test) as k
    left join (select sk_id_curr, count(*) as n_installments,
            count(*) filter (is_unpaid) as n_unpaid, max(dpd) as max_dpd,
            max(dpd) filter (due_day >= -365) as max_dpd_12m
        from @int_installment_schedule group by 1) using (sk_id_curr)
    left join (select sk_id_curr, count(*) as n_applications,
            count(*) filter (name_contract_status = 'Approved') as n_approved,
            min(days_decision) filter (name_contract_status = 'Approved') as first_approved
        from @stg_previous_application group by 1) using (sk_id_curr)
    left join (select sk_id_curr, max(max_sk_dpd_def) as pos_worst
        from @int_pos_cash_loan group by 1) using (sk_id_curr)
    left join (select sk_id_curr, max(max_sk_dpd_def) as card_worst
        from @int_credit_card_loan group by 1) using (sk_id_curr)
    left join @int_bureau_client using (sk_id_curr)
)
""",
)

_DIM_COLUMNS = """
    name_contract_type, code_gender, cnt_children, amt_income_total, amt_credit, amt_annuity,
    amt_goods_price, name_income_type, name_education_type, name_family_status,
    name_housing_type, occupation_type, organization_type, region_rating_client, days_employed,
    is_days_employed_sentinel, flag_own_car, flag_own_realty
"""
_BANDS = f"""
    cast(floor(cast(-days_birth as double) / cast(365.25 as double)) as bigint) as age_years,
    {age_band('days_birth')} as age_band, {income_band('amt_income_total')} as income_band
"""
fragment(
    "dim_client",
    f"""
select sk_id_curr, 'train' as client_source, target = 1 as is_default, {_BANDS}, {_DIM_COLUMNS}
from @stg_application_train
union all
select sk_id_curr, 'test', null, {_BANDS}, {_DIM_COLUMNS}
from @stg_application_test
""",
)

fragment(
    "fct_loans",
    f"""
select a.sk_id_prev, a.sk_id_curr, name_contract_type, name_contract_status, name_portfolio,
    name_product_type, amt_application, amt_credit, amt_down_payment, amt_goods_price,
    amt_annuity, cnt_payment, days_decision,
    {months_before('days_decision')} as loan_age_months,
    {cohort(months_before('days_decision'))} as decision_cohort,
    name_contract_status = 'Approved' as is_approved,
    coalesce(f.n_installments, 0) as n_installments,
    coalesce(f.n_unpaid_installments, 0) as n_unpaid_installments,
    coalesce(f.n_late_installments, 0) as n_late_installments,
    coalesce(f.n_late_30p_installments, 0) as n_late_30p_installments,
    f.max_dpd, f.dpd_bucket, f.amt_due_total, f.amt_paid_total,
    m.sk_id_prev is not null as has_pos_history, m.max_sk_dpd_def as pos_max_sk_dpd_def,
    k.sk_id_prev is not null as has_card_history, k.max_sk_dpd_def as cc_max_sk_dpd_def
from @stg_previous_application as a
left join @int_loan_payment_performance as f on f.sk_id_prev = a.sk_id_prev
left join @int_pos_cash_loan as m on m.sk_id_prev = a.sk_id_prev
left join @int_credit_card_loan as k on k.sk_id_prev = a.sk_id_prev
where a.sk_id_curr in (select sk_id_curr from @stg_application_train)
""",
)

fragment(
    "fct_installments",
    """
select installment_id, i.sk_id_prev, i.sk_id_curr, num_instalment_number,
    a.sk_id_prev is not null as has_loan_record, n_versions, n_payments, due_day, amt_due,
    amt_paid, amt_shortfall, first_payment_day, last_payment_day, days_past_due_raw, dpd,
    dpd_bucket, is_unpaid, is_underpaid, is_overpaid,
    coalesce(days_decision > last_payment_day, false) as is_paid_before_decision, i.loaded_at
from @int_installment_schedule as i
left join @stg_previous_application as a on a.sk_id_prev = i.sk_id_prev
where i.sk_id_curr in (select sk_id_curr from @stg_application_train)
""",
)

fragment(
    "risk_universe",
    """
select c.*, h.* exclude (sk_id_curr)
from (select * from @dim_client where client_source = 'train') as c
join @int_client_credit_history as h on h.sk_id_curr = c.sk_id_curr
""",
)


def segments(dimensions) -> str:
    labels = ", ".join(f"coalesce(cast({d} as varchar), 'unknown') as {d}" for d in dimensions)
    sets = ", ".join(f"({d})" for d in dimensions)
    which = " ".join(f"when grouping({d}) = 0 then '{d}'" for d in dimensions)
    value = f"coalesce({', '.join(dimensions)})"
    return f"""
select dimension, dimension_value, n_clients, n_defaults,
    cast(n_defaults as double) / n_clients as default_rate,
    {wilson('n_defaults', 'n_clients', '-')} as default_rate_ci_low,
    {wilson('n_defaults', 'n_clients', '+')} as default_rate_ci_high,
    cast(n_clients as double) / cast(sum(n_clients) over (partition by dimension) as double)
        as share_of_clients,
    exposure_application_credit, exposure_bureau_active_debt
from (
    select case {which} end as dimension, {value} as dimension_value,
        count(*) as n_clients, count(*) filter (is_default) as n_defaults,
        coalesce({total('amt_credit')}, 0) as exposure_application_credit,
        {total('bureau_active_debt')} as exposure_bureau_active_debt
    from (select is_default, amt_credit, bureau_active_debt, {labels} from @risk_universe)
    group by grouping sets ({sets})
)
"""


fragment("mart_credit_risk", segments(DIMENSIONS))

fragment(
    "mart_vintage_curves",
    """
select cohort, months_on_book, n_loans_in_cohort, n_loans_observable, n_loans_ever_30p,
    cast(n_loans_ever_30p as double) / n_loans_observable as cumulative_30p_rate
from (
    select decision_cohort as cohort, m.range as months_on_book,
        count(*) as n_loans_in_cohort,
        count(*) filter (max_mob >= m.range) as n_loans_observable,
        count(*) filter (max_mob >= m.range and first_dpd30_mob <= m.range) as n_loans_ever_30p
    from @fct_loans as l
    join @int_pos_cash_loan as p on p.sk_id_prev = l.sk_id_prev, range(96) as m
    where is_approved and not is_left_censored and decision_cohort is not null
    group by 1, 2
)
where n_loans_observable > 0
""",
)

fragment(
    "int_loan_status_as_of",
    """
select sk_id_prev, sk_id_curr, name_contract_status, months_balance as observed_month,
    cast(-1 as bigint) as as_of_month
from @stg_pos_cash_balance where months_balance <= -1
qualify months_balance = max(months_balance) over (partition by sk_id_prev)
""",
)
