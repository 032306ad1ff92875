"""Lending-shaped RAW tables derived from the generic test tables.

One SQL text per table, rendered for Spark or for DuckDB; the two renderings differ
only in day arithmetic. Integer and decimal arithmetic throughout, so both engines
produce the same text. Days count from 2002-01-01 and are negative.
"""

from __future__ import annotations

from lendscope.plans import rules
from lendscope.sources.registry import DOUBLE, FLAG_01, TABLES_BY_NAME

SPARK, DUCKDB = "spark", "duckdb"
ANCHOR = "2002-01-01"
CARD_ANCHOR = "2024-01-31"
POS_WINDOW_START = -84

EARLY_LOAD = "timestamp '2024-01-01 00:00:00'"
LATE_LOAD = "timestamp '2024-01-02 00:00:00'"


def days_between(dialect: str, value: str, anchor: str) -> str:
    if dialect == SPARK:
        return f"datediff(cast({value} as date), date '{anchor}')"
    return f"date_diff('day', date '{anchor}', cast({value} as date))"


def months_from_anchor(value: str) -> str:
    return f"((year({value}) - 2002) * 12 + month({value}) - 1)"


def money(value: str) -> str:
    return f"cast({value} as decimal(18,4))"


def _pick(number: str, values) -> str:
    """One of the values, by the remainder of an integer."""
    cases = " ".join(
        f"when {i} then '{value}'" for i, value in enumerate(values)
    )
    return f"case ({number}) % {len(values)} {cases} end"


def _fraction(number: str) -> str:
    """'0.dddd' text from an integer."""
    return f"'0.' || lpad(cast(({number}) % 10000 as string), 4, '0')"


def _application(train: bool) -> dict[str, str]:
    k = "c_custkey"
    columns = {
        "sk_id_curr": k,
        "target": "case when c_acctbal < 0 then 1 else 0 end",
        "name_contract_type": "case when c_mktsegment = 'FURNITURE' then 'Revolving loans' "
        "else ' Cash loans ' end",
        "code_gender": f"case when {k} % 97 = 0 then 'XNA' when {k} % 3 = 0 then 'M' else 'F' end",
        "flag_own_car": f"case {k} % 7 when 0 then 'y' when 1 then null when 2 then 'Y' else 'N' end",
        "flag_own_realty": f"case when {k} % 3 = 0 then 'N' else 'Y' end",
        "cnt_children": f"{k} % 4",
        "amt_income_total": f"case when {k} % 101 = 0 then null else 60000 + ({k} * 7919) % 300000 end",
        "amt_credit": f"cast(100000 + ({k} * 104729) % 900000 as string) || '.5'",
        "amt_annuity": f"cast(5000 + ({k} * 31) % 40000 as string) || '.12345'",
        "amt_goods_price": f"case when {k} % 50 = 0 then 'n/a' "
        f"else cast(90000 + ({k} * 17) % 800000 as string) end",
        "days_birth": f"-(7000 + ({k} * 37) % 18000)",
        "days_employed": f"case when {k} % 5 = 0 then '365243' "
        f"else cast(-(({k} * 13) % 9000) as string) || '.0' end",
        "days_registration": f"cast(-(({k} * 17) % 9000) as string) || '.5'",
        "days_id_publish": f"-(({k} * 19) % 6000)",
        "own_car_age": f"case when {k} % 2 = 0 then '' else cast({k} % 30 as string) || '.0' end",
        "cnt_fam_members": f"cast(1 + {k} % 5 as string) || '.0'",
        "region_rating_client": f"1 + {k} % 3",
        "region_rating_client_w_city": f"1 + ({k} + 1) % 3",
        "hour_appr_process_start": f"{k} % 25",
        "days_last_phone_change": f"-(({k} * 23) % 4000)",
        "region_population_relative": _fraction(f"{k} * 3"),
        "ext_source_1": f"case when {k} % 3 = 0 then null else {_fraction(f'{k} * 7')} end",
        "ext_source_2": f"case when {k} % 200 = 0 then '1.5' else {_fraction(f'{k} * 11')} end",
        "ext_source_3": _fraction(f"{k} * 13"),
        "organization_type": f"case when {k} % 5 = 0 then ' XNA ' "
        f"else {_pick(k, rules.ORGANIZATIONS)} end",
        "name_type_suite": _pick(k, rules.SUITES),
        "name_income_type": _pick(f"{k} + 1", rules.INCOME_TYPES),
        "name_education_type": _pick(f"{k} + 2", rules.EDUCATION),
        "name_family_status": _pick(f"{k} + 3", rules.FAMILY),
        "name_housing_type": _pick(f"{k} + 4", rules.HOUSING),
        "occupation_type": f"case when {k} % 9 = 0 then '  ' "
        f"else {_pick(f'{k} + 5', rules.OCCUPATIONS)} end",
        "weekday_appr_process_start": _pick(f"{k} + 6", rules.WEEKDAYS),
        "fondkapremont_mode": _pick(k, rules.FUNDS),
        "housetype_mode": _pick(k, rules.HOUSE_TYPES),
        "wallsmaterial_mode": _pick(k, rules.WALLS),
        "emergencystate_mode": f"case when {k} % 13 = 0 then 'Maybe' when {k} % 2 = 0 then 'Yes' else 'No' end",
    }
    table = TABLES_BY_NAME["application_train" if train else "application_test"]
    # Remaining columns follow from their position and type.
    for i, (name, kind) in enumerate(table.types.items()):
        if name in columns:
            continue
        if kind == DOUBLE:
            columns[name] = f"case when ({k} + {i}) % 3 = 0 then null else {_fraction(f'{k} * {i + 3}')} end"
        elif kind == FLAG_01:
            columns[name] = f"({k} + {i}) % 2"
        else:
            columns[name] = f"cast(({k} + {i}) % 5 as string) || '.0'"
    return {name: columns[name] for name in table.types}


def _previous_application(dialect: str) -> dict[str, str]:
    k = "o_orderkey"
    day = days_between(dialect, "o_orderdate", ANCHOR)
    price = money("o_totalprice")

    def day_or_placeholder(every: int, shift: int) -> str:
        return f"case when {k} % {every} = 0 then 365243 else {day} + {shift} end"

    def code(every: int, values) -> str:
        return f"case when {k} % {every} = 1 then 'XNA' else {_pick(k, values)} end"

    return {
        "sk_id_prev": k,
        "sk_id_curr": "o_custkey",
        "hour_appr_process_start": f"{k} % 24",
        "days_decision": day,
        "sellerplace_area": f"{k} % 500 - 1",
        "cnt_payment": f"cast(6 * (1 + {k} % 10) as string) || '.0'",
        "days_first_drawing": day_or_placeholder(2, 3),
        "days_first_due": day_or_placeholder(7, 30),
        "days_last_due_1st_version": day_or_placeholder(6, 300),
        "days_last_due": day_or_placeholder(5, 200),
        "days_termination": day_or_placeholder(4, 210),
        "amt_annuity": f"cast({price} * 0.05 as decimal(18,4))",
        "amt_application": price,
        "amt_credit": f"{price} + 100",
        "amt_down_payment": f"case when {k} % 3 = 0 then null else {k} % 1000 end",
        "amt_goods_price": price,
        "rate_down_payment": _fraction(f"{k} * 3"),
        "rate_interest_primary": f"case when {k} % 50 = 0 then {_fraction(k)} end",
        "rate_interest_privileged": f"case when {k} % 60 = 0 then {_fraction(k)} end",
        "nflag_last_appl_in_day": f"{k} % 2",
        "nflag_insured_on_approval": f"case when {k} % 4 = 0 then null else cast({k} % 2 as string) || '.0' end",
        "flag_last_appl_per_contract": f"case when {k} % 11 = 0 then 'N' else 'Y' end",
        "weekday_appr_process_start": _pick(k, rules.WEEKDAYS),
        "name_contract_status": "case when o_orderstatus = 'P' then 'Refused' else 'Approved' end",
        "name_type_suite": _pick(f"{k} + 1", rules.SUITES),
        "channel_type": _pick(f"{k} + 2", rules.CHANNELS),
        "product_combination": _pick(f"{k} + 3", rules.PRODUCTS),
        "name_contract_type": code(97, rules.PREVIOUS_CONTRACTS),
        "name_cash_loan_purpose": code(3, rules.PURPOSES),
        "name_payment_type": code(4, rules.PAYMENT_TYPES),
        "code_reject_reason": code(53, rules.REJECT_REASONS),
        "name_client_type": code(71, rules.CLIENT_TYPES),
        "name_goods_category": code(2, rules.GOODS),
        "name_portfolio": code(5, rules.PORTFOLIOS),
        "name_product_type": code(6, rules.PRODUCT_TYPES),
        "name_seller_industry": code(8, rules.SELLERS),
        "name_yield_group": code(9, rules.YIELD_GROUPS),
    }


def _installments(dialect: str) -> dict[str, str]:
    day = days_between(dialect, "l_shipdate", ANCHOR)
    due = money("l_extendedprice")
    paid = f"case when l_quantity <= 5 then cast({due} * 0.9 as decimal(18,4)) else {due} end"
    unpaid = "l_partkey % 50 = 0"
    return {
        "sk_id_prev": "l_orderkey",
        "sk_id_curr": "o_custkey",
        "num_instalment_version": "cast(l_suppkey % 3 + 1 as string) || '.0'",
        "num_instalment_number": "l_linenumber",
        "days_instalment": day,
        "days_entry_payment": f"case when {unpaid} then null "
        f"else {day} + (o_custkey % 7) * (l_partkey % 20) - 10 end",
        "amt_instalment": due,
        "amt_payment": f"case when {unpaid} then null else {paid} end",
    }


def _bureau(dialect: str) -> dict[str, str]:
    k = "o_orderkey"
    day = days_between(dialect, "o_orderdate", ANCHOR)
    price = money("o_totalprice")
    return {
        "sk_id_curr": "o_custkey",
        "sk_id_bureau": k,
        "days_credit": day,
        "credit_day_overdue": f"case when {k} % 701 = 0 then 3000 else {k} % 90 end",
        "days_credit_enddate": f"case when {k} % 9 = 0 then null else cast({day} + 900 as string) || '.0' end",
        "days_enddate_fact": f"case when {k} % 2 = 0 then null else cast({day} + 700 as string) || '.0' end",
        "cnt_credit_prolong": f"{k} % 3",
        "days_credit_update": f"{day} + 30",
        "amt_credit_max_overdue": f"case when {k} % 4 = 0 then null else {k} % 5000 end",
        "amt_credit_sum": price,
        "amt_credit_sum_debt": f"{price} - 50000",
        "amt_credit_sum_limit": f"case when {k} % 3 = 0 then null else {k} % 20000 - 100 end",
        "amt_credit_sum_overdue": f"case when {k} % 20 = 0 then {k} % 700 else 0 end",
        "amt_annuity": f"case when {k} % 5 = 0 then null else {k} % 9000 end",
        "credit_active": "case substr(o_orderpriority, 1, 1) when '1' then 'Bad debt' "
        "when '4' then 'Closed' when '5' then 'Sold' else 'Active' end",
        "credit_currency": _pick(k, rules.CURRENCIES),
        "credit_type": _pick(k, rules.CREDIT_TYPES),
    }


def _pos() -> dict[str, str]:
    return {
        "sk_id_prev": "l_orderkey",
        "sk_id_curr": "o_custkey",
        "months_balance": "snapshot_month",
        "cnt_instalment": "cast(6 + l_orderkey % 30 as string) || '.0'",
        "cnt_instalment_future": "cast(l_orderkey % 30 as string) || '.0'",
        "sk_dpd": "worst_part % 33",
        "sk_dpd_def": "cast(floor((worst_part % 33) / 2) as bigint)",
        "name_contract_status": "case when l_orderkey % 500 = 0 then 'XNA' "
        "else case worst_flag when 'A' then 'Active' when 'R' then 'Completed' else 'Signed' end end",
    }


def _cards() -> dict[str, str]:
    spend = "total_value"
    return {
        "sk_id_prev": "user_id",
        "sk_id_curr": "user_id",
        "months_balance": "card_period",
        "cnt_drawings_atm_current": "n_purchases",
        "cnt_drawings_current": "n_events",
        "cnt_drawings_other_current": "0",
        "cnt_drawings_pos_current": "n_events - n_purchases",
        "cnt_instalment_mature_cum": "case when user_id % 6 = 0 then null else 30 + card_period end",
        "sk_dpd": "n_errors",
        "sk_dpd_def": "case when n_errors > 1 then n_errors - 1 else 0 end",
        "amt_balance": f"{spend} - 50",
        "amt_credit_limit_actual": "case when user_id % 11 = 0 then 0 else 500 end",
        "amt_drawings_atm_current": f"case when user_id % 90 = 0 then -1 else {spend} end",
        "amt_drawings_current": spend,
        "amt_drawings_other_current": "0",
        "amt_drawings_pos_current": spend,
        "amt_inst_min_regularity": "25",
        "amt_payment_current": spend,
        "amt_payment_total_current": spend,
        "amt_receivable_principal": f"{spend} - 40",
        "amt_recivable": spend,
        "amt_total_receivable": spend,
        "name_contract_status": "case when user_id % 17 = 0 then 'Demand' "
        "when n_errors > 0 then 'Active' else 'Signed' end",
    }


def _bureau_balance() -> dict[str, str]:
    return {
        "sk_id_bureau": "user_id",
        "months_balance": "card_period",
        "status": "case last_type when 'click' then '0' when 'error' then '1' "
        "when 'purchase' then '2' when 'signup' then 'C' else 'X' end",
    }


def _select(columns: dict[str, str], source: str, source_file: str, loaded_at: str) -> str:
    texts = ", ".join(f"cast({expr} as string) as {name}" for name, expr in columns.items())
    return f"select {texts}, {loaded_at} as _loaded_at, '{source_file}' as _source_file from {source}"


def raw_sql(dialect: str) -> dict[str, str]:
    """SQL of each RAW table over views named like the test tables."""
    # Sums before joins: rows of one order or one user are combined where they are read.
    months = months_from_anchor("l_shipdate")
    snapshots = (
        f"(select l_orderkey, {months} as snapshot_month, max(l_partkey % 33) as worst_part, "
        f"max(l_returnflag) as worst_flag from lineitem group by l_orderkey, {months}) as s "
        "join orders on l_orderkey = o_orderkey"
    )
    period = days_between(dialect, "ts", CARD_ANCHOR)
    daily = (
        f"(select user_id, {period} as card_period, sum({money('value')}) as total_value, "
        "count(*) as n_events, max(event_type) as last_type, "
        "sum(case when event_type = 'error' then 1 else 0 end) as n_errors, "
        "sum(case when event_type = 'purchase' then 1 else 0 end) as n_purchases "
        f"from events group by user_id, {period}) as d"
    )
    is_test = "c_custkey % 6 = 5"
    payment_load = f"case when l_partkey % 10 = 0 then {LATE_LOAD} else {EARLY_LOAD} end"
    return {
        "application_train": _select(
            _application(True), f"customer where not ({is_test})", "application_train.csv", EARLY_LOAD
        ),
        "application_test": _select(
            _application(False), f"customer where {is_test}", "application_test.csv", EARLY_LOAD
        ),
        "previous_application": _select(
            _previous_application(dialect),
            "orders where o_orderkey % 10 <> 0",
            "previous_application.csv",
            EARLY_LOAD,
        ),
        "installments_payments": _select(
            _installments(dialect),
            "lineitem join orders on l_orderkey = o_orderkey",
            "installments_payments.csv",
            payment_load,
        ),
        "pos_cash_balance": _select(_pos(), snapshots, "POS_CASH_balance.csv", EARLY_LOAD),
        "credit_card_balance": _select(_cards(), daily, "credit_card_balance.csv", EARLY_LOAD),
        "bureau": _select(_bureau(dialect), "orders", "bureau.csv", EARLY_LOAD),
        "bureau_balance": _select(_bureau_balance(), daily, "bureau_balance.csv", EARLY_LOAD),
    }


# Test tables each RAW table is derived from.
DERIVED_FROM = {
    "application_train": ("customer",),
    "application_test": ("customer",),
    "previous_application": ("orders",),
    "installments_payments": ("lineitem", "orders"),
    "pos_cash_balance": ("lineitem", "orders"),
    "credit_card_balance": ("events",),
    "bureau": ("orders",),
    "bureau_balance": ("events",),
}


# Text as careless sources deliver it, over every order.
MESSY = """
select o_orderkey, case o_orderkey % 20
    when 0 then cast(o_orderkey as string)
    when 1 then cast(o_orderkey as string) || '.0'
    when 2 then ' ' || cast(o_orderkey as string) || ' '
    when 3 then 'abc'
    when 4 then ''
    when 5 then null
    when 6 then cast(o_orderkey as string) || '.5'
    when 7 then '1.5e' || cast(o_orderkey % 7 as string)
    when 8 then '365243.0'
    when 9 then ' XNA '
    when 10 then 'XAP'
    when 11 then 'Y'
    when 12 then 'N'
    when 13 then '   '
    when 14 then cast(o_orderkey as string) || 'd'
    when 15 then '-' || cast(o_orderkey as string) || '.123456'
    when 16 then '0x1p3'
    when 17 then cast(o_orderkey % 2 as string)
    when 18 then 'inf'
    else ' y ' end as messy
from orders
"""
