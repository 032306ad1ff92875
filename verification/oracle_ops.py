"""DuckDB statements of the operators, checks and reports (models are in `oracle`)."""

from __future__ import annotations

from lendscope.operators import quality
from lendscope.operators.sampling import SELECTION
from lendscope.operators.staging import FLAGS
from lendscope.sources import registry
from lendscope.sources.registry import TABLES, TABLES_BY_NAME
from verification import mapping
from verification.oracle import (
    age_band,
    bucket,
    cohort,
    flag,
    fragment,
    hashed,
    income_band,
    months_before,
    total,
    typed,
    wilson,
)
from verification.queries import (
    LOADS,
    QUALITY_SETS,
    SAMPLE_CLIENTS,
    SAMPLE_TEST_CLIENTS,
    SEED,
)

BACKFILL = tuple(range(-24, 0))


def columns_of(table: str, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in TABLES_BY_NAME[table].columns)


# ---------------------------------------------------------------- sources and sinks

fragment("src_csv_text", f"select {columns_of('application_test')} from @raw_application_test")
fragment("src_parquet", "select * from orders")


def digest(table: str) -> str:
    cells = " || ',' || ".join(
        f"coalesce(length({c}) || ':' || {c}, 'null')" for c in TABLES_BY_NAME[table].columns
    )

    def lane(first: int) -> str:
        return f"cast(coalesce(sum(cast('0x' || substr(h, {first}, 15) as bigint)), 0) as varchar)"

    return (
        f"select '{table}' as table_name, count(*) as row_count, "
        f"md5(count(*) || '-' || {lane(1)} || '-' || {lane(16)}) as digest "
        f"from (select md5({cells}) as h from @raw_{table})"
    )


fragment("src_digest", " union all ".join(digest(t.name) for t in TABLES))
fragment(
    "load_skip_decision",
    """
select 'bureau' as table_name, false as skip, 'no previous load on record' as reason
union all select 'bureau_balance', false, 'source file changed'
union all select 'credit_card_balance', false, 'RAW table is missing or empty'
union all select 'previous_application', false,
    'RAW has ' || (count(*) - 1) || ' rows, audit recorded ' || count(*)
    from @raw_previous_application
union all select 'pos_cash_balance', true, 'unchanged'
""",
)
fragment(
    "load_raw_full",
    f"select {columns_of('bureau')}, timestamp '2024-03-01 06:00:00' as _loaded_at, "
    "'bureau.csv' as _source_file from @raw_bureau",
)
fragment("load_atomic_publish", "select *, 2 as load_no from @int_credit_card_loan")
fragment(
    "load_reconcile",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as source_rows, count(*) as loaded_rows, "
        f"true as reconciled from @raw_{t}"
        for t in ("bureau_balance", "credit_card_balance")
    ),
)
_late = ("bureau", "pos_cash_balance")
fragment(
    "load_ledger_upsert",
    " union all ".join(
        f"select '{t}' as table_name, max(_source_file) as source_file, count(*) as row_count, "
        f"timestamp '2024-01-0{2 if t in _late else 1} 00:00:00' as loaded_at from @raw_{t}"
        for t in [*(t.name for t in TABLES[:6]), "pos_cash_balance"]
    ),
)
fragment("sink_parquet_sorted", f"select {columns_of('bureau_balance')} from @raw_bureau_balance")
fragment(
    "src_freshness",
    """
select max(_loaded_at) as max_loaded_at,
    case when timestamp '2024-01-05' - max(_loaded_at) > interval 7 days then 'error'
         when timestamp '2024-01-05' - max(_loaded_at) > interval 2 days then 'warn'
         else 'pass' end as status
from @raw_installments_payments
""",
)

# ---------------------------------------------------------------- typing rules

fragment("messy", mapping.MESSY)
for _name, _kind in {
    "to_double": registry.DOUBLE,
    "to_decimal": registry.MONEY,
    "to_bigint": registry.BIGINT,
    "to_bool_01": registry.FLAG_01,
    "to_bool_yn": registry.FLAG_YN,
    "clean_text": registry.TEXT,
    "null_if_xna": registry.CODE,
    "null_if_sentinel": registry.DAY_OR_SENTINEL,
}.items():
    fragment(_name, f"select o_orderkey, {typed(_kind, 'messy')} as v from @messy")
for _name, _kind in {
    "is_xna": registry.CODE,
    "is_sentinel": registry.DAY_OR_SENTINEL,
}.items():
    _expr = flag(_kind, "messy").rsplit(" as ", 1)[0]
    fragment(_name, f"select o_orderkey, {_expr} as v from @messy")
fragment("surrogate_key", f"select o_orderkey, {hashed('messy', 'o_orderkey')} as v from @messy")
fragment(
    "rename_audit",
    "select sk_id_bureau, months_balance, status, _loaded_at as loaded_at, "
    "_source_file as source_file from @raw_bureau_balance",
)
fragment(
    "derive_columns",
    """
select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(18,4)) - 100 as reduced,
    cast(l_linenumber + 1 as bigint) as next_number,
    cast(l_extendedprice as decimal(18,4)) > 50000 as is_large, 'payment' as kind
from lineitem
""",
)

# ---------------------------------------------------------------- filters and joins

fragment("filter_compare", "select * from @stg_pos_cash_balance where months_balance <= -12")
fragment(
    "filter_bool", "select * from @int_pos_cash_loan where max_mob > 2 and not is_left_censored"
)
fragment(
    "filter_null", "select installment_id from @int_installment_schedule where dpd is null"
)
fragment(
    "filter_rank_top1",
    """
select o_custkey, cast(o_totalprice as decimal(18,4)) as price, o_orderkey from orders
qualify row_number() over (partition by o_custkey order by o_totalprice, o_orderkey) = 1
""",
)
fragment(
    "filter_having",
    "select o_custkey, count(*) as n_orders from orders group by 1 having count(*) > 10",
)
fragment(
    "filter_scalar_subquery",
    "select c_custkey, c_acctbal from customer "
    "where c_acctbal > (select max(c_acctbal) from customer) - 100",
)
fragment(
    "filter_tolerance",
    "select installment_id, amt_due, amt_paid from @int_installment_schedule "
    "where abs(amt_due - amt_paid) > 0.01",
)
fragment(
    "filter_cross_column",
    "select sk_id_bureau from @stg_bureau where days_credit + credit_day_overdue <= 0",
)
fragment(
    "join_inner_equi",
    """
select s.sk_id_prev, s.num_instalment_number, s.dpd, count(*) as n_rows
from @int_installment_schedule as s join @stg_installments_payments as p
    on p.sk_id_prev = s.sk_id_prev and p.num_instalment_number = s.num_instalment_number
where s.dpd > 0 group by 1, 2, 3
""",
)
fragment(
    "join_left_equi",
    "select a.sk_id_prev, max_dpd from @stg_previous_application as a "
    "left join @int_loan_payment_performance as p on p.sk_id_prev = a.sk_id_prev",
)
fragment(
    "join_left_chain",
    """
select c_custkey,
    (select nullif(count(*), 0) from orders where o_custkey = c_custkey) as n_orders,
    paid, max_dpd
from customer
left join (select sk_id_curr as c_custkey, cast(sum(amt_payment) as decimal(38,4)) as paid
    from @stg_installments_payments group by 1) using (c_custkey)
left join (select sk_id_curr as c_custkey, max(dpd) as max_dpd
    from @int_installment_schedule group by 1) using (c_custkey)
""",
)
fragment(
    "join_existence",
    "select sk_id_prev, sk_id_curr from @int_loan_payment_performance "
    "where sk_id_curr in (select sk_id_curr from @stg_application_train)",
)
fragment(
    "join_semi_in",
    "select c_custkey, c_name from customer where c_custkey in "
    "(select o_custkey from orders where o_totalprice > 300000)",
)
fragment(
    "join_anti_null",
    "select sk_id_prev as key, count(*) as n_rows from @stg_installments_payments "
    "where sk_id_prev not in (select sk_id_prev from @stg_previous_application) group by 1",
)
fragment(
    "join_flag_presence",
    "select sk_id_prev, sk_id_prev in (select sk_id_prev from @int_pos_cash_loan) "
    "as has_pos_history from @stg_previous_application",
)
fragment(
    "join_agg_back",
    """
select sk_id_curr, dpd as max_dpd, max(due_day) as worst_due_day
from (select *, rank() over (partition by sk_id_curr order by dpd desc) as r
      from @int_installment_schedule where dpd is not null)
where r = 1 group by 1, 2
""",
)
fragment(
    "join_range",
    "select m.range as months_on_book, count(*) as n_loans from range(96) as m "
    "join @int_pos_cash_loan on max_mob >= m.range group by 1",
)
fragment(
    "join_cross_scalar",
    "select (select cast(sum(n_installments) as bigint) from @int_loan_payment_performance) "
    "as in_loans, (select count(*) from @int_installment_schedule) as in_schedule",
)
fragment(
    "join_filtered_on",
    "select sk_id_prev, p.sk_id_curr, age_band from @int_loan_payment_performance as p "
    "left join @dim_client as c on c.sk_id_curr = p.sk_id_curr and client_source = 'train'",
)

# ---------------------------------------------------------------- aggregations

fragment(
    "agg_group",
    "select sk_id_prev, num_instalment_number, num_instalment_version, count(*) as n, "
    "max(days_instalment) as due_day from @stg_installments_payments group by 1, 2, 3",
)
fragment(
    "agg_global",
    f"select count(*) as n, {total('amt_due')} as amt_due from @int_installment_schedule",
)
for _name, _expr in {
    "agg_count_star": "count(*) as n",
    "agg_count_col": "count(amt_payment) as n",
    "agg_sum": f"{total('amt_payment')} as v",
    "agg_min": "min(days_entry_payment) as v",
    "agg_max": "max(days_entry_payment) as v",
    "agg_avg": "avg(days_entry_payment) as v",
    "agg_conditional_count": "count(*) - count(days_entry_payment) as v",
    "agg_conditional_minmax": "max(days_entry_payment) filter (days_instalment >= -365) as v",
    "agg_any_key": "max(sk_id_curr) as sk_id_curr",
}.items():
    fragment(
        _name, f"select sk_id_prev, {_expr} from @stg_installments_payments group by sk_id_prev"
    )
fragment(
    "agg_conditional_sum",
    f"select sk_id_curr, {total('greatest(coalesce(amt_credit_sum_debt, 0), 0)')} as debt "
    "from @stg_bureau group by 1",
)
fragment(
    "agg_two_level",
    "select sk_id_prev, num_instalment_number, n_versions, amt_due from @int_installment_schedule",
)
fragment(
    "agg_ratio",
    "select c_mktsegment, cast(count(*) filter (c_acctbal < 0) as double) / count(*) as rate "
    "from customer group by 1",
)
fragment(
    "agg_group_by_position",
    "select o_orderpriority, count(*) as n from orders group by 1 order by 1",
)

# ---------------------------------------------------------------- windows

fragment(
    "win_latest_row",
    "select sk_id_prev, months_balance, sk_dpd, name_contract_status from @stg_pos_cash_balance "
    "qualify row_number() over (partition by sk_id_prev order by months_balance desc) = 1",
)
fragment(
    "win_rank_in_side",
    "select sk_id_prev, months_balance, row_number() over (partition by sk_id_prev, "
    "months_balance <= -40 order by months_balance desc) as rank_in_side "
    "from @stg_pos_cash_balance",
)
fragment(
    "win_lag",
    "select sk_id_prev, months_balance, lag(name_contract_status) over (partition by sk_id_prev "
    "order by months_balance) as previous_status from @stg_pos_cash_balance",
)
fragment(
    "win_lead",
    "select sk_id_prev, months_balance, lead(months_balance) over (partition by sk_id_prev "
    "order by months_balance) as next_month from @stg_pos_cash_balance",
)
fragment(
    "win_share",
    "select cast(c_nationkey as bigint) as c_nationkey, c_mktsegment, cast(count(*) as double) / "
    "cast(sum(count(*)) over (partition by c_mktsegment) as double) as share "
    "from customer group by 1, 2",
)
fragment(
    "win_runs",
    """
select sk_id_prev, count(*) filter (before is null or before <> status) as n_runs
from (select sk_id_prev, status,
          lag(status) over (partition by sk_id_prev order by months_balance) as before
      from (select *, coalesce(name_contract_status, '(null)') as status
            from @stg_pos_cash_balance))
group by 1
""",
)

# ---------------------------------------------------------------- sorts, sets, generators


def hash_sample(table: str, n: int, seed: int) -> str:
    return (
        f"(select sk_id_curr from @raw_{table} "
        f"order by md5('{seed}:' || sk_id_curr), sk_id_curr limit {n})"
    )


fragment("topk_hash_sample", f"select * from {hash_sample('application_train', 100, 7)}")
fragment("sort_all", "select * from nation order by all")
fragment(
    "sort_case",
    "select dpd_bucket, count(*) as n from @int_installment_schedule "
    "where dpd_bucket is not null group by 1",
)
fragment(
    "union_all",
    "select sk_id_curr from @stg_application_train "
    "union all select sk_id_curr from @stg_application_test",
)
fragment(
    "union_tagged",
    "select 'train' as client_source, sk_id_curr, target from @stg_application_train "
    "union all select 'test', sk_id_curr, null from @stg_application_test",
)
fragment(
    "unpivot_dimensions",
    """
unpivot (select sk_id_curr, coalesce(code_gender, 'unknown') as code_gender,
    coalesce(name_contract_type, 'unknown') as name_contract_type,
    coalesce(cast(region_rating_client as varchar), 'unknown') as region_rating_client
    from @stg_application_train)
on code_gender, name_contract_type, region_rating_client
into name dimension value dimension_value
""",
)
fragment(
    "series_spine",
    "select last_status, m.range as months_on_book from (select distinct last_status "
    "from @int_pos_cash_loan where last_status is not null), range(96) as m",
)

# ---------------------------------------------------------------- scalar functions

_day = mapping.days_between(mapping.DUCKDB, "o_orderdate", mapping.ANCHOR)
for _name, (_source, _key, _expr) in {
    "coalesce": (
        "orders",
        "o_orderkey",
        "case when o_orderpriority = '5-LOW' then 'none' else o_orderpriority end",
    ),
    "nullif": ("orders", "o_orderkey", "nullif(o_orderstatus, 'F')"),
    "case_searched": (
        "orders",
        "o_orderkey",
        "case when o_totalprice < 100000 then 'low' when o_totalprice < 300000 then 'mid' "
        "else 'high' end",
    ),
    "case_simple": (
        "orders",
        "o_orderkey",
        "case o_orderstatus when 'O' then true when 'F' then false end",
    ),
    "floor": (
        "customer",
        "c_custkey",
        "cast(floor(c_acctbal / cast(30.4375 as double)) as bigint)",
    ),
    "round": ("customer", "c_custkey", "cast(round(c_acctbal, 0) as bigint)"),
    "abs": ("customer", "c_custkey", "abs(cast(c_acctbal as decimal(18,4)))"),
    "sqrt": ("customer", "c_custkey", "sqrt(abs(c_acctbal))"),
    "lpad": ("customer", "c_custkey", "lpad(cast(c_nationkey as varchar), 2, '0')"),
    "concat": ("customer", "c_custkey", "c_name || '-' || c_mktsegment"),
    "md5": ("customer", "c_custkey", "md5(c_name)"),
    "sha256": ("customer", "c_custkey", "sha256(c_name)"),
    "cast": ("customer", "c_custkey", "cast(cast(c_acctbal as decimal(18,4)) as varchar)"),
    "dpd_bucket": ("orders", "o_orderkey", bucket("(o_orderkey % 130 - 10)")),
    "months_before": ("orders", "o_orderkey", months_before(_day)),
    "cohort_block": ("orders", "o_orderkey", cohort("(o_orderkey % 120)")),
    "age_years": (
        "@stg_application_train",
        "sk_id_curr",
        "cast(floor(cast(-days_birth as double) / cast(365.25 as double)) as bigint)",
    ),
    "age_band": ("@stg_application_train", "sk_id_curr", age_band("days_birth")),
    "income_band": ("@stg_application_train", "sk_id_curr", income_band("amt_income_total")),
    "greatest": (
        "@int_installment_schedule",
        "installment_id",
        "case when days_past_due_raw > 0 then days_past_due_raw else days_past_due_raw * 0 end",
    ),
    "trim": ("@messy", "o_orderkey", "trim(messy)"),
    "try_cast": ("@messy", "o_orderkey", "try_cast(messy as decimal(18,4))"),
}.items():
    fragment(_name, f"select {_key}, {_expr} as v from {_source}")
fragment(
    "current_timestamp",
    "select sk_id_bureau, months_balance, timestamp '2024-03-01 06:00:00' as _loaded_at "
    "from @raw_bureau_balance",
)
fragment(
    "wilson_interval",
    f"""
select c_nationkey, k, n, {wilson('k', 'n', '-')} as low, {wilson('k', 'n', '+')} as high
from (select cast(c_nationkey as bigint) as c_nationkey,
          count(*) filter (c_acctbal < 0) as k, count(*) as n from customer group by 1)
""",
)

# ---------------------------------------------------------------- incremental and history

fragment(
    "incremental_delta",
    "select * from @fct_installments where loaded_at > timestamp '2024-01-01 00:00:00'",
)
fragment("incremental_merge", "select * from @fct_installments")


def versions_at(loads) -> str:
    """Versions a series of loads leaves: status seen at each load, then its changes."""
    months = ", ".join(f"({m})" for m in loads)
    return f"""
select sk_id_prev, sk_id_curr, name_contract_status, observed_month, as_of_month,
    md5(sk_id_prev || '|' || as_of_month) as dbt_scd_id, as_of_month as dbt_updated_at,
    as_of_month as dbt_valid_from,
    lead(as_of_month) over (partition by sk_id_prev order by as_of_month) as dbt_valid_to
from (
    select *, row_number() over w as load_no, lag(name_contract_status) over w as before
    from (
        select sk_id_prev, sk_id_curr, name_contract_status, months_balance as observed_month,
            cast(load_month as bigint) as as_of_month
        from @stg_pos_cash_balance
        join (values {months}) as loads(load_month) on months_balance <= load_month
        qualify months_balance = max(months_balance) over (partition by sk_id_prev, load_month)
    )
    window w as (partition by sk_id_prev order by as_of_month)
)
where load_no = 1 or before is distinct from name_contract_status
"""


fragment("scd2_apply", versions_at(LOADS))
fragment("scd2_replay", versions_at(LOADS))
fragment("scd2_ids_full", versions_at((-24, -1)))
fragment(
    "scd2_ids",
    "select sk_id_prev, dbt_scd_id, dbt_updated_at, dbt_valid_from, dbt_valid_to "
    "from @scd2_ids_full",
)
fragment("scd2_backfill", versions_at(BACKFILL))
fragment("scd2_rerun_idempotent", "select * from @scd2_ids_full")

# ---------------------------------------------------------------- sample

fragment("sample_train", f"select * from {hash_sample('application_train', SAMPLE_CLIENTS, SEED)}")
fragment(
    "sample_test", f"select * from {hash_sample('application_test', SAMPLE_TEST_CLIENTS, SEED)}"
)
fragment(
    "sample_clients",
    "select sk_id_curr, 'train' as client_source from @sample_train "
    "union all select sk_id_curr, 'test' from @sample_test",
)
fragment("sample_bureau", "select sk_id_bureau from @raw_bureau semi join @sample_clients using (sk_id_curr)")


def sampled(table: str) -> str:
    if table == "bureau_balance":
        return "@raw_bureau_balance semi join @sample_bureau using (sk_id_bureau)"
    ids = {"application_train": "sample_train", "application_test": "sample_test"}
    return f"@raw_{table} semi join @{ids.get(table, 'sample_clients')} using (sk_id_curr)"


fragment(
    "sample_closure",
    " union all ".join(
        f"select '{t.name}' as table_name, "
        f"{'sk_id_bureau' if t.name == 'bureau_balance' else 'sk_id_curr'} as key "
        f"from {sampled(t.name)}"
        for t in TABLES
    ),
)


def id_digest(ids: str) -> str:
    return f"(select sha256(string_agg(sk_id_curr, ',' order by sk_id_curr)) from @{ids})"


_counts = ", ".join(f"(select count(*) from {sampled(t.name)}) as {t.name}" for t in TABLES)
fragment(
    "sink_manifest",
    f"""
select cast({SEED} as bigint) as seed, (select count(*) from @sample_train) as n_clients,
    '{SELECTION.replace("'", "''")}' as selection, {id_digest('sample_train')} as client_ids_sha256,
    (select count(*) from @sample_test) as n_test_clients,
    {id_digest('sample_test')} as test_client_ids_sha256,
    (select round(cast(cast(count(*) filter (target = '1') as double) / count(*)
        as decimal(18,10)), 6) from {sampled('application_train')}) as default_rate,
    {_counts}
""",
)
fragment(
    "sample_stable",
    f"select {id_digest('sample_train')} as client_ids_sha256, true as unchanged",
)

# ---------------------------------------------------------------- declared checks


def check_failures(check: quality.Check) -> str:
    """SQL that yields one row per failure of a check."""
    table = {"snp_loan_status": "scd2_backfill"}.get(check.table, check.table)
    source = f"@{table}"
    column = check.columns[0] if check.columns else None
    if check.kind == quality.NOT_NULL:
        return f"select 1 from {source} where {column} is null"
    if check.kind == quality.UNIQUE:
        keys = ", ".join(check.columns)
        present = f"where {column} is not null" if len(check.columns) == 1 else ""
        return f"select 1 from {source} {present} group by {keys} having count(*) > 1"
    if check.kind == quality.ACCEPTED:
        values = ", ".join("'" + v.replace("'", "''") + "'" for v in check.allowed)
        return f"select distinct {column} from {source} where {column} not in ({values})"
    if check.kind == quality.BETWEEN:
        bounds = []
        if check.low is not None:
            bounds.append(f"{column} < {check.low}")
        if check.high is not None:
            bounds.append(f"{column} > {check.high}")
        return f"select 1 from {source} where {' or '.join(bounds)}"
    if check.kind == quality.EXPRESSION:
        return f"select 1 from {source} where not ({check.predicate})"
    parent, parent_column = check.parent
    only = f"and {check.only_where}" if check.only_where else ""
    return (
        f"select 1 from {source} where {column} is not null {only} and {column} not in "
        f"(select {parent_column} from @{parent} where {parent_column} is not null)"
    )


def suite(checks) -> str:
    lines = []
    for check in checks:
        status = "fail" if check.severity == quality.ERROR else "warn"
        name = check.name.replace("'", "''")
        lines.append(
            f"select '{name}' as check_name, '{check.table}' as table_name, "
            f"'{check.kind}' as kind, '{check.severity}' as severity, count(*) as failures, "
            f"case count(*) when 0 then 'pass' else '{status}' end as status "
            f"from ({check_failures(check)})"
        )
    return " union all ".join(lines)


for _name, _checks in QUALITY_SETS.items():
    _suite = suite(_checks)
    fragment(
        _name,
        f"select * from ({_suite}) where status = 'fail'" if _name == "dq_severity" else _suite,
    )

# ---------------------------------------------------------------- business checks

_TRAIN = "(select sk_id_curr from @stg_application_train)"
_KNOWN = (
    "(select sk_id_curr from @stg_application_train where sk_id_curr % 50 <> 0 "
    "union all select sk_id_curr from @stg_application_test)"
)
fragment(
    "chk_train_test_disjoint",
    "select sk_id_curr from @stg_application_train where sk_id_curr % 50 = 0",
)
fragment(
    "chk_bureau_overdue_age",
    "select sk_id_bureau, credit_day_overdue, days_credit from @stg_bureau "
    "where -days_credit < credit_day_overdue",
)
fragment(
    "chk_client_keys",
    f"select 'bureau' as source_table, sk_id_curr from @stg_bureau where sk_id_curr not in {_KNOWN} "
    "union all select 'previous_application', sk_id_curr from @stg_previous_application "
    f"where sk_id_curr not in {_KNOWN}",
)
fragment(
    "chk_unpaid_flag",
    f"""
select sk_id_curr, cast(null as bigint) as in_mart, cast(null as bigint) as in_history
from @int_client_credit_history as h
where sk_id_curr in {_TRAIN} and n_unpaid_installments <> (
    select count(*) from @fct_installments as i
    where i.sk_id_curr = h.sk_id_curr and is_unpaid and sk_id_prev % 40 <> 0)
union all
select null, count(*) + 1, count(*) from @int_client_credit_history
where sk_id_curr in {_TRAIN} and has_unpaid_installment
""",
)
fragment(
    "chk_dpd_possible",
    """
select 'pos_cash_balance' as source_table, sk_id_prev as entity_id, months_balance
from @stg_pos_cash_balance where sk_id_prev % 30 = 0 or sk_dpd_def > sk_dpd
union all
select 'credit_card_balance', sk_id_prev, months_balance from @stg_credit_card_balance
where sk_dpd < 0 or sk_dpd_def < 0 or sk_dpd - sk_dpd_def < 0
union all
select 'bureau', sk_id_bureau, null from @stg_bureau where sk_id_bureau % 30 = 0
""",
)
fragment(
    "chk_fct_vs_schedule",
    """
select count(*) as expected_installments,
    count(*) filter (sk_id_prev % 40 <> 0) as actual_installments
from @fct_installments having count(*) filter (sk_id_prev % 40 = 0) > 0
""",
)
fragment(
    "chk_fct_loans_cover",
    """
select (select count(*) from @fct_loans) as expected_loans, count(*) as actual_loans,
    cast(sum(n_installments) as bigint) as loan_installments,
    (select count(*) from @fct_installments where has_loan_record) as fact_installments
from @fct_loans where sk_id_prev % 7 <> 0
""",
)
fragment(
    "chk_payment_before_decision",
    "select installment_payment_id, i.sk_id_prev, days_entry_payment, days_decision "
    "from @stg_installments_payments as i join @stg_previous_application as a "
    "on a.sk_id_prev = i.sk_id_prev and a.days_decision > i.days_entry_payment",
)
fragment(
    "chk_schedule_amounts",
    "select installment_id, sk_id_prev, num_instalment_number, amt_due, amt_paid "
    "from @int_installment_schedule where abs(amt_due - amt_paid) > 0.01",
)
fragment(
    "chk_mart_partition",
    """
select * from (
    select dimension, cast(sum(n_clients) as bigint) as n_clients,
        cast(sum(n_defaults) as bigint) as n_defaults,
        cast(sum(exposure_application_credit) as decimal(38,4)) as exposure
    from @mart_credit_risk where dimension_value not in ('M', 'Working', 'unpaid') group by 1
), (
    select count(*) as expected_clients, count(*) filter (is_default) as expected_defaults,
        cast(sum(amt_credit) as decimal(38,4)) as expected_exposure
    from @dim_client where client_source = 'train'
)
where n_clients <> expected_clients
""",
)
fragment(
    "chk_negative_bureau",
    "select sk_id_bureau, amt_credit_sum_debt, amt_credit_sum_limit, amt_credit_sum_overdue "
    "from @stg_bureau where amt_credit_sum_debt < 0 or amt_credit_sum_limit < 0 "
    "or amt_credit_sum_overdue < 0 or amt_credit_max_overdue < 0",
)
fragment(
    "chk_negative_card",
    "select sk_id_prev, months_balance, amt_balance, amt_drawings_current, "
    "amt_drawings_atm_current, amt_receivable_principal from @stg_credit_card_balance where "
    + " or ".join(
        f"{c} < 0"
        for c in (
            "amt_balance",
            "amt_receivable_principal",
            "amt_drawings_current",
            "amt_drawings_atm_current",
            "amt_drawings_pos_current",
            "amt_drawings_other_current",
        )
    ),
)
fragment(
    "chk_scd2_one_current",
    "select distinct sk_id_prev from @scd2_backfill where sk_id_prev % 40 = 0 "
    "and dbt_valid_to is not null",
)
fragment(
    "chk_scd2_no_overlap",
    "select sk_id_prev from @scd2_backfill where sk_id_prev % 40 = 0 and dbt_valid_to is not null",
)
fragment(
    "chk_scd2_transitions",
    """
select sk_id_prev, count(*) as expected_versions,
    nullif(count(*) - 1, 0) as actual_versions
from @scd2_backfill where sk_id_prev % 40 = 0 group by 1
""",
)
fragment(
    "chk_vintage_monotone",
    """
select cohort, months_on_book, n_loans_observable, previous_observable
from (
    select *, lag(n_loans_observable) over (partition by cohort order by months_on_book)
        as previous_observable
    from (select * replace (n_loans_observable + case when months_on_book % 5 = 0 then 3 else 0 end
              as n_loans_observable) from @mart_vintage_curves)
)
where n_loans_observable > previous_observable
    or months_on_book = 0 and n_loans_observable <> n_loans_in_cohort
""",
)
fragment(
    "verify_layers",
    """
select 'no rows in fct_loans' as message
union all select format('{} clients landed, {} are staged', count(*),
    count(*) filter (sk_id_curr % 50 <> 0)) from @stg_application_train
union all select format('{} clients landed, {} stand in mart_credit_risk', count(*),
    count(*) filter (code_gender is distinct from 'M')) from @stg_application_train
""",
)

# ---------------------------------------------------------------- profiling


def per_column(table: str, source: str, conditions: dict[str, str], name: str) -> str:
    return " union all ".join(
        f"select '{table}' as table_name, '{column}' as column_name, "
        f"count(*) filter ({condition}) as {name} from @{source}"
        for column, condition in conditions.items()
    )


def lost(table: str, kinds) -> dict[str, str]:
    conditions = {}
    for column, kind in TABLES_BY_NAME[table].types.items():
        if kind not in kinds:
            continue
        # A placeholder is typed as a plain number here, so it does not count as lost.
        plain = registry.BIGINT if kind == registry.DAY_OR_SENTINEL else kind
        conditions[column] = f"{column} is not null and {typed(plain, column)} is null"
    return conditions


_NUMERIC = (registry.BIGINT, registry.DAY_OR_SENTINEL, registry.MONEY, registry.DOUBLE)
_BOOLEAN = (registry.FLAG_01, registry.FLAG_YN)
fragment(
    "prof_cast_failures",
    " union all ".join(
        per_column(t.name, f"raw_{t.name}", lost(t.name, _NUMERIC + _BOOLEAN), "n_failed")
        for t in TABLES
    ),
)
fragment(
    "prof_flag_domain",
    " union all ".join(
        per_column(t, f"raw_{t}", lost(t, _BOOLEAN), "n_outside")
        for t in ("application_train", "application_test", "previous_application")
    ),
)


def placeholder_columns(table: str) -> dict[str, str]:
    return {
        column: f"is_{column}_{FLAGS[kind][0]}"
        for column, kind in TABLES_BY_NAME[table].types.items()
        if kind in FLAGS
    }


fragment(
    "prof_sentinels",
    " union all ".join(
        per_column(t, f"stg_{t}", placeholder_columns(t), "n_flagged")
        for t in (
            "application_train",
            "application_test",
            "previous_application",
            "pos_cash_balance",
        )
    )
    + " union all select 'application_train', 'days_employed and organization_type', "
    "count(*) filter (is_days_employed_sentinel and is_organization_type_xna) "
    "from @stg_application_train",
)


def orphans(relation: str, child: str, key: str, parent: str, known: str) -> str:
    return (
        f"select '{relation}' as relation, count(*) as orphan_rows, "
        f"count(distinct {key}) as orphan_keys, count(*) filter ({known}) as explained_rows, "
        f"count(*) filter (not ({known})) as unexplained_rows from @stg_{child} "
        f"where {key} not in (select {key} from @stg_{parent})"
    )


_by_test = "sk_id_curr in (select sk_id_curr from @stg_application_test)"
fragment(
    "prof_orphans",
    " union all ".join(
        [
            orphans("bureau -> application", "bureau", "sk_id_curr", "application_train", _by_test),
            orphans(
                "previous_application -> application",
                "previous_application",
                "sk_id_curr",
                "application_train",
                _by_test,
            ),
            *(
                orphans(
                    f"{label} -> previous_application",
                    child,
                    "sk_id_prev",
                    "previous_application",
                    "false",
                )
                for label, child in (
                    ("installments", "installments_payments"),
                    ("pos_cash", "pos_cash_balance"),
                    ("credit_card", "credit_card_balance"),
                )
            ),
            orphans("bureau_balance -> bureau", "bureau_balance", "sk_id_bureau", "bureau", "false"),
        ]
    ),
)

# ---------------------------------------------------------------- reports


def exact(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(28,10)), {digits}) as decimal(28,{digits}))"


def percent(part: str, whole: str) -> str:
    return exact(f"100 * cast({part} as double) / ({whole})", 2)


_bn = "cast({} as double) / cast(1e9 as double)"
fragment(
    "rpt_global_rate",
    f"""
select count(*) as n_clients, count(*) filter (is_default) as n_defaults,
    {percent('count(*) filter (is_default)', 'count(*)')} as default_rate_pct,
    {exact(_bn.format('sum(amt_credit)'), 1)} as exposure_bn
from @risk_universe
""",
)
_unpaid = "n_unpaid_installments > 0"
fragment("risk_clients", "select *, n_unpaid_installments > 0 as owes from @risk_universe_all")
fragment(
    "risk_universe_all",
    "select c.sk_id_curr, is_default, amt_credit, h.* exclude (sk_id_curr) from @dim_client as c "
    "join @int_client_credit_history as h on h.sk_id_curr = c.sk_id_curr "
    "where client_source = 'train'",
)
fragment(
    "rpt_unpaid_vs_average",
    f"""
select count(*) filter (owes) as n_clients,
    {percent('count(*) filter (owes and is_default)', 'count(*) filter (owes)')} as default_rate_pct,
    {exact('(cast(count(*) filter (owes and is_default) as double) / count(*) filter (owes)) / '
           '(cast(count(*) filter (is_default) as double) / count(*))', 1)} as times_average
from @risk_clients
""",
)
fragment(
    "rpt_unpaid_segments",
    " union all ".join(
        f"select '{label}' as segment, cast({i} as bigint) as ord, "
        f"{percent('count(*) filter (is_default)', 'count(*)')} as default_rate_pct "
        f"from @risk_clients {where}"
        for i, (label, where) in enumerate(
            (
                ("All clients", ""),
                ("Without unpaid installments", "where not owes"),
                ("With unpaid installments", "where owes"),
            ),
            start=1,
        )
    ),
)
fragment(
    "worst_delay",
    """
select w.sk_id_curr, w.max_dpd, w.worst_due_day, is_default,
    case when worst_due_day < -730 then '3. more than 24 months ago'
         when worst_due_day < -365 then '2. 12 to 24 months ago'
         else '1. last 12 months' end as recency
from @join_agg_back as w join @dim_client as c
    on c.sk_id_curr = w.sk_id_curr and client_source = 'train'
""",
)
fragment(
    "rpt_worst_dpd_recency",
    f"""
select recency as when_worst_dpd_happened, count(*) as n_clients,
    {percent('count(*) filter (is_default)', 'count(*)')} as default_rate_pct
from @worst_delay where max_dpd > 90 group by 1
""",
)
_pairs = ", ".join(
    f"count(*) filter (recency[1] = '{digit}') as n_{name}, "
    + exact(
        f"100 * cast(count(*) filter (recency[1] = '{digit}' and is_default) as double) / "
        f"nullif(count(*) filter (recency[1] = '{digit}'), 0)",
        2,
    )
    + f" as rate_{name}_pct"
    for digit, name in (("1", "last_12m"), ("2", "m12_to_24"), ("3", "over_24m"))
)
fragment(
    "rpt_recency_matrix",
    f"select {bucket('max_dpd')} as bucket, {_pairs} from @worst_delay group by 1",
)
fragment(
    "rpt_rate_by_bucket",
    f"""
select worst_dpd_bucket as dpd_bucket,
    {percent('count(*) filter (is_default)', 'count(*)')} as default_rate_pct, count(*) as n_clients
from @risk_clients where not owes group by 1
""",
)
fragment(
    "rpt_rate_by_tenure",
    f"""
select tenure_cohort, {percent('count(*) filter (is_default)', 'count(*)')} as default_rate_pct,
    count(*) as n_clients
from @risk_clients group by 1
""",
)
fragment(
    "rpt_exposure_by_income",
    f"""
select income_band, {exact(_bn.format('sum(amt_credit)'), 2)} as exposure_bn,
    {percent('count(*) filter (is_default)', 'count(*)')} as default_rate_pct
from @risk_universe group by 1
""",
)
fragment(
    "rpt_worst_dpd_ci",
    f"""
select worst_dpd_bucket, n_clients, n_defaults,
    cast(n_defaults as double) / n_clients as default_rate,
    {wilson('n_defaults', 'n_clients', '-')} as default_rate_ci_low,
    {wilson('n_defaults', 'n_clients', '+')} as default_rate_ci_high
from (select worst_dpd_bucket, count(*) as n_clients, count(*) filter (is_default) as n_defaults
      from @risk_clients group by 1)
""",
)
