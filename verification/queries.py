"""One registered query per operator, over the generic test tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.functions import ordered, pairs, risk, typing
from lendscope.operators import (
    monthly,
    profiling,
    quality,
    sampling,
    scd2,
    segments,
    staging,
    status_history,
    upsert,
)
from lendscope.plans import business_checks as chk
from lendscope.plans import marts, reports, rules
from lendscope.sources import catalog, raw_load, readers, scratch, store
from lendscope.sources.registry import TABLES
from verification import mapping
from verification.frames import Frames

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
#: The same queries over frames that are already there.
BUILDERS: dict[str, Callable[[Frames], DataFrame]] = {}

LOAD_TS = datetime.datetime(2024, 3, 1, 6, 0, 0)
NOW = datetime.datetime(2024, 1, 5)
SAMPLE_CLIENTS, SAMPLE_TEST_CLIENTS, SEED = 300, 60, 42


def register(name: str, build: Callable[[Frames], DataFrame]) -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} is registered twice")
    BUILDERS[name] = build
    REGISTRY[name] = lambda spark, sf_dir: build(Frames(spark, sf_dir))


def query(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    register(build.__name__, build)
    return build


def union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def money(column: str):
    return F.col(column).cast("decimal(18,4)")


# ---------------------------------------------------------------- models

for _table in TABLES:
    register(f"stg_{_table.name}", lambda f, name=_table.name: f.stg(name))

register("int_installment_schedule", lambda f: f.schedule)
register("int_loan_payment_performance", lambda f: f.performance)
register("int_pos_cash_loan", lambda f: f.pos_loans)
register("int_credit_card_loan", lambda f: f.cards)
register("int_bureau_client", lambda f: f.bureau_clients)
register("int_client_credit_history", lambda f: f.history)
register("int_loan_status_as_of", lambda f: monthly.status_as_of(f.pos, -1))
register("dim_client", lambda f: f.dim_client)
register("fct_loans", lambda f: f.fct_loans)
register("fct_installments", lambda f: f.fct_installments)
register("mart_credit_risk", lambda f: f.segments)
register("mart_vintage_curves", lambda f: f.vintage)

# ---------------------------------------------------------------- sources and sinks


def source_columns(raw: DataFrame) -> DataFrame:
    """The table as its file had it, before the audit columns."""
    return raw.drop("_loaded_at", "_source_file")


@query
def src_csv_text(f: Frames) -> DataFrame:
    path = scratch.scratch_folder(f.spark, "csv")
    as_file = source_columns(f.raw("application_test")).write.option("header", True)
    as_file.option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return readers.read_csv_text(f.spark, path)


@query
def src_parquet(f: Frames) -> DataFrame:
    return readers.read_parquet(f.spark, f"{f.sf_dir}/orders.parquet")


@query
def src_digest(f: Frames) -> DataFrame:
    return raw_load.digests({t.name: source_columns(f.raw(t.name)) for t in TABLES})


@query
def load_skip_decision(f: Frames) -> DataFrame:
    names = (
        "bureau",
        "bureau_balance",
        "credit_card_balance",
        "previous_application",
        "pos_cash_balance",
    )
    found = raw_load.digests({name: source_columns(f.raw(name)) for name in names})
    name = F.col("table_name")
    ledger = found.where(name != "bureau").withColumn(
        "digest", F.when(name == "bureau_balance", "other").otherwise(F.col("digest"))
    )
    counts = found.where(name != "credit_card_balance").select(
        "table_name",
        F.when(name == "previous_application", F.col("row_count") - 1)
        .otherwise(F.col("row_count"))
        .alias("raw_rows"),
    )
    return raw_load.skip_decision(found, ledger, counts)


@query
def load_raw_full(f: Frames) -> DataFrame:
    root = scratch.scratch_folder(f.spark, "raw")
    raw_load.load_raw(source_columns(f.raw("bureau")), "bureau", "bureau.csv", LOAD_TS, root)
    return store.read_current(f.spark, root, "bureau")


@query
def load_atomic_publish(f: Frames) -> DataFrame:
    root = scratch.scratch_folder(f.spark, "publish")
    store.publish(f.cards.withColumn("load_no", F.lit(1)), root, "cards")
    run = catalog.Run(f.spark, root)
    run.publish("cards", run.read("cards").withColumn("load_no", F.lit(2)))
    run.publish("clients", f.dim_client)
    overtaken = catalog.Run(f.spark, root)
    run.commit()
    overtaken.publish("cards", overtaken.read("cards").withColumn("load_no", F.lit(3)))
    try:
        overtaken.commit()
    except catalog.OvertakenError:
        return store.read_current(f.spark, root, "cards")
    raise AssertionError("a run that was overtaken became current")


@query
def load_reconcile(f: Frames) -> DataFrame:
    root = scratch.scratch_folder(f.spark, "reconcile")
    parts = []
    for name in ("bureau_balance", "credit_card_balance"):
        loaded = store.publish(f.raw(name), root, name)
        rows = f.raw(name).agg(F.count("*").alias("source_rows"))
        parts.append(
            rows.select(
                F.lit(name).alias("table_name"),
                "source_rows",
                F.lit(loaded).cast("bigint").alias("loaded_rows"),
                (F.col("source_rows") == loaded).alias("reconciled"),
            )
        )
    return union(parts)


def _ledger(f: Frames, names: list[str], loaded_at: str) -> DataFrame:
    def entry(name: str) -> DataFrame:
        return f.raw(name).agg(
            F.count("*").alias("row_count"), F.max("_source_file").alias("source_file")
        ).select(F.lit(name).alias("table_name"), "source_file", "row_count")

    return union(entry(n) for n in names).withColumn(
        "loaded_at", F.lit(loaded_at).cast("timestamp")
    )


@query
def load_ledger_upsert(f: Frames) -> DataFrame:
    before = _ledger(f, [t.name for t in TABLES[:6]], "2024-01-01 00:00:00")
    rows = _ledger(f, ["bureau", "pos_cash_balance"], "2024-01-02 00:00:00")
    return raw_load.ledger_upsert(before, rows)


@query
def sink_parquet_sorted(f: Frames) -> DataFrame:
    path = scratch.scratch_folder(f.spark, "sorted")
    readers.write_sorted(source_columns(f.raw("bureau_balance")), path)
    return readers.read_parquet(f.spark, path)


@query
def src_freshness(f: Frames) -> DataFrame:
    return raw_load.freshness(f.raw("installments_payments"), NOW)


# ---------------------------------------------------------------- typing rules


def _messy(f: Frames) -> DataFrame:
    f.source("orders").createOrReplaceTempView("orders")
    return f.spark.sql(mapping.MESSY)


for _name, _rule in {
    "to_double": typing.to_double,
    "to_decimal": typing.to_decimal,
    "to_bigint": typing.to_bigint,
    "to_bool_01": typing.to_bool_01,
    "to_bool_yn": typing.to_bool_yn,
    "clean_text": typing.clean_text,
    "null_if_xna": typing.null_if_code,
    "is_xna": typing.is_code,
    "null_if_sentinel": typing.null_if_sentinel,
    "is_sentinel": typing.is_sentinel,
}.items():
    register(_name, lambda f, rule=_rule: _messy(f).select("o_orderkey", rule("messy").alias("v")))

register(
    "surrogate_key",
    lambda f: _messy(f).select("o_orderkey", typing.surrogate_key("messy", "o_orderkey").alias("v")),
)
register("rename_audit", lambda f: staging.rename_audit(f.raw("bureau_balance")))


@query
def derive_columns(f: Frames) -> DataFrame:
    price = money("l_extendedprice")
    return f.source("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (price - 100).alias("reduced"),
        (F.col("l_linenumber") + 1).cast("bigint").alias("next_number"),
        (price > 50000).alias("is_large"),
        F.lit("payment").alias("kind"),
    )


# ---------------------------------------------------------------- filters

register("filter_compare", lambda f: f.pos.where(F.col("months_balance") <= -12))
register(
    "filter_bool",
    lambda f: f.pos_loans.where((F.col("max_mob") > 2) & ~F.col("is_left_censored")),
)
register("filter_null", lambda f: f.schedule.where(F.col("dpd").isNull()).select("installment_id"))


@query
def filter_rank_top1(f: Frames) -> DataFrame:
    """Cheapest order of each customer, ties by key, as an aggregate instead of a rank."""
    # Price and key in one decimal of fixed width, so the aggregate hashes and never sorts.
    cents, keys = money("o_totalprice") * 10_000, F.lit("10000000000000000000").cast("decimal(20,0)")
    both = cents.cast("decimal(18,0)") * keys + F.col("o_orderkey").cast("decimal(19,0)")
    best = F.min(both.cast("decimal(38,0)"))
    return (
        f.source("orders")
        .groupBy("o_custkey")
        .agg(best.alias("best"), F.min(money("o_totalprice")).alias("price"))
        .select("o_custkey", "price", F.pmod("best", keys).cast("bigint").alias("o_orderkey"))
    )


register(
    "filter_having",
    lambda f: f.source("orders")
    .groupBy("o_custkey")
    .agg(F.count("*").alias("n_orders"))
    .where(F.col("n_orders") > 10),
)


@query
def filter_scalar_subquery(f: Frames) -> DataFrame:
    customers = f.source("customer")
    return customers.where(
        F.col("c_acctbal") > customers.agg(F.max("c_acctbal")).scalar() - 100
    ).select("c_custkey", "c_acctbal")


@query
def filter_tolerance(f: Frames) -> DataFrame:
    gap = F.abs(F.col("amt_paid") - F.col("amt_due"))
    return f.schedule.where(gap > F.lit("0.01").cast("decimal(3,2)")).select(
        "installment_id", "amt_due", "amt_paid"
    )


register(
    "filter_cross_column",
    lambda f: f.bureau.where(F.col("credit_day_overdue") <= -F.col("days_credit")).select(
        "sk_id_bureau"
    ),
)

# ---------------------------------------------------------------- joins


@query
def join_inner_equi(f: Frames) -> DataFrame:
    late = f.schedule.where("dpd > 0").select("sk_id_prev", "num_instalment_number", "dpd")
    versions = f.payments.groupBy("sk_id_prev", "num_instalment_number").agg(
        F.count("*").alias("n_rows")
    )
    return late.join(versions, ["sk_id_prev", "num_instalment_number"])


register(
    "join_left_equi",
    lambda f: f.previous.select("sk_id_prev").join(
        f.performance.select("sk_id_prev", "max_dpd"), "sk_id_prev", "left"
    ),
)


@query
def join_left_chain(f: Frames) -> DataFrame:
    """Spine and one-row-per-key aggregates; every side is partitioned by the same key."""
    orders = f.source("orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    counts = orders.agg(F.count("*").alias("n_orders"))
    paid = f.payments.groupBy(F.col("sk_id_curr").alias("c_custkey")).agg(
        risk.money_sum(F.col("amt_payment")).alias("paid")
    )
    worst = f.schedule.groupBy(F.col("sk_id_curr").alias("c_custkey")).agg(
        F.max("dpd").alias("max_dpd")
    )
    spine = f.source("customer").select("c_custkey")
    return (
        spine.join(counts, "c_custkey", "left")
        .join(paid, "c_custkey", "left")
        .join(worst, "c_custkey", "left")
    )


register(
    "join_existence",
    lambda f: f.performance.join(f.train.select("sk_id_curr"), "sk_id_curr", "left_semi").select(
        "sk_id_prev", "sk_id_curr"
    ),
)


@query
def join_semi_in(f: Frames) -> DataFrame:
    big = f.source("orders").where(money("o_totalprice") > 300000).select("o_custkey")
    customers = f.source("customer").select("c_custkey", "c_name")
    return customers.join(big, customers.c_custkey == big.o_custkey, "left_semi")


@query
def join_anti_null(f: Frames) -> DataFrame:
    return quality.orphan_keys(f.payments, "sk_id_prev", f.previous, "sk_id_prev")


@query
def join_flag_presence(f: Frames) -> DataFrame:
    seen = f.pos_loans.select("sk_id_prev", F.lit(True).alias("mark"))
    return f.previous.join(seen, "sk_id_prev", "left").select(
        "sk_id_prev", F.col("mark").isNotNull().alias("has_pos_history")
    )


@query
def join_agg_back(f: Frames) -> DataFrame:
    """Day of the worst delay of each client, the latest on ties, without a self-join."""
    worst = F.max(pairs.pack(F.col("dpd"), F.col("due_day")))
    late = f.schedule.where(F.col("dpd").isNotNull()).groupBy("sk_id_curr")
    return late.agg(worst.alias("w")).select(
        "sk_id_curr",
        pairs.unpack_first(F.col("w")).alias("max_dpd"),
        pairs.unpack_second(F.col("w")).alias("worst_due_day"),
    )


@query
def join_range(f: Frames) -> DataFrame:
    """Loans observable at each month on book: steps and a running sum, no range join."""
    steps = f.pos_loans.where("max_mob is not null").select(
        F.inline(
            F.expr(
                "array(named_struct('mob', 0L, 'n', 1L), named_struct('mob', max_mob + 1, 'n', -1L))"
            )
        )
    )
    per_month = steps.groupBy("mob").agg(F.sum("n").alias("n")).where(F.col("mob") < 96)
    # At most 96 rows are left; one task runs over them.
    over = Window.partitionBy(F.lit(0)).orderBy("mob")
    running = per_month.select(
        "mob",
        F.sum("n").over(over).alias("n_loans"),
        F.coalesce(F.lead("mob").over(over), F.lit(96).cast("bigint")).alias("next_mob"),
    )
    months = F.sequence("mob", F.col("next_mob") - 1)
    return running.select(F.explode(months).alias("months_on_book"), "n_loans").where("n_loans > 0")


@query
def join_cross_scalar(f: Frames) -> DataFrame:
    totals = f.performance.agg(F.sum("n_installments").alias("in_loans"))
    in_schedule = f.schedule.agg(F.count("*")).scalar()
    return totals.select("in_loans", in_schedule.alias("in_schedule"))


@query
def join_filtered_on(f: Frames) -> DataFrame:
    train = f.dim_client.where(F.col("client_source") == "train").select("sk_id_curr", "age_band")
    return f.performance.select("sk_id_prev", "sk_id_curr").join(train, "sk_id_curr", "left")


# ---------------------------------------------------------------- aggregations


register(
    "agg_group",
    lambda f: f.payments.groupBy(
        "sk_id_prev", "num_instalment_number", "num_instalment_version"
    ).agg(F.count("*").alias("n"), F.max("days_instalment").alias("due_day")),
)
register(
    "agg_global",
    lambda f: f.schedule.agg(
        F.count("*").alias("n"), risk.money_sum(F.col("amt_due")).alias("amt_due")
    ),
)


def _per_loan(name: str, *aggregates) -> None:
    register(name, lambda f: f.payments.groupBy("sk_id_prev").agg(*(a() for a in aggregates)))


_per_loan("agg_count_star", lambda: F.count("*").alias("n"))
_per_loan("agg_count_col", lambda: F.count("amt_payment").alias("n"))
_per_loan("agg_sum", lambda: risk.money_sum(F.col("amt_payment")).alias("v"))
_per_loan("agg_min", lambda: F.min("days_entry_payment").alias("v"))
_per_loan("agg_max", lambda: F.max("days_entry_payment").alias("v"))
_per_loan("agg_avg", lambda: F.avg("days_entry_payment").alias("v"))
_per_loan(
    "agg_conditional_count", lambda: F.count_if(F.col("days_entry_payment").isNull()).alias("v")
)
_per_loan(
    "agg_conditional_minmax",
    lambda: F.max(F.when(F.col("days_instalment") >= -365, F.col("days_entry_payment"))).alias("v"),
)
_per_loan("agg_any_key", lambda: F.max("sk_id_curr").alias("sk_id_curr"))


@query
def agg_conditional_sum(f: Frames) -> DataFrame:
    debt = F.col("amt_credit_sum_debt")
    positive = F.when(debt > 0, debt).otherwise(F.lit(0).cast("decimal(18,4)"))
    return f.bureau.groupBy("sk_id_curr").agg(risk.money_sum(positive).alias("debt"))


@query
def agg_two_level(f: Frames) -> DataFrame:
    versions = f.payments.groupBy(
        "sk_id_prev", "num_instalment_number", "num_instalment_version"
    ).agg(F.max("amt_instalment").alias("amt"))
    return versions.groupBy("sk_id_prev", "num_instalment_number").agg(
        F.count("*").alias("n_versions"), risk.money_sum(F.col("amt")).alias("amt_due")
    )


register(
    "agg_ratio",
    lambda f: f.source("customer")
    .groupBy("c_mktsegment")
    .agg((F.count_if(F.col("c_acctbal") < 0).cast("double") / F.count("*")).alias("rate")),
)
register(
    "agg_group_by_position",
    lambda f: f.source("orders")
    .groupBy("o_orderpriority")
    .agg(F.count("*").alias("n"))
    .orderBy("o_orderpriority"),
)

# ---------------------------------------------------------------- windows


@query
def win_latest_row(f: Frames) -> DataFrame:
    """Latest month's row per loan: an aggregate, so long loans never gather in a window, and over
    one number, so that it hashes."""
    texts = ordered.dictionary_of(f.pos, "name_contract_status")
    if texts is None:
        latest = F.max(F.struct("months_balance", "sk_dpd", "name_contract_status"))
        return f.pos.groupBy("sk_id_prev").agg(latest.alias("r")).select("sk_id_prev", "r.*")
    bits = [20, 32, ordered.TEXT_BITS]
    columns = [F.col("months_balance"), F.col("sk_dpd"), texts.place(F.col("name_contract_status"))]
    number = F.max(ordered.packed(*zip(columns, bits, strict=True))).alias("r")
    month, dpd, place = ordered.unpacked(F.col("r"), bits)
    return f.pos.groupBy("sk_id_prev").agg(number).select(
        "sk_id_prev",
        month.alias("months_balance"),
        dpd.alias("sk_dpd"),
        texts.text(place).alias("name_contract_status"),
    )


def _months(f: Frames) -> DataFrame:
    """Every monthly row."""
    return f.pos.select("sk_id_prev", "months_balance", "name_contract_status", "sk_dpd")


def _by_month(months: DataFrame) -> segments.Segments:
    """Months of a loan in order; rows that repeat a month by their other columns. A loan may
    hold any share of the rows."""
    return segments.Segments(months, ["sk_id_prev"], ["months_balance", "name_contract_status", "sk_dpd"])


@query
def win_rank_in_side(f: Frames) -> DataFrame:
    return rank_in_side(_months(f))


def rank_in_side(months: DataFrame) -> DataFrame:
    sided = months.withColumn("side", F.when(F.col("months_balance") <= -40, 0).otherwise(1))
    order = [F.desc("months_balance"), F.asc("name_contract_status"), F.asc("sk_dpd")]
    ranked = segments.Segments(sided, ["sk_id_prev", "side"], order).row_number("rank_in_side")
    return ranked.select(
        "sk_id_prev", "months_balance", F.col("rank_in_side").cast("bigint").alias("rank_in_side")
    )


def previous_status(months: DataFrame) -> DataFrame:
    return (
        _by_month(months)
        .lag("previous_status", F.col("name_contract_status"))
        .select("sk_id_prev", "months_balance", "previous_status")
    )


def next_month(months: DataFrame) -> DataFrame:
    return (
        _by_month(months)
        .lead("next_month", F.col("months_balance"))
        .select("sk_id_prev", "months_balance", "next_month")
    )


register("win_lag", lambda f: previous_status(_months(f)))
register("win_lead", lambda f: next_month(_months(f)))


@query
def win_share(f: Frames) -> DataFrame:
    counts = f.source("customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("*").alias("n")
    )
    of_segment = F.sum("n").over(Window.partitionBy("c_mktsegment"))
    return counts.select(
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
        "c_mktsegment",
        (F.col("n").cast("double") / of_segment).alias("share"),
    )


@query
def win_runs(f: Frames) -> DataFrame:
    return status_runs(_months(f))


def status_runs(months: DataFrame) -> DataFrame:
    """Runs of equal status per loan."""
    status = F.coalesce("name_contract_status", F.lit("(null)"))
    months = _by_month(months.withColumn("status", status)).lag("before", F.col("status"))
    starts = F.col("before").isNull() | (F.col("before") != F.col("status"))
    return months.groupBy("sk_id_prev").agg(F.count_if(starts).alias("n_runs"))


# ---------------------------------------------------------------- sorts, sets, generators


def _ids(f: Frames, table: str) -> DataFrame:
    return f.raw(table).select("sk_id_curr")


register("topk_hash_sample", lambda f: sampling.hash_sample(_ids(f, "application_train"), 100, 7))
register("sort_all", lambda f: f.source("nation").orderBy(*f.source("nation").columns))


@query
def sort_case(f: Frames) -> DataFrame:
    counts = f.schedule.groupBy("dpd_bucket").agg(F.count("*").alias("n"))
    bucket = F.col("dpd_bucket")
    return counts.where(bucket.isNotNull()).orderBy(
        F.when(bucket == "0", 0).when(bucket == "90+", 9).otherwise(5), bucket
    )


register(
    "union_all",
    lambda f: f.train.select("sk_id_curr").unionByName(f.test.select("sk_id_curr")),
)


@query
def union_tagged(f: Frames) -> DataFrame:
    train = f.train.select(F.lit("train").alias("client_source"), "sk_id_curr", "target")
    test = f.test.select(F.lit("test").alias("client_source"), "sk_id_curr")
    return train.unionByName(test, allowMissingColumns=True)


@query
def unpivot_dimensions(f: Frames) -> DataFrame:
    columns = ["code_gender", "name_contract_type", "region_rating_client"]
    labels = [F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in columns]
    long = f.train.select("sk_id_curr", *labels)
    return long.unpivot("sk_id_curr", columns, "dimension", "dimension_value")


@query
def series_spine(f: Frames) -> DataFrame:
    """Every month on book for every last status of the data."""
    statuses = f.pos_loans.where("last_status is not null").groupBy("last_status").agg(
        F.max("max_mob").alias("longest")
    )
    months = F.sequence(F.lit(0).cast("bigint"), F.lit(95).cast("bigint"))
    return statuses.select("last_status", F.explode(months).alias("months_on_book"))


# ---------------------------------------------------------------- scalar functions


def _scalar(name: str, source: str, key: str, build: Callable) -> None:
    register(name, lambda f: f.source(source).select(key, build().alias("v")))


_scalar(
    "coalesce",
    "orders",
    "o_orderkey",
    lambda: F.coalesce(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("none")),
)
_scalar(
    "nullif", "orders", "o_orderkey", lambda: F.nullif(F.col("o_orderstatus"), F.lit("F"))
)
_scalar(
    "case_searched",
    "orders",
    "o_orderkey",
    lambda: F.when(money("o_totalprice") < 100000, "low")
    .when(money("o_totalprice") < 300000, "mid")
    .otherwise("high"),
)
_scalar(
    "case_simple",
    "orders",
    "o_orderkey",
    lambda: F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False),
)
register(
    "greatest",
    lambda f: f.schedule.select(
        "installment_id",
        F.when(
            F.col("days_past_due_raw").isNotNull(), F.greatest("days_past_due_raw", F.lit(0))
        ).alias("v"),
    ),
)
_scalar(
    "floor", "customer", "c_custkey", lambda: F.floor(F.col("c_acctbal") / F.lit(30.4375)).cast("bigint")
)
_scalar("round", "customer", "c_custkey", lambda: F.round(F.col("c_acctbal"), 0).cast("bigint"))
_scalar("abs", "customer", "c_custkey", lambda: F.abs(money("c_acctbal")))
_scalar("sqrt", "customer", "c_custkey", lambda: F.sqrt(F.abs(F.col("c_acctbal"))))
_scalar(
    "lpad", "customer", "c_custkey", lambda: F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
)
register("trim", lambda f: _messy(f).select("o_orderkey", F.trim("messy").alias("v")))
_scalar(
    "concat",
    "customer",
    "c_custkey",
    lambda: F.concat(F.col("c_name"), F.lit("-"), F.col("c_mktsegment")),
)
_scalar("md5", "customer", "c_custkey", lambda: F.md5(F.col("c_name")))
_scalar("sha256", "customer", "c_custkey", lambda: F.sha2(F.col("c_name"), 256))
_scalar("cast", "customer", "c_custkey", lambda: money("c_acctbal").cast("string"))
register(
    "try_cast",
    lambda f: _messy(f).select("o_orderkey", F.col("messy").try_cast("decimal(18,4)").alias("v")),
)
register(
    "current_timestamp",
    lambda f: raw_load.with_audit(source_columns(f.raw("bureau_balance")), "b.csv", LOAD_TS).select(
        "sk_id_bureau", "months_balance", "_loaded_at"
    ),
)


def _order_day():
    return F.datediff(F.col("o_orderdate").cast("date"), F.lit(mapping.ANCHOR).cast("date"))


_scalar("dpd_bucket", "orders", "o_orderkey", lambda: risk.dpd_bucket(F.col("o_orderkey") % 130 - 10))
_scalar("months_before", "orders", "o_orderkey", lambda: risk.months_before(_order_day()))
_scalar("cohort_block", "orders", "o_orderkey", lambda: risk.cohort_block(F.col("o_orderkey") % 120))
register(
    "age_years", lambda f: f.train.select("sk_id_curr", risk.age_in_years(F.col("days_birth")).alias("v"))
)
register(
    "age_band", lambda f: f.train.select("sk_id_curr", risk.age_band(F.col("days_birth")).alias("v"))
)
register(
    "income_band",
    lambda f: f.train.select("sk_id_curr", risk.income_band(F.col("amt_income_total")).alias("v")),
)


@query
def wilson_interval(f: Frames) -> DataFrame:
    per_nation = f.source("customer").groupBy("c_nationkey").agg(
        F.count_if(F.col("c_acctbal") < 0).alias("k"), F.count("*").alias("n")
    )
    low, high = risk.wilson_interval(F.col("k"), F.col("n"))
    return per_nation.select(
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
        "k",
        "n",
        low.alias("low"),
        high.alias("high"),
    )


# ---------------------------------------------------------------- incremental and history


LATE = "2024-01-02 00:00:00"


def _installment_tables(f: Frames) -> tuple[upsert.ScheduleTables, DataFrame]:
    """States, schedule and fact as they stood before the late payments, and those payments."""
    late = F.col("loaded_at") >= F.lit(LATE).cast("timestamp")
    run = catalog.Run(f.spark, scratch.scratch_folder(f.spark, "installments"))
    tables = upsert.ScheduleTables(run, buckets=16)
    tables.build(f.payments.where(~late))
    tables.build_fact(lambda rows: marts.fct_installments(rows, f.train, f.previous))
    run.commit()
    return tables, f.payments.where(late)


@query
def incremental_delta(f: Frames) -> DataFrame:
    """The fact rows that late payments change, from stored states: no early payment is read."""
    tables, late = _installment_tables(f)
    return marts.fct_installments(tables.add(late).delta, f.train, f.previous)


@query
def incremental_merge(f: Frames) -> DataFrame:
    """Late payments merged into states, schedule and fact, in the buckets they touch; the
    result is the full rebuild."""
    tables, late = _installment_tables(f)
    tables.merge_fact(lambda rows: marts.fct_installments(rows, f.train, f.previous), tables.add(late))
    tables.run.commit()
    return store.read_current(f.spark, tables.run.root, tables.FACT)


LOADS = (-36, -24, -12, -1)


def _history(f: Frames) -> status_history.StatusHistory:
    run = catalog.Run(f.spark, scratch.scratch_folder(f.spark, "status"))
    return status_history.StatusHistory(run, "snp_loan_status")


def _loaded(f: Frames, months) -> DataFrame:
    history = _history(f)
    for month in months:
        history.apply(monthly.status_as_of(f.status_months, month))
    return history.read()


register("scd2_apply", lambda f: _loaded(f, LOADS))
register(
    "scd2_ids",
    lambda f: _loaded(f, (-24, -1)).select("sk_id_prev", *scd2.VERSION_COLUMNS),
)
register("scd2_backfill", lambda f: f.status_history)


@query
def scd2_replay(f: Frames) -> DataFrame:
    """Several loads in one batch, applied twice: what they leave one by one."""
    batch = union(monthly.status_as_of(f.status_months, month) for month in LOADS)
    history = _history(f)
    for _ in range(2):
        history.apply(batch)
    return history.read()


register("scd2_rerun_idempotent", lambda f: _loaded(f, (-24, -1, -1)))

# ---------------------------------------------------------------- sample


def _sample(f: Frames, n_test: int) -> dict[str, DataFrame]:
    raw = {t.name: source_columns(f.raw(t.name)) for t in TABLES}
    train, test = sampling.sample_clients(
        raw["application_train"], raw["application_test"], SAMPLE_CLIENTS, n_test, SEED
    )
    # The selection runs once; every table reads what it chose.
    ids = [scratch.written(chosen, "sample-ids") for chosen in (train, test)]
    return sampling.sample_closure(raw, *ids)


@query
def sample_clients(f: Frames) -> DataFrame:
    train, test = sampling.sample_clients(
        _ids(f, "application_train"),
        _ids(f, "application_test"),
        SAMPLE_CLIENTS,
        SAMPLE_TEST_CLIENTS,
        SEED,
    )
    return train.withColumn("client_source", F.lit("train")).unionByName(
        test.withColumn("client_source", F.lit("test"))
    )


@query
def sample_closure(f: Frames) -> DataFrame:
    """Key of every sampled row, by table."""
    sample = _sample(f, SAMPLE_TEST_CLIENTS)

    def keys(name: str) -> DataFrame:
        key = "sk_id_bureau" if name == "bureau_balance" else "sk_id_curr"
        return sample[name].select(F.lit(name).alias("table_name"), F.col(key).alias("key"))

    return union(keys(name) for name in sample)


register(
    "sink_manifest",
    lambda f: sampling.sample_manifest(_sample(f, SAMPLE_TEST_CLIENTS), SEED).select(
        "*", "row_counts.*"
    ).drop("row_counts"),
)


@query
def sample_stable(f: Frames) -> DataFrame:
    """Adding test clients leaves the selection of labelled clients as it was."""
    alone = sampling.sample_manifest(_sample(f, 0), SEED)
    both = sampling.sample_manifest(_sample(f, SAMPLE_TEST_CLIENTS), SEED)
    digest = both.select("client_ids_sha256").scalar()
    return alone.select(
        "client_ids_sha256", (F.col("client_ids_sha256") == digest).alias("unchanged")
    )


# ---------------------------------------------------------------- checks


STAGING_CHECKS = rules.CHECKS[rules.STAGING]
MART_CHECKS = rules.CHECKS[rules.MARTS]


def _kind(kind: str, checks, composite: bool | None = None) -> list[quality.Check]:
    return [
        c for c in checks if c.kind == kind and (composite is None or (len(c.columns) > 1) is composite)
    ]


QUALITY_SETS = {
    "dq_not_null": _kind(quality.NOT_NULL, STAGING_CHECKS),
    "dq_unique": _kind(quality.UNIQUE, STAGING_CHECKS, composite=False),
    "dq_unique_combination": _kind(quality.UNIQUE, STAGING_CHECKS, composite=True),
    "dq_accepted_values": _kind(quality.ACCEPTED, STAGING_CHECKS),
    "dq_between": _kind(quality.BETWEEN, STAGING_CHECKS),
    "dq_relationships": _kind(quality.RELATIONSHIP, STAGING_CHECKS),
    "dq_expression": _kind(quality.EXPRESSION, MART_CHECKS),
    "dq_suite": [c for c in STAGING_CHECKS if c.table == "stg_previous_application"],
    "dq_severity": [c for c in STAGING_CHECKS if c.table == "stg_application_train"],
    "dq_suite_history": rules.CHECKS[rules.HISTORY],
    "dq_suite_marts": MART_CHECKS,
    "dq_suite_snapshot": rules.CHECKS[rules.SNAPSHOT],
}


MART_TABLES = {"fct_loans", "fct_installments", "mart_credit_risk"}


def _quality(f: Frames, name: str) -> DataFrame:
    checks = QUALITY_SETS[name]
    needed = {c.table for c in checks} | {c.parent[0] for c in checks if c.parent}
    if MART_TABLES & needed:
        f.publish("schedule", "pos_measures")
    tables = f.tables(needed)
    results = quality.run_checks(tables, checks)
    return quality.blocking(results) if name == "dq_severity" else results


for _name in QUALITY_SETS:
    register(_name, lambda f, name=_name: _quality(f, name))

# Rules the mapped data keeps are shown on inputs with a planted defect; the defects are
# stated again in the oracle.
def _doubled():
    return F.col("sk_id_curr") % 50 == 0


def _lost():
    return F.col("sk_id_prev") % 40 == 0



register(
    "chk_train_test_disjoint",
    lambda f: chk.train_test_disjoint(f.train, f.test.unionByName(
        f.train.where(_doubled()), allowMissingColumns=True).select("sk_id_curr")),
)
register("chk_bureau_overdue_age", lambda f: chk.bureau_overdue_age(f.bureau))
register(
    "chk_client_keys",
    lambda f: chk.client_keys(
        f.train.where(~_doubled()), f.test, f.bureau, f.previous
    ),
)


@query
def chk_unpaid_flag(f: Frames) -> DataFrame:
    f.publish("schedule", "history", "dim_client")
    return chk.unpaid_flag(
        f.fct_installments.where(~_lost()),
        f.history,
        f.dim_client,
        f.segments.withColumn("n_clients", F.col("n_clients") + 1),
    )


@query
def chk_dpd_possible(f: Frames) -> DataFrame:
    lowered = F.when(F.col("sk_id_prev") % 30 == 0, -1).otherwise(F.col("sk_dpd"))
    overdue = F.when(F.col("sk_id_bureau") % 30 == 0, -1).otherwise(F.col("credit_day_overdue"))
    return chk.dpd_possible(
        f.pos.withColumn("sk_dpd", lowered),
        f.card_balances,
        f.bureau.withColumn("credit_day_overdue", overdue),
    )


@query
def chk_fct_vs_schedule(f: Frames) -> DataFrame:
    f.publish("schedule")
    return chk.fct_vs_schedule(f.schedule, f.train, f.fct_installments.where(~_lost()))


register(
    "chk_fct_loans_cover",
    lambda f: chk.fct_loans_cover(
        f.previous, f.train, f.fct_loans.where(F.col("sk_id_prev") % 7 != 0), f.fct_installments
    ),
)
register(
    "chk_payment_before_decision",
    lambda f: chk.payment_before_decision(f.payments, f.previous),
)
register("chk_schedule_amounts", lambda f: chk.schedule_amounts(f.schedule))
register(
    "chk_mart_partition",
    lambda f: chk.mart_partition(
        f.segments.where(~F.col("dimension_value").isin("M", "Working", "unpaid")), f.dim_client
    ),
)
register("chk_negative_bureau", lambda f: chk.negative_bureau(f.bureau))
register("chk_negative_card", lambda f: chk.negative_card(f.card_balances))
register(
    "chk_scd2_one_current",
    lambda f: chk.scd2_one_current(
        f.status_history.where(~(_lost() & F.col(scd2.VALID_TO).isNull()))
    ),
)
register(
    "chk_scd2_no_overlap",
    lambda f: chk.scd2_no_overlap(
        f.status_history.withColumn(
            scd2.VALID_TO, F.when(_lost(), F.col(scd2.VALID_TO) + 1).otherwise(F.col(scd2.VALID_TO))
        )
    ),
)


@query
def chk_scd2_transitions(f: Frames) -> DataFrame:
    f.publish("status_history")
    return chk.scd2_transitions(
        f.status_months, f.status_history.where(~(_lost() & F.col(scd2.VALID_TO).isNull()))
    )


register(
    "chk_vintage_monotone",
    lambda f: chk.vintage_monotone(
        f.vintage.withColumn(
            "n_loans_observable",
            F.when(F.col("months_on_book") % 5 == 0, F.col("n_loans_observable") + 3).otherwise(
                F.col("n_loans_observable")
            ),
        )
    ),
)


@query
def verify_layers(f: Frames) -> DataFrame:
    f.publish("pos", "schedule", "pos_measures", "dim_client", "fct_loans")
    published = {
        "fct_loans": f.fct_loans.where(F.col("sk_id_prev") < 0),
        "fct_installments": f.fct_installments,
        "dim_client": f.dim_client,
        "mart_credit_risk": f.segments.where(F.col("dimension_value") != "M"),
        "mart_vintage_curves": f.vintage,
    }
    return chk.verify_layers(
        f.raw("application_train"), f.train.where(~_doubled()), published, f.status_history
    )


# ---------------------------------------------------------------- profiling

register(
    "prof_cast_failures",
    lambda f: union(profiling.cast_failures(f.raw(t.name), t.name) for t in TABLES),
)
register(
    "prof_flag_domain",
    lambda f: union(
        profiling.flag_domain(f.raw(name), name)
        for name in ("application_train", "application_test", "previous_application")
    ),
)
register(
    "prof_orphans",
    lambda f: profiling.orphan_profile(
        f.train,
        f.test,
        f.bureau,
        f.stg("bureau_balance"),
        f.previous,
        f.payments,
        f.pos,
        f.card_balances,
    ),
)


@query
def prof_sentinels(f: Frames) -> DataFrame:
    overlap = profiling.placeholder_overlap(f.train).select(
        F.lit("application_train").alias("table_name"),
        F.lit("days_employed and organization_type").alias("column_name"),
        F.col("n_both").alias("n_flagged"),
    )
    tables = ("application_train", "application_test", "previous_application", "pos_cash_balance")
    return union([*(profiling.placeholders(f.stg(n), n) for n in tables), overlap])


# ---------------------------------------------------------------- reports

register("rpt_global_rate", lambda f: reports.global_rate(f.segments))
register("rpt_unpaid_vs_average", lambda f: reports.unpaid_vs_average(f.segments))
register("rpt_unpaid_segments", lambda f: reports.unpaid_segments(f.segments))
register(
    "rpt_worst_dpd_recency", lambda f: reports.worst_dpd_recency(f.fct_installments, f.dim_client)
)
register("rpt_recency_matrix", lambda f: reports.recency_matrix(f.fct_installments, f.dim_client))
register("rpt_rate_by_bucket", lambda f: reports.rate_by_bucket(f.segments))
register("rpt_rate_by_tenure", lambda f: reports.rate_by_tenure(f.segments))
register("rpt_exposure_by_income", lambda f: reports.exposure_by_income(f.segments))


@query
def rpt_worst_dpd_ci(f: Frames) -> DataFrame:
    worst = f.history.select("sk_id_curr", "bureau_active_debt", "worst_dpd_bucket")
    labelled = f.dim_client.where(F.col("client_source") == "train").select(
        "sk_id_curr", "is_default", "amt_credit"
    )
    return reports.worst_dpd_ci(labelled.join(worst, "sk_id_curr"))
