"""The batch job: load, type, summarise, publish, check, verify.

    spark-submit --py-files ... -m lendscope.plans.pipeline <source folder> <warehouse folder> [csv|parquet]

Tables that several later steps read are written as Parquet and read back: that cuts
lineage at a durable place (a lost executor costs its tasks, not the job) and lets every
consumer scan only the columns it needs. Staging stays a projection over RAW.

What a run writes becomes current after its checks, all tables at once. A run that is stopped by
its checks leaves the tables as they were and publishes what the checks found. Of two runs that
began from the same tables the second is refused.
"""

from __future__ import annotations

import datetime
import json
import sys
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.operators import clients, monthly, quality, schedule, scd2
from lendscope.operators.staging import stage
from lendscope.operators.status_history import StatusHistory
from lendscope.operators.upsert import ScheduleTables
from lendscope.plans import business_checks, marts, rules
from lendscope.session import build_session
from lendscope.sources import catalog, raw_load, readers
from lendscope.sources.registry import TABLES

FACT, STATUS = ScheduleTables.FACT, "snp_loan_status"
PAYMENTS = "installments_payments"


class ChecksFailed(RuntimeError):
    """A check of error severity found something."""


class Warehouse:
    """Tables under one folder: as they are current, and as this run has written them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run = catalog.Run(spark, f"{self.root}/tables")
        self.landed = catalog.Run(spark, f"{self.root}/raw")

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        return self.run.publish(name, df)

    def read(self, name: str) -> DataFrame | None:
        return self.run.read(name)

    def raw(self, name: str) -> DataFrame:
        return self.landed.read(name)

    def deliveries(self, name: str) -> dict[str, str]:
        """The folders of a RAW table by label: one, and one for each delivery added to it."""
        return self.landed.entry(name).folders


def staged_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {f"stg_{t.name}": stage(warehouse.raw(t.name), t.name) for t in TABLES}


def refresh_schedule(
    warehouse: Warehouse, payments: DataFrame, full_refresh: bool = False
) -> tuple[DataFrame, catalog.Change | None]:
    """The schedule, and the rows of it that changed if only deliveries were added since the
    last run. The deliveries that went into the states are published with them; a payment table
    that was replaced is taken in anew."""
    tables = ScheduleTables(warehouse.run)
    there = warehouse.deliveries(PAYMENTS)
    note = json.dumps(sorted(there.values()))
    states = warehouse.run.entry(tables.STATES)
    taken = None if states is None or states.note is None else set(json.loads(states.note))
    if full_refresh or taken is None or not taken <= set(there.values()):
        return tables.build(payments, note), None
    new = [label for label, folder in there.items() if folder not in taken]
    moved = None
    if new:
        moved = tables.add(stage(warehouse.landed.read(PAYMENTS, new), PAYMENTS), note)
    return warehouse.read(tables.SCHEDULE), moved


def build_history(
    warehouse: Warehouse, t: Mapping[str, DataFrame], window_start: int = monthly.WINDOW_START
) -> dict[str, DataFrame]:
    """Per-loan and per-client summaries."""
    built = {}
    built["int_loan_payment_performance"] = warehouse.publish(
        "int_loan_payment_performance",
        schedule.loan_performance(t["int_installment_schedule"]),
    )
    built["int_pos_cash_loan"] = warehouse.publish(
        "int_pos_cash_loan",
        monthly.monthly_loan_summary(t["stg_pos_cash_balance"], window_start),
    )
    built["int_credit_card_loan"] = warehouse.publish(
        "int_credit_card_loan", monthly.card_summary(t["stg_credit_card_balance"])
    )
    built["int_bureau_client"] = warehouse.publish(
        "int_bureau_client", clients.bureau_footprint(t["stg_bureau"])
    )
    built["int_client_credit_history"] = warehouse.publish(
        "int_client_credit_history",
        clients.client_history(
            t["stg_application_train"],
            t["stg_application_test"],
            t["int_installment_schedule"],
            t["stg_previous_application"],
            built["int_pos_cash_loan"],
            built["int_credit_card_loan"],
            built["int_bureau_client"],
        ),
    )
    return built


def _refresh_fact(
    warehouse: Warehouse, t: Mapping[str, DataFrame], moved: catalog.Change | None, full_refresh: bool
) -> DataFrame:
    """Merge the installments that changed since the last run, or build all of them."""
    train, previous = t["stg_application_train"], t["stg_previous_application"]
    tables = ScheduleTables(warehouse.run)

    def fact_of(rows: DataFrame) -> DataFrame:
        return marts.fct_installments(rows, train, previous)

    if warehouse.read(FACT) is None or full_refresh:
        return tables.build_fact(fact_of)
    tables.merge_fact(fact_of, moved)
    return warehouse.read(FACT)


def build_marts(
    warehouse: Warehouse,
    t: Mapping[str, DataFrame],
    moved: catalog.Change | None = None,
    full_refresh: bool = False,
) -> dict[str, DataFrame]:
    train, test = t["stg_application_train"], t["stg_application_test"]
    built = {
        "dim_client": warehouse.publish("dim_client", marts.dim_client(train, test)),
        "fct_loans": warehouse.publish(
            "fct_loans",
            marts.fct_loans(
                t["stg_previous_application"],
                train,
                t["int_loan_payment_performance"],
                t["int_pos_cash_loan"],
                t["int_credit_card_loan"],
            ),
        ),
        FACT: _refresh_fact(warehouse, t, moved, full_refresh),
    }
    universe = marts.risk_universe(built["dim_client"], t["int_client_credit_history"])
    built["mart_credit_risk"] = warehouse.publish("mart_credit_risk", marts.segment_risk(universe))
    built["mart_vintage_curves"] = warehouse.publish(
        "mart_vintage_curves", marts.vintage_curves(built["fct_loans"], t["int_pos_cash_loan"])
    )
    return built


def build_status_history(
    warehouse: Warehouse,
    t: Mapping[str, DataFrame],
    start: int = -96,
    end: int = -1,
    full_refresh: bool = False,
) -> DataFrame:
    """The history as it is after the load of month `end`: that load applied to the open versions
    of the published history, or all loads from `start` on where there is none. Rows that
    contradict a month the history has passed go to a table of their own."""
    pos, history = t["stg_pos_cash_balance"], StatusHistory(warehouse.run, STATUS)
    if not history.exists() or full_refresh:
        return history.build(scd2.scd2_backfill(pos, start, end))
    history.apply(monthly.status_as_of(pos, end))
    return history.read()


def business_results(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per business rule, shaped like the declared checks."""
    parts = []
    for name, offending in business_checks.all_business_checks(tables).items():
        severity = business_checks.SEVERITY[name]
        bad = F.col("failures") > 0
        found = offending.agg(F.count("*").alias("failures")).select(
            F.lit(name).alias("check_name"),
            F.lit("business").alias("table_name"),
            F.lit("business").alias("kind"),
            F.lit(severity).alias("severity"),
            "failures",
            F.when(bad, "fail" if severity == quality.ERROR else "warn")
            .otherwise("pass")
            .alias("status"),
        )
        parts.append(found)
    return reduce(DataFrame.unionByName, parts)


def check_layer(warehouse: Warehouse, layer: str, tables: Mapping[str, DataFrame]) -> list[str]:
    """Publish the results of a layer's declared checks; what failed."""
    return _failed(warehouse.publish(f"checks_{layer}", quality.run_checks(tables, rules.CHECKS[layer])))


def _failed(results: DataFrame) -> list[str]:
    # At most one row per declared check.
    return sorted(f"{r.check_name} ({r.failures})" for r in quality.blocking(results).collect())


def _stop_on(warehouse: Warehouse, failed: list[str], stop: bool, what: str = "failed checks") -> None:
    """Publish what the checks found, and nothing else, and stop."""
    if failed and stop:
        warehouse.run.commit(n for n in warehouse.run.changed if n in RESULTS)
        raise ChecksFailed(f"{what}:\n - " + "\n - ".join(failed))


#: Tables that say what a run found, also one that was stopped.
RESULTS = {"source_freshness", "checks_business", f"{STATUS}_refused", *(f"checks_{x}" for x in rules.CHECKS)}


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    load_ts: datetime.datetime,
    *,
    force: bool = False,
    full_refresh: bool = False,
    window_start: int = monthly.WINDOW_START,
    with_history: bool = True,
    stop_on_error: bool = True,
) -> dict[str, DataFrame]:
    """The whole job. Returns the published tables by name.

    All checks run and publish their results always; `stop_on_error` decides whether what
    they find stops the job before its tables become current. The age of the sources is
    reported and stops nothing: a source that does not change is not loaded again.
    """
    raw_load.load_changed(spark, sources, f"{root.rstrip('/')}/raw", load_ts, force)
    warehouse = Warehouse(spark, root)
    warehouse.publish("source_freshness", freshness_results(warehouse, load_ts))
    tables = staged_tables(warehouse)
    _stop_on(warehouse, check_layer(warehouse, rules.STAGING, tables), stop_on_error)
    tables["int_installment_schedule"], moved = refresh_schedule(
        warehouse, tables["stg_installments_payments"], full_refresh
    )
    tables |= build_history(warehouse, tables, window_start)
    _stop_on(warehouse, check_layer(warehouse, rules.HISTORY, tables), stop_on_error)
    tables |= build_marts(warehouse, tables, moved, full_refresh)
    if moved is not None:
        moved.forget()
    if with_history:
        tables[STATUS] = build_status_history(warehouse, tables, full_refresh=full_refresh)
    failed = check_layer(warehouse, rules.MARTS, tables)
    if with_history:
        failed += check_layer(warehouse, rules.SNAPSHOT, tables)
    failed += _failed(warehouse.publish("checks_business", business_results(tables)))
    _stop_on(warehouse, failed, stop_on_error)
    messages = business_checks.verify_layers(
        warehouse.raw("application_train"),
        tables["stg_application_train"],
        tables,
        tables.get(STATUS),
    ).collect()  # one short message per layer
    _stop_on(warehouse, [m.message for m in messages], stop_on_error, "verification")
    warehouse.run.commit()
    return tables


def freshness_results(warehouse: Warehouse, now: datetime.datetime) -> DataFrame:
    """One row per source: its latest load and whether that is too old."""
    return reduce(
        DataFrame.unionByName,
        (
            raw_load.freshness(warehouse.raw(t.name), now).withColumn("table_name", F.lit(t.name))
            for t in TABLES
        ),
    )


def read_sources(
    spark: SparkSession, folder: str, kind: str = "csv", multi_line: bool = False
) -> dict[str, DataFrame]:
    """The source tables of a folder: CSV files, or a Parquet table of text for each."""
    if kind == "parquet":
        return {t.name: readers.read_parquet(spark, f"{folder}/{t.name}") for t in TABLES}
    return {
        t.name: readers.read_csv_text(spark, f"{folder}/{t.file_name}", multi_line=multi_line)
        for t in TABLES
    }


def main(argv: list[str]) -> None:
    source_folder, root, *kind = argv
    spark = build_session("lendscope")
    now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None, microsecond=0)
    run(spark, read_sources(spark, source_folder, *kind), root, now)


if __name__ == "__main__":
    main(sys.argv[1:])
