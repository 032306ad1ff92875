"""Headline operators, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select the data and the
local cores. As in the job, landed text and staged tables are Parquet that exists before: they
are prepared first and reported apart (`prepare`), not as part of `value`. `typing` turns all
landed text into staged columns. Every operator then reads all staged rows and runs to
completion into a no-op sink; incremental operators meet a target that is already published.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lendscope.operators import monthly, upsert  # noqa: E402
from lendscope.operators.schedule import installment_schedule  # noqa: E402
from lendscope.operators.staging import stage  # noqa: E402
from lendscope.operators.status_history import StatusHistory  # noqa: E402
from lendscope.plans import marts  # noqa: E402
from lendscope.session import build_session  # noqa: E402
from lendscope.sources import catalog  # noqa: E402
from lendscope.sources.registry import TABLES  # noqa: E402
from verification import queries  # noqa: E402
from verification.frames import Frames, StagedFrames  # noqa: E402

HEADLINE = (
    "int_installment_schedule",
    "int_loan_payment_performance",
    "int_pos_cash_loan",
    "int_credit_card_loan",
    "int_bureau_client",
    "int_client_credit_history",
    "dim_client",
    "fct_loans",
    "fct_installments",
    "mart_credit_risk",
    "mart_vintage_curves",
    "scd2_backfill",
    "dq_suite",
    "rpt_worst_dpd_recency",
    "rpt_worst_dpd_ci",
)


def _sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _step(name: str, act: Callable[[], object], into: dict) -> None:
    began = time.perf_counter()
    act()
    into[name] = round(time.perf_counter() - began, 3)
    print(f"{name} {into[name]}s", file=sys.stderr, flush=True)


def _timed(name: str, build: Callable[[], DataFrame], into: dict) -> None:
    _step(name, lambda: _sink(build()), into)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    root = tempfile.mkdtemp(prefix="bench-")
    given = Frames(spark, sf_dir)
    prepare: dict[str, float] = {}
    seconds: dict[str, float] = {}

    def write(path: str):
        return lambda df: df.repartition(cpus).write.parquet(f"{root}/{path}")

    def read(path: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{path}")

    def prepared(kind: str, build: Callable[[str], DataFrame]) -> None:
        began = time.perf_counter()
        for table in TABLES:
            write(f"{kind}/{table.name}")(build(table.name))
        prepare[kind] = round(time.perf_counter() - began, 3)

    prepared("raw", given.raw)
    prepared("staged", lambda name: stage(read(f"raw/{name}"), name))
    f = StagedFrames(spark, sf_dir, f"{root}/staged")
    late = F.col("loaded_at") >= F.lit(queries.LATE).cast("timestamp")
    run = catalog.Run(spark, f"{root}/tables")
    tables, history = upsert.ScheduleTables(run, buckets=2 * cpus), StatusHistory(run, "status")
    *loads, last = queries.LOADS

    def fact_of(rows: DataFrame) -> DataFrame:
        return marts.fct_installments(rows, f.train, f.previous)

    def early_fact() -> None:
        tables.build(f.payments.where(~late))
        tables.build_fact(fact_of)

    _step("early fact", early_fact, prepare)
    _step("status history", lambda: [history.apply(monthly.status_as_of(f.pos, m)) for m in loads], prepare)
    run.commit()
    ten = [f.payments.withColumn("sk_id_prev", F.col("sk_id_prev") + F.lit(i * 10**12)) for i in range(10)]
    _step("ten times the payments", lambda: write("ten")(reduce(DataFrame.unionByName, ten)), prepare)

    began = time.perf_counter()
    for table in TABLES:
        _sink(stage(read(f"raw/{table.name}"), table.name))
    seconds["typing"] = round(time.perf_counter() - began, 3)
    for name in HEADLINE:
        fresh = StagedFrames(spark, sf_dir, f"{root}/staged")
        _timed(name, lambda: queries.BUILDERS[name](fresh), seconds)

    _step("incremental_merge", lambda: tables.merge_fact(fact_of, tables.add(f.payments.where(late))), seconds)
    _step("scd2_apply", lambda: history.apply(monthly.status_as_of(f.pos, last)), seconds)
    # Besides the headline: a merge of nothing, and the slope from one to ten times the rows.
    more: dict[str, float] = {}
    _step("incremental_merge, nothing new", lambda: tables.merge_fact(fact_of), more)
    _step("int_installment_schedule, ten times", lambda: _sink(installment_schedule(read("ten"))), more)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "prepare": prepare,
                "more": more,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
