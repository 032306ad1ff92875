"""The job end to end on the mapped test tables, and the streaming feed."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from lendscope.operators import monthly, quality, scd2
from lendscope.plans import pipeline, rules
from lendscope.sources import store
from lendscope.sources.registry import TABLES
from lendscope.streaming.status_feed import follow_status
from verification import mapping
from verification.frames import Frames
from verification.queries import source_columns

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_two_runs_publish_the_same_marts(spark, tmp_path):
    f = Frames(spark, SF_DIR)
    sources = {t.name: source_columns(f.raw(t.name)) for t in TABLES}
    root, first = str(tmp_path), datetime.datetime(2024, 6, 1)
    options = {"window_start": mapping.POS_WINDOW_START, "stop_on_error": False}
    tables = pipeline.run(spark, sources, root, first, **options)
    counts = {name: df.count() for name, df in tables.items()}
    assert min(counts.values()) > 0
    assert counts["fct_installments"] == f.fct_installments.count()
    assert counts["mart_credit_risk"] == f.segments.count()
    fact = store.current_version(spark, f"{root}/tables", pipeline.FACT)

    again = pipeline.run(spark, sources, root, first + datetime.timedelta(days=1), **options)
    assert {name: df.count() for name, df in again.items()} == counts
    # Nothing was loaded, so nothing was merged and no version was written.
    assert store.current_version(spark, f"{root}/tables", pipeline.FACT) == fact

    business = {r.check_name: r for r in pipeline.business_results(again).collect()}
    assert {r.check_name for r in business.values() if r.status == "fail"} == set()
    assert business["schedule_amounts"].status == "warn"

    # All checks ran and left their results, although nothing was to stop the job.
    layers = [f"checks_{layer}" for layer in (*rules.CHECKS, "business")]
    published = {name: store.read_current(spark, f"{root}/tables", name) for name in layers}
    assert all(df is not None and df.count() > 0 for df in published.values())
    fresh = store.read_current(spark, f"{root}/tables", "source_freshness").collect()
    assert len(fresh) == len(TABLES) and {r.status for r in fresh} == {"pass"}

    # The mapped data breaks some label lists on purpose: an error must stop the job.
    with pytest.raises(pipeline.ChecksFailed, match="emergencystate_mode"):
        pipeline.run(spark, sources, root, first, window_start=mapping.POS_WINDOW_START)
    # Sources that do not change are reported as old and stop nothing.
    late = first + datetime.timedelta(days=30)
    assert pipeline.run(spark, sources, root, late, **options)[pipeline.FACT].count() == counts[pipeline.FACT]
    fresh = store.read_current(spark, f"{root}/tables", "source_freshness").collect()
    assert {r.status for r in fresh} == {"error"}


def test_the_job_passes_its_checks_on_clean_data(spark, tmp_path):
    f = Frames(spark, SF_DIR)
    sources = {t.name: source_columns(f.raw(t.name)) for t in TABLES}
    options = {"window_start": mapping.POS_WINDOW_START}
    for name in ("application_train", "application_test", "bureau", "previous_application",
                 "installments_payments", "pos_cash_balance", "credit_card_balance", "bureau_balance"):
        sources[name] = _without_bad_labels(sources[name], name)
    tables = pipeline.run(spark, sources, str(tmp_path), datetime.datetime(2024, 6, 1), **options)
    assert tables["mart_credit_risk"].count() > 0


def _without_bad_labels(df, name):
    """NULL in place of labels that the declared checks do not allow."""
    checks = [
        c for c in rules.CHECKS[rules.STAGING] if c.table == f"stg_{name}" and c.kind == quality.ACCEPTED
    ]
    allowed = {c.columns[0]: c.allowed for c in checks if c.severity == quality.ERROR}
    return df.select(
        *(
            F.when(F.trim(F.col(c)).isin(*allowed[c.lower()], "XNA"), F.col(c)).alias(c)
            if c.lower() in allowed and c.lower() not in {"target"} and "flag" not in c.lower()
            else F.col(c)
            for c in df.columns
        )
    )


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    from lendscope.streaming.status_feed import apply_load

    schema = "sk_id_prev bigint, sk_id_curr bigint, name_contract_status string, observed_month bigint, as_of_month bigint"
    root = str(tmp_path)
    batch = spark.createDataFrame([(1, 9, "A", -24, -24), (1, 9, "B", -1, -1)], schema)

    def state():
        rows = store.read_current(spark, root, "h").collect()
        return store.current_version(spark, root, "h"), sorted((r.dbt_valid_from, r.dbt_valid_to) for r in rows)

    apply_load(batch, root, "h", 0)
    before = state()
    assert before[1] == [(-24, -1), (-1, None)] and store.current_note(spark, root, "h") == "0"
    apply_load(batch, root, "h", 0)
    assert state() == before
    apply_load(batch, root, "h", 1)  # seen under another number: the same versions
    assert state()[1] == before[1]
    with pytest.raises(Exception, match="is past moment"):
        apply_load(spark.createDataFrame([(1, 9, "C", -12, -12)], schema), root, "h", 2)
    assert state()[1] == before[1]


def test_stream_of_loads_equals_the_batch_history(spark, tmp_path):
    f = Frames(spark, SF_DIR)
    landing = str(tmp_path / "landing")
    for month in (-24, -12, -1):
        monthly.status_as_of(f.pos, month).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    loads = spark.readStream.schema(schema).parquet(landing)
    for _ in range(2):  # the second run finds nothing new
        query = follow_status(loads, str(tmp_path), "history", str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
    streamed = store.read_current(spark, str(tmp_path), "history")
    stepped = scd2.start_history(
        monthly.status_as_of(f.pos, -24), "sk_id_prev", F.col("as_of_month")
    )
    for month in (-12, -1):
        stepped = scd2.scd2_apply(stepped, monthly.status_as_of(f.pos, month))
    columns = sorted(stepped.columns)
    assert streamed.select(columns).exceptAll(stepped.select(columns)).count() == 0
    assert streamed.count() == stepped.count()
