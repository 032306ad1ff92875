"""What the frames over the test tables derive, how often, and on how many tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendscope.operators import monthly
from verification.frames import Frames

SF_DIR = "/root/testdata/sf0.001"


def test_wide_client_rows_are_made_on_all_cores(spark):
    rows = Frames(spark, SF_DIR).raw("application_train")
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    assert rows.count() == Frames(spark, SF_DIR).source("customer").where("c_custkey % 6 <> 5").count()


def test_a_status_history_reads_months_that_were_written(spark):
    f = Frames(spark, SF_DIR)
    assert all("/status-months-" in path for path in f.status_months.inputFiles())
    written = f.status_months.groupBy("name_contract_status").count().collect()
    again = f.pos.groupBy("name_contract_status").count().collect()
    assert sorted(written, key=repr) == sorted(again, key=repr)
    assert all("/status-months-" in path for path in f.status_history.inputFiles())


def test_no_dictionary_of_statuses_where_none_is_asked_for(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a dictionary was looked up")

    monkeypatch.setattr(monthly, "LatestStatus", refuse)
    f = Frames(spark, SF_DIR)
    assert {"pos_max_sk_dpd_def", "n_installments"} <= set(f.history.columns)
    assert "pos_max_sk_dpd_def" in f.fct_loans.columns
    assert "months_on_book" in f.vintage.columns


def test_checked_tables_are_written_once_and_built_on(spark):
    f = Frames(spark, SF_DIR)
    before = f.fct_loans.collect()
    f = Frames(spark, SF_DIR)
    loans = f.tables(["fct_loans", "stg_bureau"])["fct_loans"]
    assert all("/fct-loans-" in path for path in loans.inputFiles())
    assert any("/fct-loans-" in path for path in f.vintage.inputFiles())
    assert sorted(loans.collect(), key=repr) == sorted(before, key=repr)


def test_joins_of_the_fact_move_facts_only(spark):
    plan = Frames(spark, SF_DIR).fct_installments._jdf.queryExecution().optimizedPlan().toString()
    above, joins = plan[: plan.index("Join")], plan[plan.index("Join") :]
    assert "md5(" in above and "md5(" not in joins and "90+" not in joins


def test_the_coverage_check_builds_the_schedule_once(spark, monkeypatch):
    import __spark_entry__

    written = []
    publish = Frames.publish
    monkeypatch.setattr(Frames, "publish", lambda f, *names: (written.extend(names), publish(f, *names)))
    query = __spark_entry__.queries()["chk_fct_vs_schedule"]
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(initial, None) is None
    try:
        query(spark, SF_DIR).collect()
        assert written == ["schedule"] and spark.conf.get(initial) == "512"
    finally:
        spark.conf.unset(initial)


def test_monthly_balances_are_summarised_once_for_all_that_are_checked(spark, monkeypatch):
    from verification.queries import REGISTRY

    built = []
    publish = Frames.publish
    monkeypatch.setattr(Frames, "publish", lambda f, *names: (built.append(f), publish(f, *names)))
    for name in ("dq_suite_marts", "verify_layers"):
        REGISTRY[name](spark, SF_DIR)
        # What was not written itself reads what was, and derives no months from the payments again.
        for model in ("pos_measures", "history", "vintage"):
            files = getattr(built[-1], model).inputFiles()
            assert files and not any("/lineitem.parquet" in path for path in files), (name, model)
    assert not any("/lineitem.parquet" in path for path in built[-1].status_history.inputFiles())


def test_versions_travel_as_rows_not_as_partial_sums(spark):
    plan = Frames(spark, SF_DIR).schedule._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("REPARTITION_BY_COL", 1)
    assert "partial_min_by" in above and "partial_min_by" not in below


def test_tasks_read_a_bounded_share_of_files(spark):
    import __spark_entry__

    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    try:
        __spark_entry__.queries()["stg_bureau"](spark, SF_DIR)
        assert spark.conf.get(conf) == "8m"
    finally:
        spark.conf.set(conf, before)
