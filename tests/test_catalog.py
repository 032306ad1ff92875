"""Tables that are switched together, in buckets, and by deliveries."""

from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lendscope.operators import scd2, schedule, upsert
from lendscope.operators.status_history import PastMomentError, StatusHistory
from lendscope.plans import pipeline
from lendscope.sources import catalog, store

PAYMENTS = (
    "sk_id_prev bigint, sk_id_curr bigint, num_instalment_version bigint, num_instalment_number bigint, "
    "days_instalment bigint, days_entry_payment bigint, amt_instalment decimal(18,4), "
    "amt_payment decimal(18,4), loaded_at timestamp"
)


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_a_run_becomes_current_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    store.publish(spark.range(3), root, "a")
    run = catalog.Run(spark, root)
    run.publish("a", spark.range(5))
    run.publish("b", spark.range(2))
    run.publish("c", spark.range(1))
    run.publish("d", spark.range(1))
    assert run.commit(n for n in ("c", "d")) == 2
    assert store.read_current(spark, root, "d").count() == 1
    assert _ids(run.read("a")) == list(range(5))
    assert store.read_current(spark, root, "a").count() == 3
    assert store.read_current(spark, root, "b") is None
    run.commit()
    assert store.read_current(spark, root, "a").count() == 5
    assert store.read_current(spark, root, "b").count() == 2


def test_of_two_runs_from_one_state_the_second_is_refused(spark, tmp_path):
    root = str(tmp_path)
    one, two = catalog.Run(spark, root), catalog.Run(spark, root)
    one.publish("a", spark.range(1))
    two.publish("a", spark.range(2))
    two.publish("b", spark.range(2))
    assert one.commit() == 1
    with pytest.raises(catalog.OvertakenError):
        two.commit()
    assert store.read_current(spark, root, "a").count() == 1
    assert store.read_current(spark, root, "b") is None


def test_tables_of_one_folder_can_be_published_side_by_side(spark, tmp_path):
    root = str(tmp_path)
    run = catalog.Run(spark, root)
    run.publish("a", spark.range(4))
    store.publish(spark.range(1), root, "b")
    assert store._switch(run, "a") == 4
    assert (store.read_current(spark, root, "a").count(), store.read_current(spark, root, "b").count()) == (4, 1)
    late = catalog.Run(spark, root)
    late.publish("a", spark.range(9))
    store.publish(spark.range(2), root, "a")
    with pytest.raises(catalog.OvertakenError):
        store._switch(late, "a")


def _files(root, table):
    return {p: p.stat().st_mtime_ns for p in Path(root, table).glob("version-*/**/*.parquet")}


def test_a_merge_writes_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(200).select("id", F.lit("old").alias("v"))
    run = catalog.Run(spark, root)
    run.publish_buckets("t", rows, ["id"], 8)
    run.commit()
    before, old = _files(root, "t"), run.entry("t")
    assert old.n_rows == 200 and len(old.folders) == 8

    run = catalog.Run(spark, root)
    change = run.merge("t", spark.createDataFrame([(7, "new")], "id bigint, v string"))
    assert change.rows == 1 and len(change.labels) == 1
    new = run.entry("t")
    moved = {label for label in new.folders if new.folders[label] != old.folders[label]}
    assert moved == set(change.labels) and new.n_rows == 200
    change.forget()
    assert not list(Path(root, "t").glob("delta-*"))
    run.commit()
    found = {r.id: r.v for r in store.read_current(spark, root, "t").collect()}
    assert len(found) == 200 and {k for k, v in found.items() if v == "new"} == {7}
    assert before.items() <= _files(root, "t").items()

    unchanged = catalog.Run(spark, root)
    assert unchanged.merge("t", rows.where("false")).rows == 0
    assert unchanged.changed == {} and unchanged.commit() == run.number
    assert set(_files(root, "t")) == set(before) | {p for p in _files(root, "t") if "version-000002" in str(p)}


def test_a_bucket_is_written_by_all_tasks_without_an_exchange(spark, tmp_path):
    run = catalog.Run(spark, str(tmp_path))
    run.publish_buckets("t", spark.range(0, 1000, 1, 4).select("id"), ["id"], 2)
    run.merge("t", spark.range(500, 1500, 1, 4).select("id"))
    assert _ids(run.read("t")) == list(range(1500))
    first = list(Path(tmp_path, "t", "version-000001").glob("_bucket=*/*.parquet"))
    assert len(first) == 2 * 4


def test_buckets_may_lose_and_gain_all_rows(spark, tmp_path):
    run = catalog.Run(spark, str(tmp_path))
    run.publish_buckets("t", spark.range(0).select("id"), ["id"], 4)
    assert run.read("t").count() == 0
    run.merge("t", spark.range(3))
    assert _ids(run.read("t")) == [0, 1, 2]
    run.rewrite_buckets("t", spark.range(3), lambda old, new: old.join(new, "id", "left_anti"))
    assert run.read("t").count() == 0 and run.entry("t").n_rows == 0


def test_expiry_removes_what_only_old_runs_name(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        store.publish(spark.range(n), root, "a")
    store.publish(spark.range(7), root, "b")
    spark.range(1).write.parquet(f"{root}/a/version-000099")  # of a run under way
    assert catalog.expire(spark, root, keep=2) == ["a/version-000001", "a/version-000002"]
    assert store.read_current(spark, root, "a").count() == 3
    assert store.read_current(spark, root, "b").count() == 7
    assert Path(root, "a", "version-000099").exists() and not Path(root, "a", "version-000001").exists()
    assert catalog.expire(spark, root, keep=2) == []
    with pytest.raises(ValueError, match="at least"):
        catalog.expire(spark, root, keep=0)


# --- installments from stored states

EARLY, LATE = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1)


def _payments(spark, rows):
    return spark.createDataFrame(rows, PAYMENTS)


def _payment_rows():
    from decimal import Decimal

    rows = []
    for loan in range(1, 30):
        for number in range(1, 5):
            for version in (None, 1, 2)[: 1 + (loan + number) % 3]:
                paid = None if (loan * number) % 5 == 0 else Decimal(10 * number)
                day = None if paid is None else -100 + loan - number
                rows.append((loan, 7, version, number, -100, day, Decimal(20), paid, EARLY))
    # A second payment, a lower version, a new installment, a new loan, an unusable row.
    late = [
        (3, 7, 2, 1, -100, -90, Decimal(20), Decimal(15), LATE),
        (4, 7, 0, 2, -101, -99, Decimal(30), None, LATE),
        (5, 7, 1, 99, -100, -120, Decimal(20), Decimal(1), LATE),
        (77, 8, 1, 1, -100, None, Decimal(20), None, LATE),
        (None, 8, 1, 1, -100, None, Decimal(20), None, LATE),
    ]
    return rows, late


def test_states_of_two_sets_of_payments_are_those_of_both(spark):
    early, late = (_payments(spark, rows) for rows in _payment_rows())
    merged = schedule.merge_states(schedule.version_states(early), schedule.version_states(late))
    whole = schedule.version_states(early.unionByName(late))
    assert merged.exceptAll(whole.select(merged.columns)).count() == 0 and merged.count() == whole.count()


def test_new_payments_are_merged_without_reading_old_ones(spark, tmp_path):
    early, late = (_payments(spark, rows) for rows in _payment_rows())
    early.write.parquet(str(tmp_path / "early"))
    late.write.parquet(str(tmp_path / "late"))
    early, late = (spark.read.parquet(str(tmp_path / n)) for n in ("early", "late"))
    run = catalog.Run(spark, str(tmp_path / "tables"))
    tables = upsert.ScheduleTables(run, buckets=16)
    tables.build(early, "a")
    tables.build_fact(lambda rows: rows.withColumn("fact", F.lit(1)))
    run.commit()
    before = {n: run.entry(n).folders for n in (tables.STATES, tables.SCHEDULE, tables.FACT)}

    moved = tables.add(late, "b")
    # What went into the change: late payments, and the touched buckets of stored states.
    assert all("/late/" in name for name in schedule.version_states(late).inputFiles())
    assert not any("/early/" in name for name in run.read(tables.STATES).inputFiles())
    assert moved.rows == 4 and sorted(r.sk_id_prev for r in moved.delta.collect()) == [3, 4, 5, 77]
    assert tables.merge_fact(lambda rows: rows.withColumn("fact", F.lit(1)), moved) == 4
    assert run.entry(tables.STATES).note == "b"
    for name, folders in before.items():
        changed = {x for x, f in run.entry(name).folders.items() if folders.get(x) != f}
        assert 0 < len(changed) <= 4

    full = schedule.installment_schedule(early.unionByName(late))
    for name in (tables.SCHEDULE, tables.FACT):
        got = run.read(name).select(full.columns)
        assert got.exceptAll(full).count() == 0 and got.count() == full.count()

    run.commit()
    again = catalog.Run(spark, str(tmp_path / "tables"))
    assert upsert.ScheduleTables(again, 16).add(late.where("false")) is None and again.changed == {}


# --- history


def _loads(spark, rows):
    return spark.createDataFrame(
        rows, "sk_id_prev bigint, sk_id_curr bigint, name_contract_status string, observed_month bigint, as_of_month bigint"
    )


def _versions(df):
    return sorted(
        ((r.sk_id_prev, r.dbt_valid_from, r.dbt_valid_to, r.name_contract_status) for r in df.collect()), key=str
    )


def test_a_load_meets_the_open_versions_only(spark, tmp_path):
    root = str(tmp_path)
    run = catalog.Run(spark, root)
    history = StatusHistory(run, "h")
    history.apply(_loads(spark, [(1, 9, "A", -24, -24), (2, 9, None, -24, -24)]))
    history.apply(_loads(spark, [(1, 9, "B", -12, -12), (2, 9, None, -12, -12), (3, 9, "A", -12, -12)]))
    run.commit()
    closed = {x: f for x, f in run.entry("h").folders.items() if x != "open"}
    load = _loads(spark, [(1, 9, "C", -6, -6), (1, 9, "C", -5, -5), (1, 9, "A", -4, -4), (3, 9, None, -4, -4)])
    changes = scd2.scd2_changes(history.open_versions(), load)
    folders_read = {name.split("/h/")[1].split("/")[0] for name in changes.inputFiles() if "/h/" in name}
    assert folders_read == {run.entry("h").folders["open"].split("/")[1]}
    done = history.apply(load)
    assert (done.opened, done.past, done.refused) == (3, 0, 0)
    # Files of closed versions are written once.
    assert closed.items() < run.entry("h").folders.items()
    want = [
        (1, -24, -12, "A"), (1, -12, -6, "B"), (1, -6, -4, "C"), (1, -4, None, "A"),
        (2, -24, None, None), (3, -12, -4, "A"), (3, -4, None, None),
    ]
    assert _versions(history.read()) == sorted(want, key=str)
    # Applied again, in one batch or alone, nothing changes, not even files.
    folders = run.entry("h").folders
    assert history.apply(load).opened == 0
    assert history.apply(_loads(spark, [(1, 9, "B", -9, -9), (1, 9, "A", -20, -20)])).refused == 0
    assert run.entry("h").folders == folders


def test_rows_that_contradict_the_past_go_to_a_table_of_their_own(spark, tmp_path):
    run = catalog.Run(spark, str(tmp_path))
    history = StatusHistory(run, "h")
    history.apply(_loads(spark, [(1, 9, "A", -24, -24), (1, 9, "B", -12, -12)]))
    before = _versions(history.read())
    bad = [
        (1, 9, "X", -24, -24),  # of a closed version
        (1, 9, "X", -12, -12),  # of the open one
        (1, 9, "A", -30, -30),  # before the first
    ]
    with pytest.raises(PastMomentError, match="past moment"):
        history.apply(_loads(spark, bad), stop_on_refused=True)
    good = [(1, 9, "B", -3, -3), (2, 9, "A", -3, -3), (2, 9, "B", -3, -3)]
    done = history.apply(_loads(spark, bad + good))
    assert (done.opened, done.past, done.refused) == (1, 2, 4)
    assert _versions(history.read()) == [*before, (2, -3, None, "A")]
    refused = run.read("h_refused")
    assert sorted((r.sk_id_prev, r.as_of_month, r.name_contract_status) for r in refused.collect()) == [
        (1, -30, "A"), (1, -24, "X"), (1, -12, "X"), (2, -3, "B")
    ]
    # Refused again, recorded once.
    assert history.apply(_loads(spark, bad)).refused == 0
    assert run.read("h_refused").count() == 4


# --- the job


def test_a_defect_leaves_the_old_tables_current(spark, tmp_path, monkeypatch):
    """A planted defect behind the marts: what the checks found is published, the marts are not."""
    from lendscope.sources.registry import TABLES
    from tests.test_pipeline import SF_DIR, Frames, mapping, source_columns

    f = Frames(spark, SF_DIR)
    sources = {t.name: source_columns(f.raw(t.name)) for t in TABLES}
    options = {"window_start": mapping.POS_WINDOW_START, "with_history": False}
    root, tables = str(tmp_path), f"{tmp_path}/tables"
    pipeline.run(spark, sources, root, EARLY, stop_on_error=False, **options)
    entries = catalog.current(spark, tables)[1]
    monkeypatch.setattr(pipeline, "check_layer", lambda *a: [])
    monkeypatch.setattr(pipeline, "_failed", lambda results: ["planted"])
    with pytest.raises(pipeline.ChecksFailed, match="planted"):
        pipeline.run(spark, sources, root, LATE, full_refresh=True, **options)
    after = catalog.current(spark, tables)[1]
    results = {"checks_business", "source_freshness"}
    assert {n for n in after if after[n] != entries.get(n)} == results
    monkeypatch.undo()

    # A late delivery: the fact is merged in some buckets, and equals a build from all payments.
    late = sources["installments_payments"].limit(3)
    from lendscope.sources import raw_load

    raw_load.append_raw(late, "installments_payments", "late.csv", LATE, f"{root}/raw")
    whole = sources | {"installments_payments": sources["installments_payments"].unionByName(late)}
    built = pipeline.run(spark, whole, root, LATE, stop_on_error=False, **options)
    now = catalog.current(spark, tables)[1][pipeline.FACT]
    moved = [x for x in now.folders if now.folders[x] != entries[pipeline.FACT].folders.get(x)]
    assert len(moved) <= 3
    rebuilt = pipeline.run(spark, whole, str(tmp_path / "other"), LATE, stop_on_error=False, **options)
    columns = [c for c in rebuilt[pipeline.FACT].columns if c != "loaded_at"]
    left, right = (t[pipeline.FACT].select(columns) for t in (built, rebuilt))
    assert left.exceptAll(right).count() == 0 and left.count() == right.count()
