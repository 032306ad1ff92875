"""The pipeline: every stage on its own, all stages together, and the contract of STAGES."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import packing, queries
from tests.llm.test_similarity import _brute, _texts

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in _texts(np.random.default_rng(9))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # Columns with names that the stages use themselves.
    return frame.withColumns({"score": F.lit(1), "node": F.lit("x"), "length": F.lit(2)})


def test_near_copies_keep_the_smallest_of_each_group(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = STAGE["near copies"](spark, docs, SF)
    assert kept.columns == docs.columns
    want = {i for i, (_, group) in _brute(rows, 5, 80).items() if i == group}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got) == sorted(want)


def test_repeated_and_null_ids(spark, docs):
    odd = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words"), (None, "a b c d e f"), (2, None), (2, None)]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in STAGE["near copies"](spark, frame, SF).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "a b c d e f"), (1, "other words"), (None, "a b c d e f"), (2, None)], key=str
    )


def test_unlike_texts_that_share_an_id_are_judged_one_by_one(spark):
    """Of three rows, the second is a copy of the first and shares its id with a text of its own."""
    rows = [(0, "a b c d e f g"), (5, "a b c d e f g"), (5, "nothing like it at all here"), (0, "A b c d e f g")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in STAGE["near copies"](spark, frame, SF).collect()]
    assert sorted(t.lower() for _, t in got) == ["a b c d e f g", "nothing like it at all here"]
    assert {i for i, t in got if t.lower().startswith("a b")} == {0}
    (item,) = spark.read.parquet(f"{SF}/benchmark.parquet").limit(1).collect()
    rows = [(7, f"before {item.text} behind"), (7, "a clean text of its own"), (8, None), (None, item.text)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in STAGE["decontamination"](spark, frame, SF).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[2], rows[3]], key=str)


@pytest.mark.parametrize("name", ["quality", "near copies", "decontamination"])
def test_filters_keep_columns_and_take_empty_tables(spark, docs, name):
    frame = STAGE[name](spark, docs.limit(0), SF)
    assert frame.columns == docs.columns and frame.count() == 0
    assert [f.dataType for f in frame.schema] == [f.dataType for f in docs.schema]


def test_run_against_its_parts(spark):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    left = {r.doc_id for r in rows}
    good = {r.doc_id for r in queries.op7_quality(spark, SF).collect() if r.predicted == 1}
    groups = _brute([(i, documents[i]) for i in good], 5, 80)
    single = {i for i, (_, group) in groups.items() if i == group}
    leaking = {r.doc_id for r in queries.op2_template_leaks(spark, SF).collect()}
    assert left == single - leaking
    assert {r.padded_length for r in rows if r["length"] > r.padded_length} == set()
    assert sum(r["length"] for r in rows) > 0 and packing.CONTEXT >= max(r["length"] for r in rows)


def test_stages_of_the_contract():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near copies", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
