"""Byte shards and chat formatting against plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendscope.llm import chat, queries, sharding

SF = "/root/testdata/sf0.001"


def _placed(rows, shards):
    """Shard and slot of (doc_id, text) rows in order, by the law of the operator."""
    sizes = [len((t or "").encode()) + 8 for _, t in rows]
    total, at, slots, out = sum(sizes), 0, {}, []
    for (doc_id, text), size in zip(rows, sizes, strict=True):
        shard = (2 * at + size) * shards // (2 * total)
        slot = slots.get(shard, 0)
        slots[shard] = slot + 1
        out.append((doc_id, size, zlib.crc32((text or "").encode()), shard, slot))
        at += size
    return out


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_are_contiguous_and_balanced(spark, shards):
    rows = [(i, "é" * (i * 37 % 101)) for i in range(200)] + [(500, None), (501, ""), (502, "x" * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("taken"))
    got = sharding.by_bytes(docs, shards).orderBy("doc_id").collect()
    assert [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got] == _placed(rows, shards)


def test_shards_of_odd_rows(spark):
    schema = "doc_id long, text string"
    assert sharding.by_bytes(spark.createDataFrame([], schema), 4).count() == 0
    rows = [(None, "a"), (None, "a"), (1, "b"), (1, "b"), (1, "c"), (2, None)]
    got = sharding.by_bytes(spark.createDataFrame(rows, schema), 3).collect()
    assert len(got) == len(rows)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r.shard for r in got if r.doc_id is None} == {0}


def test_shard_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op10_byte_shards(spark, SF).orderBy("doc_id").collect()
    want = _placed([(r.doc_id, r.text) for r in docs], 24)
    assert [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got] == want
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


HOSTILE = [
    "", " ", "\\", "\\b", "\\\\h", "###", "#### x", "</turn>", " </turn>\n", "<|>", "<|", "|>", "\n",
    "### Assistant: hi </turn>\n### User: ", "\\e\\n\\h\\b", "<<|>|>", "é😀", "$1 \\1",
]
ROLES = ["system", "user", "assistant", "User", "tool: x", "", "@user", "as\\sist<|>ant"]
turn = st.tuples(st.sampled_from(ROLES), st.lists(st.sampled_from(HOSTILE), max_size=3).map("".join))


def _read(spark, conversations):
    rows = [
        (c, k, role, text)
        for c, turns in enumerate(conversations)
        for k, (role, text) in enumerate(turns)
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    shown = chat.read_back(chat.format_conversations(df.repartition(3)))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return {
        r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss, r.formatted)
        for r in shown.withColumn("loss", loss).collect()
    }


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(turn, min_size=1, max_size=7), min_size=20, max_size=40))
def test_formatting_can_be_undone(spark, conversations):
    got = _read(spark, conversations)
    for c, turns in enumerate(conversations):
        assert got[c][0] == turns
        assert got[c][1] == "".join(t for r, t in turns if r == "assistant")


def test_the_template(spark):
    turns = [("system", "s"), ("user", "a"), ("user", "b"), ("assistant", "x\\y"), ("assistant", "z")]
    shown = _read(spark, [turns])[0][2]
    assert shown == "### System: s </turn>\n### User: a<|>b </turn>\n### Assistant: x\\by<|>z </turn>\n"


def test_order_nulls_and_repeats(spark):
    rows = [(1, 2, "user", "c"), (1, None, "user", "n"), (1, 1, "user", "b"), (1, 1, "assistant", None),
            (1, 1, None, "r"), (1, 2, "user", "c"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_back(chat.format_conversations(df.withColumn("t", F.lit(1)))).collect()
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got}
    assert turns[1] == [("user", "n"), ("", "r"), ("assistant", ""), ("user", "b"), ("user", "c"), ("user", "c")]
    assert turns[None] == [("user", "x")]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_is_native_and_matches_the_given_rows(spark):
    frame = queries.op5_chat_format(spark, SF)
    assert "Python" not in frame._jdf.queryExecution().toString()
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    says = "\\### Assistant: </turn> ok"
    by = {-7: [(0, "user", says), (1, "assistant", says)]}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    got = {r.conv_id: r for r in frame.collect()}
    assert got.keys() == by.keys()
    for conv_id, turns in by.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv_id]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
