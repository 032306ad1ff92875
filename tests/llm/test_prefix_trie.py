"""Tree contraction and the trie of conversation prefixes against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from lendscope.llm import contraction, prefix_trie, queries

SF = "/root/testdata/sf0.001"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _totals(spark, parents, values):
    rows = [(node, parent, values[node], 1, "x") for node, parent in parents.items()]
    tree = spark.createDataFrame(rows, "node long, parent long, weight long, one long, next string")
    return {r.node: (r.weight, r.one) for r in contraction.subtree_totals(tree, ["weight", "one"]).collect()}


def _brute_totals(parents, values):
    want = {node: [0, 0] for node in parents}
    for node in parents:
        at = node
        while at is not None:
            want[at][0] += values[node]
            want[at][1] += 1
            at = parents[at]
    return {node: tuple(total) for node, total in want.items()}


def _shapes():
    rng = random.Random(5)
    chain = {0: None} | {i: i - 1 for i in range(1, 70)}
    star = {0: None} | {i: 0 for i in range(1, 40)}
    # Two roots, chains that hang on random nodes.
    mixed: dict[int, int | None] = {0: None, 1: None}
    while len(mixed) < 150:
        at = rng.choice(list(mixed))
        for _ in range(rng.choice([1, 1, 2, 12])):
            mixed[len(mixed)] = at
            at = len(mixed) - 1
    return {"chain": chain, "star": star, "mixed": mixed, "single": {4: None}}


@pytest.mark.parametrize("shape", ["chain", "star", "mixed", "single"])
def test_contraction_gives_every_subtree_total(spark, shape):
    parents = _shapes()[shape]
    rng = random.Random(7)
    values = {node: rng.randrange(100) for node in parents}
    assert _totals(spark, parents, values) == _brute_totals(parents, values)


def test_contraction_of_nothing_and_of_a_cycle(spark):
    empty = spark.createDataFrame([], "node long, parent long, weight long")
    assert contraction.subtree_totals(empty, ["weight"]).collect() == []
    cycle = spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "node long, parent long, weight long")
    with pytest.raises(ValueError, match="cycle"):
        contraction.subtree_totals(cycle, ["weight"])


def brute(rows, rebuild=True):
    """The contract, prefix by prefix."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    given = {conv: [t[2:] for t in sorted(turns)] for conv, turns in given.items()}
    convs = {}
    for conv, turns in given.items():
        h = zlib.crc32(str(conv).encode()) % 6 if rebuild else 0
        convs[conv] = tuple(given.get(conv - conv % 100, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in convs.items():
        ends[turns].append(conv)
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    want, n_kids = [], Counter(key[:-1] for key in members if key)
    for key, inside in members.items():
        below = [k for k in members if k[: len(key)] == key]
        leaves = [k for k in below if k not in n_kids]
        tokens = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        ids = ",".join(map(str, sorted(ends[key])))
        parent = min(members[key[:-1]]) if key else None
        want.append((min(inside), len(key), parent, len(inside), n_kids[key], len(leaves), tokens,
                     hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(want, key=repr)


def found(df):
    return sorted(map(tuple, df.select(NAMES).collect()), key=repr)


def _rows():
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 30), 100, 207, 208, 209, 303, 500, 555, 777]:
        for turn in range(rng.randrange(1, 8)):
            rows.append((conv, turn, ["user", "assistant"][turn % 2], rng.choice(["a", "é" * 3, "", "bb"])))
    rows += [(555, None, "user", "first"), (555, None, None, None), (555, 1, "user", "a"), (555, 1, "user", "a")]
    rows += [(None, 0, "user", "nobody"), (777, 90, "user", "long " * 50_000)]
    # One conversation with a third of all rows; copies of one conversation.
    rows += [(208, 10 + k, "user", f"t{k}") for k in range(90)]
    rows += [(600 + k, t, "user", f"same {t}") for k in range(40) for t in range(7)]
    return rows


def test_trie_of_rebuilt_conversations(spark, monkeypatch):
    # Blocks small enough that conversations and id lists have several.
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    rows = _rows()
    # Columns whose names the operator uses itself.
    turns = spark.createDataFrame(
        [(*r, 1, "p") for r in rows], "conv_id long, turn long, role string, text string, depth int, part string"
    )
    assert found(prefix_trie.rebuilt_trie(turns)) == brute(rows)


def test_trie_of_conversations_as_they_stand(spark):
    rows = _rows()[:60]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(prefix_trie.conversation_trie(turns)) == brute(rows, rebuild=False)


def test_turnless_conversations_belong_to_the_root(spark):
    few = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2][:3]
    rows = [(c, 0, "user", "x") for c in few]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(prefix_trie.rebuilt_trie(turns)) == brute(rows)
    assert len(brute(rows)) == 1


def test_an_empty_table_has_no_trie(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert found(prefix_trie.rebuilt_trie(turns)) == []


def test_the_query_covers_all_conversations(spark):
    turns = queries.table(spark, SF, "conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in turns.collect()]
    assert found(queries.QUERIES["op13_prefix_trie"](spark, SF)) == brute(rows)
