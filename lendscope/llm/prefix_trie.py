"""The trie of conversation prefixes: what could be computed once for conversations that begin alike.

Nodes are distinct sequences of first turns. A turn is known by a digest of its role and text,
a sequence by two 64-bit sums (exclusive or) over the digests of its turns with their places;
the sums of all prefixes of a conversation come from blocks of turns, so a conversation of any
length is spread over tasks. Sums over subtrees come from `contraction.subtree_totals`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import running_bases, saved, small_batches
from lendscope.llm.contraction import subtree_totals

#: Turns of one conversation, or ids of one list, that are brought into one group.
BLOCK = 4096
#: Node number of the root; other nodes are numbered from 0.
ROOT = -1
NOTHING = hashlib.sha256(b"").hexdigest()


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _in_order(df: DataFrame, *keys: str) -> DataFrame:
    """The rows sorted over all partitions, written, with their partition and a number that
    ascends in that order."""
    laid = df.repartitionByRange(_parts(df), *keys).sortWithinPartitions(*keys)
    laid = saved(laid.withColumn("seq", F.monotonically_increasing_id()), "trie")
    return laid.withColumn("part", F.shiftright("seq", 33))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest and chars of every turn.

    Rows are ordered by turn (null first), rows with the same turn by role and text. Null roles
    and texts are empty, repeated rows are turns of their own, rows with a null conv_id belong
    to no conversation. A conversation may hold any share of all rows: they are sorted over
    partitions, and what a partition adds is a base from the counts of those before it.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    laid = _in_order(rows, "conv_id", "turn", "role", "text").select(
        "conv_id",
        "part",
        "seq",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )
    groups = saved(
        laid.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")),
        "trie",
    )
    bases = running_bases(groups, "part", {"before": "n"}, by=["conv_id"])
    starts = saved(
        groups.join(bases, ["conv_id", "part"]).select("conv_id", "part", (F.col("before") - F.col("first") + 1).alias("shift")),
        "trie",
    )
    return laid.join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("seq") + F.col("shift")).alias("pos"), "digest", "chars"
    )


def shared_openings(numbered: DataFrame, most: int = 5, every: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like the first of their hundred: (turns, conversations).

    Conversation c takes the first h turns of conversation c - c % every (all if it has fewer,
    none if it is absent) and goes on with its own turns after its first h, where h is
    crc32(decimal c) % (most + 1). turns: conv_id, pos, digest, chars. conversations: conv_id and
    n, the turns it has now (0 for some).
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("long")
    own = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumns({"h": h, "base": base})
    own = saved(own, "trie")
    first = own.where(f"conv_id % {every} = 0").select(
        F.col("conv_id").alias("base"), F.col("own").alias("there")
    )
    convs = own.join(first, "base", "left").select(
        "conv_id", "base", "h", "own", F.least("h", F.coalesce("there", F.lit(0))).alias("used")
    )
    convs = saved(
        convs.withColumn("n", F.col("used") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie"
    )
    opening = numbered.where(f"conv_id % {every} = 0 and pos <= {most}").select(
        F.col("conv_id").alias("base"), "pos", "digest", "chars"
    )
    # At most `most` turns meet at most `every` conversations.
    taken = convs.join(opening, "base").where("pos <= h").select("conv_id", "pos", "digest", "chars")
    # Two written tables, so that a hot conversation's rows can be split.
    shift = convs.select("conv_id", (F.col("used") - F.col("h")).alias("shift"))
    rest = (
        numbered.where(F.col("pos") > h)
        .join(shift, "conv_id")
        .select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "chars")
    )
    return taken.unionByName(rest), convs.select("conv_id", "n")


def _xor(left: Column, right: Column) -> Column:
    return left.bitwiseXOR(right)


def prefixes(turns: DataFrame) -> DataFrame:
    """For every turn: conv_id, depth, chars, and the sums p1, p2 of the conversation up to it
    and q1, q2 of the conversation before it."""
    lanes = turns.select(
        "conv_id",
        "pos",
        "chars",
        F.expr(f"(pos - 1) div {BLOCK}").alias("block"),
        F.xxhash64(F.col("digest"), F.col("pos")).alias("l1"),
        F.xxhash64(F.col("pos"), F.col("digest"), F.lit("second")).alias("l2"),
    )
    lanes = saved(lanes, "trie")
    blocks = lanes.groupBy("conv_id", "block").agg(F.bit_xor("l1").alias("b1"), F.bit_xor("l2").alias("b2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select(
        "conv_id",
        "block",
        *[F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"base{i}") for i in (1, 2)],
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = lanes.select("*", *[F.bit_xor(f"l{i}").over(inside).alias(f"s{i}") for i in (1, 2)])
    done = summed.join(bases, ["conv_id", "block"])
    p = [_xor(F.col(f"s{i}"), F.col(f"base{i}")) for i in (1, 2)]
    return done.select(
        "conv_id",
        F.col("pos").alias("depth"),
        "chars",
        p[0].alias("p1"),
        p[1].alias("p2"),
        _xor(p[0], F.col("l1")).alias("q1"),
        _xor(p[1], F.col("l2")).alias("q2"),
    )


def id_list_digests(members: DataFrame) -> DataFrame:
    """p1, p2 and the SHA-256 of the ascending, comma-joined conv_ids of each (p1, p2).

    A list may hold a third of all ids. It is cut into blocks, and where a list has several, one
    task reads them in order, a block at a time: a hash of this kind can only be computed from
    front to back, and never needs more than the block at hand.
    """
    small_batches(members.sparkSession)
    laid = _in_order(members.select("p1", "p2", "conv_id"), "p1", "p2", "conv_id")
    blocks = saved(
        laid.groupBy("p1", "p2", F.expr(f"seq div {BLOCK}").alias("block"))
        .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .select("p1", "p2", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text")),
        "trie",
    )
    counts = blocks.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_blocks"))
    with_counts = saved(blocks.join(counts, ["p1", "p2"]), "trie")
    short = with_counts.where("n_blocks = 1").select("p1", "p2", F.sha2("text", 256).alias("ends_sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None

        def row(key, done):
            return pa.RecordBatch.from_pydict(
                {"p1": pa.array([key[0]], pa.int64()), "p2": pa.array([key[1]], pa.int64()),
                 "ends_sha256": [done.hexdigest()]}
            )

        for batch in batches:
            for p1, p2, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if at != (p1, p2):
                    if at is not None:
                        yield row(at, running)
                    at, running = (p1, p2), hashlib.sha256(text.encode())
                else:
                    running.update(b"," + text.encode())
        if at is not None:
            yield row(at, running)

    long = (
        with_counts.where("n_blocks > 1")
        .repartition(_parts(members), "p1", "p2")
        .sortWithinPartitions("p1", "p2", "block")
        .select("p1", "p2", "text")
        .mapInArrow(digest, "p1 long, p2 long, ends_sha256 string")
    )
    return short.unionByName(long)


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns, and the root.

    turns: conv_id, pos (from 1, gapless), digest, chars; conversations: conv_id, n (its number
    of turns, 0 allowed). Returns conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Without conversations there is no root.
    """
    paths = saved(prefixes(turns), "trie")
    known = paths.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"),
        F.max("q1").alias("q1"),
        F.max("q2").alias("q2"),
    )
    known = saved(known.withColumn("node", F.monotonically_increasing_id()), "trie")
    top = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    if not top["n_convs"]:
        return _result(known.withColumns({"parent_conv_id": F.lit(0), "n_children": F.lit(0), "n_leaves": F.lit(0),
                                          "saved_tokens": F.lit(0), "ends_sha256": F.lit("")}).limit(0))
    spark = turns.sparkSession
    root = spark.createDataFrame(
        [(0, 0, 0, top["conv_id"], top["n_convs"], 0, ROOT, None, None)],
        "depth long, p1 long, p2 long, conv_id long, n_convs long, chars long, node long, parent long, parent_conv_id long",
    )
    # The root may have any number of children; they need no join to know it.
    columns = root.columns
    first = known.where("depth = 1").withColumns(
        {"parent": F.lit(ROOT).cast("long"), "parent_conv_id": F.lit(top["conv_id"]).cast("long")}
    )
    above = known.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    # Two written tables: a parent with a great part of all nodes as children can be split.
    deeper = known.where("depth > 1").join(above, ["depth", "q1", "q2"])
    linked = saved(
        root.unionByName(first.select(*columns)).unionByName(deeper.select(*columns)), "trie"
    )
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = saved(
        linked.join(children, "node", "left").select(
            *columns,
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "trie",
    )
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"])
    ends = (
        conversations.where("n > 0")
        .join(paths.select("conv_id", F.col("depth").alias("n"), "p1", "p2"), ["conv_id", "n"])
        .select("p1", "p2", "conv_id")
        .unionByName(
            conversations.where("n = 0").select(
                F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), "conv_id"
            )
        )
    )
    return _result(
        nodes.drop("n_leaves", "saved_tokens")
        .join(totals, "node")
        .join(id_list_digests(ends), ["p1", "p2"], "left")
    )


def _result(nodes: DataFrame) -> DataFrame:
    whole = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return nodes.select(
        *[F.col(name).cast("long").alias(name) for name in whole],
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text) as they stand."""
    numbered = saved(numbered_turns(conversations), "trie")
    return trie(numbered, numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations whose openings are shared (see `shared_openings`).

    Rows with a null conv_id are left out; the other rules for nulls, ties and repeated rows are
    those of `numbered_turns`. Texts of any length are known by their digest and length. An
    empty table gives no rows. Other columns are ignored.
    """
    turns, rebuilt = shared_openings(saved(numbered_turns(conversations), "trie"))
    return trie(turns, rebuilt)
