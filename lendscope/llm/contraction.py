"""Sums over subtrees by parallel tree contraction, as Spark joins.

A forest shrinks in rounds, and no round looks further than one edge:

* rake: every leaf is done (its total is what it has gathered) and hands its total to its parent;
* compress: in chains of nodes with one child, those that outrank both their parent and their
  child by a hash of the round are taken out, and the child hangs on to the grandparent. No two
  neighbours are taken out at once.

A tree of n nodes is gone after O(log n) rounds, whatever its depth. A node that was taken out
remembers the child it stood above and what to add to that child's total; following those notes
by pointer doubling gives the totals of all such nodes.

A parent may have any number of children: they are summed before they are shuffled. All joins
are one to one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import saved


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _followed(notes: DataFrame, values: Sequence[str]) -> DataFrame:
    """Notes (node, next, add_*) with next moved on until it has no note of its own."""
    while True:
        ahead = notes.select(
            F.col("node").alias("_at"),
            F.col("next").alias("_next"),
            *[F.col(f"add_{v}").alias(f"_add_{v}") for v in values],
        )
        moved = saved(
            notes.join(ahead, F.col("next") == F.col("_at"), "left").select(
                "node",
                F.coalesce("_next", "next").alias("next"),
                *[(F.col(f"add_{v}") + F.coalesce(f"_add_{v}", F.lit(0))).alias(f"add_{v}") for v in values],
                F.col("_at").isNotNull().alias("_moved"),
            ),
            "contraction",
        )
        notes = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return notes


def subtree_totals(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """node and each value summed over the node and all below it.

    `tree` has one row for each node: node (long, unique, not null), parent (long, null for a
    root; any number of roots) and the value columns (long, not null). Other columns are ignored.
    An empty forest gives no rows. A parent that is no node, or a cycle, stops the job.
    """
    values = list(values)
    n_children = tree.where("parent is not null").groupBy(F.col("parent").alias("_of")).agg(
        F.count(F.lit(1)).alias("n")
    )
    live = saved(
        tree.select("node", "parent", *[F.col(v).cast("long").alias(f"acc_{v}") for v in values])
        .join(n_children, F.col("node") == F.col("_of"), "left")
        .select(
            "node",
            "parent",
            F.coalesce("n", F.lit(0)).alias("n"),
            *[f"acc_{v}" for v in values],
            *[F.lit(0).cast("long").alias(f"up_{v}") for v in values],
        ),
        "contraction",
    )
    done: list[DataFrame] = []
    notes: list[DataFrame] = []
    left = live.count()
    round_no = 0
    while left:
        done.append(
            live.where("n = 0").select("node", *[F.col(f"acc_{v}").alias(v) for v in values])
        )
        # Rake. `only` is the one child left where one child is left.
        leaf = F.col("n") == 0
        handed = (
            live.where("parent is not null")
            .groupBy(F.col("parent").alias("_of"))
            .agg(
                F.count_if(~leaf).alias("rest"),
                F.min(F.when(~leaf, F.col("node"))).alias("only"),
                *[
                    F.sum(F.when(leaf, F.col(f"acc_{v}") + F.col(f"up_{v}")).otherwise(F.lit(0))).alias(f"add_{v}")
                    for v in values
                ],
            )
        )
        inner = live.where("n > 0").join(handed, F.col("node") == F.col("_of")).select(
            "node",
            "parent",
            F.col("rest").alias("n"),
            "only",
            *[(F.col(f"acc_{v}") + F.col(f"add_{v}")).alias(f"acc_{v}") for v in values],
            *[f"up_{v}" for v in values],
        )
        rank = lambda name: F.xxhash64(F.col(name), F.lit(round_no))  # noqa: E731, B023
        taken_out = (
            F.col("parent").isNotNull()
            & (F.col("n") == 1)
            & (rank("node") > rank("parent"))
            & (rank("node") > rank("only"))
        )
        inner = saved(inner.withColumn("out", F.coalesce(taken_out, F.lit(False))), "contraction")
        # Compress: the child of a node that is taken out meets that node's parent.
        above = inner.where("out").select(
            F.col("node").alias("via"),
            F.col("parent").alias("_parent"),
            *[F.col(f"acc_{v}").alias(f"_acc_{v}") for v in values],
            *[F.col(f"up_{v}").alias(f"_up_{v}") for v in values],
        )
        moved = saved(
            inner.where("not out")
            .join(above, F.col("parent") == F.col("via"), "left")
            .select(
                "node",
                F.when(F.col("via").isNotNull(), F.col("_parent")).otherwise(F.col("parent")).alias("parent"),
                "n",
                *[f"acc_{v}" for v in values],
                *[
                    (
                        F.col(f"up_{v}")
                        + F.coalesce(F.col(f"_acc_{v}") + F.col(f"_up_{v}"), F.lit(0))
                    ).alias(f"up_{v}")
                    for v in values
                ],
                "via",
                *[(F.col(f"_acc_{v}") + F.col(f"up_{v}")).alias(f"add_{v}") for v in values],
            ),
            "contraction",
        )
        notes.append(
            moved.where("via is not null").select(
                F.col("via").alias("node"), F.col("node").alias("next"), *[f"add_{v}" for v in values]
            )
        )
        live = moved.drop("via", *[f"add_{v}" for v in values])
        round_no, before, left = round_no + 1, left, live.count()
        # Every round rakes at least one leaf of every tree.
        if left == before:
            raise ValueError("the links from nodes to their parents form a cycle")
    if not done:
        return tree.select("node", *[F.col(v).cast("long").alias(v) for v in values])
    finished = saved(_union(done), "contraction")
    chained = _followed(saved(_union(notes), "contraction"), values)
    ends = finished.select(F.col("node").alias("next"), *[F.col(v).alias(f"_{v}") for v in values])
    expanded = chained.join(ends, "next").select(
        "node", *[(F.col(f"add_{v}") + F.col(f"_{v}")).alias(v) for v in values]
    )
    return finished.unionByName(expanded)
