"""Connected components of a graph of links, as Spark jobs.

Alternating star contraction. A large star hands the smallest neighbour of a node to all
larger neighbours; a small star hands it to all smaller ones. Both keep components, and they
end in stars whose centre is the smallest member. Every step is written to the shared folder,
and nothing of the graph comes to the driver but one checksum for each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import gathered, saved


def _checksum(edges: DataFrame) -> tuple:
    parts = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(parts % 1_000_003), F.sum(F.shiftright(parts, 20) % 1_000_033)
        ).first()
    )


def _smallest(edges: DataFrame, rows: int) -> DataFrame:
    """Smallest neighbour of each u. Written, so that the join that follows reads two plain
    shuffles and a hub's rows can be split."""
    return saved(gathered(edges.groupBy("u").agg(F.min("v").alias("m")), rows), "stars")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both, 2 * rows)
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Edges run from the larger node u to the smaller node v."""
    least = _smallest(edges, rows)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """node, component for every node of `links` (columns a, b of type long).

    component is the smallest node reachable. Loops (a = b) and nulls are ignored, links may
    repeat and run in either direction. No links give no rows. `rows` says how many links there
    are at most, where that is known; no step makes more edges than it was given.
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = saved(edges if rows is None else gathered(edges, rows), "stars")
    before = _checksum(edges)
    while before[0]:
        rows = before[0]
        moved = saved(gathered(_large_star(edges, rows), rows), "stars")
        edges = saved(gathered(_small_star(moved, rows), rows), "stars")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return gathered(members.unionAll(centres), 2 * before[0])
