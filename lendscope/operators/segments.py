"""Windows over groups of any size: a scan in segments.

A window function gathers a group in one task. Here rows are dealt out by ranges of (group,
order), so a group that holds a great part of them lies in several partitions; each partition
computes its own part, and what passes over a boundary is carried by a table with a few rows for
each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.sources.scratch import written


class Segments:
    """Rows sorted by group and order over range partitions, written once and read by each scan.

    `group` names columns; `order` are columns or sort orders. Rows that are equal in all of them
    are in no particular order. Groups with NULLs are groups.
    """

    SEQ, PART = "_seq", "_part"

    def __init__(self, rows: DataFrame, group: Sequence[str], order: Sequence[Column | str]):
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keys = [*group, *order]
        laid = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
        laid = written(laid.withColumn(self.SEQ, F.monotonically_increasing_id()), "segments")
        self.group = list(group)
        # The upper bits of the number are the partition.
        self.rows = laid.withColumn(self.PART, F.shiftright(self.SEQ, 33))
        ends = self.rows.groupBy(self.PART).agg(F.min(self.SEQ).alias("_first"), F.max(self.SEQ).alias("_last"))
        self.ends = written(ends, "segments")

    def _neighbour(self, value: Column, back: bool) -> Column | DataFrame:
        """The rows with `_near` (a struct, so that a NULL value is not a missing row)."""
        inside = Window.partitionBy(self.PART, *self.group).orderBy(self.SEQ)
        step = F.lag if back else F.lead
        near = step(F.struct(value.alias("v"))).over(inside)
        # One row for each partition: the row next to its boundary, handed over to the next one.
        giver, taker = ("_last", "_first") if back else ("_first", "_last")
        edge = self.rows.join(F.broadcast(self.ends.select(F.col(giver).alias(self.SEQ))), self.SEQ)
        in_order = Window.partitionBy(F.lit(0)).orderBy(self.PART)
        handed = (
            edge.select(self.PART, F.struct(*self.group).alias("_of"), F.struct(value.alias("v")).alias("_v"))
            .withColumn("_of", step("_of").over(in_order))
            .withColumn("_v", step("_v").over(in_order))
            .join(F.broadcast(self.ends.select(self.PART, F.col(taker).alias(self.SEQ))), self.PART)
            .select(self.SEQ, "_of", "_v")
        )
        same = F.struct(*self.group).eqNullSafe(F.col("_of"))
        return (
            self.rows.withColumn("_near", near)
            .join(F.broadcast(handed), self.SEQ, "left")
            .withColumn("_near", F.coalesce("_near", F.when(same, F.col("_v"))))
            .drop("_of", "_v")
        )

    def lag(self, name: str, value: Column) -> DataFrame:
        """The rows with the value of the row before in the group, NULL for the first."""
        return self._plain(self._neighbour(value, True).withColumn(name, F.col("_near.v")))

    def lead(self, name: str, value: Column) -> DataFrame:
        """The rows with the value of the row behind in the group, NULL for the last."""
        return self._plain(self._neighbour(value, False).withColumn(name, F.col("_near.v")))

    def row_number(self, name: str) -> DataFrame:
        """The rows with their place in the group, from 1."""
        inside = Window.partitionBy(self.PART, *self.group).orderBy(self.SEQ)
        # Groups that touch a boundary: at most two for each partition.
        edges = self.ends.select(F.explode(F.array("_first", "_last")).alias(self.SEQ))
        touching = self.rows.join(F.broadcast(edges), self.SEQ).select(self.PART, *self.group).distinct()
        key = F.struct(self.PART, *self.group)
        counts = (
            self.rows.select(key.alias("_key"))
            .join(F.broadcast(touching.select(key.alias("_edge"))), F.col("_key").eqNullSafe(F.col("_edge")))
            .groupBy("_edge")
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        before = (
            Window.partitionBy(*[F.col(f"_edge.{g}") for g in self.group])
            .orderBy(F.col(f"_edge.{self.PART}"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = counts.select("_edge", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        numbered = self.rows.withColumn("_place", F.row_number().over(inside)).withColumn("_key", key)
        return self._plain(
            numbered.join(F.broadcast(carried), F.col("_key").eqNullSafe(F.col("_edge")), "left").withColumn(
                name, F.col("_place") + F.coalesce("_before", F.lit(0))
            )
        )

    def _plain(self, rows: DataFrame) -> DataFrame:
        return rows.drop(self.SEQ, self.PART, "_near", "_place", "_key", "_edge", "_before")
