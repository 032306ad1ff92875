"""Contiguous shards of equal size in bytes.

Documents are laid out in ascending order of their id. Each partition of that order reports
its total size; prefix sums over the totals give every partition its base, and a running sum
inside the partition gives every document its byte offset. The shard is the equal-width
interval of the whole byte range that the middle of the document falls into, so shards are
contiguous and none is off its target by more than one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import running_bases, saved

#: Bytes a document takes besides its text.
ROW_BYTES = 8


def by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, offset, shard and slot of every row.

    A null text has no bytes (its checksum is that of the empty text). Rows with a null id
    come first. Repeated ids are ordered by checksum and size; rows equal in all three are
    interchangeable. An empty table gives an empty result. Other columns are ignored. Texts
    never leave the scan: only id, size and checksum are shuffled.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    key = ["doc_id", "text_crc32", "size"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = saved(
        narrow.repartitionByRange(parts, *key).withColumn("part", F.spark_partition_id()),
        "shards",
    )
    totals = laid.groupBy("part").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    # One row for each partition, so the broadcast is bounded by their number.
    bases = running_bases(totals, "part", {"byte_base": "bytes", "row_base": "rows"})
    all_bytes = totals.agg(F.sum("bytes")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy(*key)
    placed = (
        laid.join(F.broadcast(bases), "part")
        .select(
            *key,
            (
                F.col("byte_base") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                - F.col("size")
            ).alias("offset"),
            (F.col("row_base") + F.row_number().over(inside) - 1).alias("row"),
        )
        # Twice the middle of the document, so that halves stay integers.
        .withColumn(
            "shard",
            F.expr(f"cast((2 * offset + size) * {int(shards)} div {2 * all_bytes} as int)"),
        )
    )
    placed = saved(placed, "shards")
    # As many rows as there are shards.
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "offset",
        "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"),
    )
