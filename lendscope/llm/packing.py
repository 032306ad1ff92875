"""Packing into length buckets with the least padding.

The encoded lengths of all documents make one histogram. A dynamic program over it chooses
the bucket boundaries that minimise padding (every sequence is padded to its bucket's
boundary). Inside each bucket, batches hold as many sequences as the token budget allows.
A document longer than the context is cut into pieces, so nothing is dropped or truncated,
and the histogram has at most as many entries as the context has tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import running_bases, saved, small_batches, spread
from lendscope.llm.word_ids import encoder, slices

#: Longest sequence, number of buckets, and tokens (padding included) of one batch.
CONTEXT, BUCKETS, BATCH_TOKENS = 4096, 12, 65_536
#: Parts that ranks inside a bucket are taken in, for each shuffle partition.
BLOCKS_PER_PARTITION = 1


def lengths(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, length in tokens of every row; a null text has none."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for start, some in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, len(some)), pa.array(encoder(tokenizer_path).counts(some))],
                    names=["doc_id", "length"],
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("words")
    )
    return spread(rows).mapInArrow(count, "doc_id long, length long")


def pieces(measured: DataFrame, context: int = CONTEXT) -> DataFrame:
    """doc_id, piece, start, length: runs of at most `context` tokens that cover each document.

    An empty document is one piece of length 0.
    """
    whole = F.greatest(F.ceil(F.col("length") / context), F.lit(1)).cast("long")
    return measured.select(
        "doc_id", F.explode(F.sequence(F.lit(0), whole - 1)).alias("piece"), F.col("length").alias("all")
    ).select(
        "doc_id",
        F.col("piece").cast("long").alias("piece"),
        (F.col("piece") * context).cast("long").alias("start"),
        F.least(F.lit(context), F.col("all") - F.col("piece") * context).cast("long").alias("length"),
    )


def best_boundaries(length: np.ndarray, count: np.ndarray, buckets: int) -> list[int]:
    """Boundaries, ascending, that minimise the padded total of a histogram.

    cost[k][j] is the least padded size of the j shortest lengths in k buckets. The last
    bucket takes lengths i..j-1 and pads each to length[j-1].
    """
    order = np.argsort(length)
    length, count = np.asarray(length, np.int64)[order], np.asarray(count, np.int64)[order]
    n = len(length)
    if not n:
        return []
    below = np.concatenate([[0], np.cumsum(count)])
    cost = np.concatenate([[0], length * below[1:]]).astype(np.float64)
    choice = []
    for _ in range(1, min(buckets, n)):
        new, came = cost.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            options = cost[:j] + length[j - 1] * (below[j] - below[:j])
            came[j] = int(np.argmin(options))
            new[j] = options[came[j]]
        choice.append(came)
        cost = new
    cuts, j = [], n
    for came in reversed(choice):
        cuts.append(int(length[j - 1]))
        j = int(came[j])
        if j == 0:
            break
    if j:
        cuts.append(int(length[j - 1]))
    return sorted(set(cuts))


def pack(
    measured: DataFrame,
    context: int = CONTEXT,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Batches of every piece of every document: doc_id, piece, start, length, bucket (from 0),
    padded_length, batch (gapless from 0 inside a bucket) and slot (inside the batch).

    `measured` has doc_id and length. Rows with equal or null ids are kept as they are; an
    empty table gives an empty result. Sequences of one bucket are ordered by a hash of their
    id, so a batch does not hold one source only.
    """
    if batch_tokens < context:
        raise ValueError("a batch must hold a sequence of full context")
    spark = measured.sparkSession
    blocks = BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = saved(pieces(measured, context), "packing")
    # At most context + 1 rows, whatever the table holds.
    counted = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    bounds = best_boundaries(
        np.array([r["length"] for r in counted]), np.array([r["n"] for r in counted]), buckets
    )
    bucket, padded = F.lit(0), F.lit(0).cast("long")
    for i, bound in reversed(list(enumerate(bounds))):
        bucket = F.when(F.col("length") <= bound, F.lit(i)).otherwise(bucket)
        padded = F.when(F.col("length") <= bound, F.lit(bound).cast("long")).otherwise(padded)
    placed = cut.select(
        "*",
        bucket.cast("int").alias("bucket"),
        padded.alias("padded_length"),
        F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)).cast("int").alias("block"),
    )
    # A bucket may hold most of the rows: ranks are taken inside its blocks and shifted.
    totals = placed.groupBy("bucket", "block").agg(F.count(F.lit(1)).alias("n"))
    bases = running_bases(totals, "block", {"base": "n"}, ["bucket"])
    inside = Window.partitionBy("bucket", "block").orderBy(
        F.xxhash64("doc_id"), "doc_id", "piece", "length"
    )
    per_batch = F.greatest(F.floor(F.lit(batch_tokens) / F.greatest("padded_length", F.lit(1))), F.lit(1))
    rank = F.row_number().over(inside) - 1 + F.col("base")
    return (
        placed.join(F.broadcast(bases), ["bucket", "block"])
        .select("doc_id", "piece", "start", "length", "bucket", "padded_length", rank.alias("rank"), per_batch.alias("cap"))
        .select(
            "doc_id", "piece", "start", "length", "bucket", "padded_length",
            F.floor(F.col("rank") / F.col("cap")).cast("long").alias("batch"),
            F.pmod(F.col("rank"), F.col("cap")).cast("int").alias("slot"),
        )
    )
