"""Exact length histogram of encoded documents, and what suffix sums over it answer.

Every batch of documents is counted by encoded length before anything is shuffled, so only
(length, count) pairs travel. Suffix sums over the histogram give, for every context limit,
how many documents reach it, how many tokens they hold, and how many are left after truncation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import saved, small_batches, spread
from lendscope.llm.word_ids import encoder, slices

#: Lengths that share one block of the two-level sums.
BLOCK = 1024


def histogram(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """length, n_docs. A null text counts as empty (length 0); no row is left out."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(0).to_pylist()):
                length, n = np.unique(encoder(tokenizer_path).counts(texts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"length": length, "n": n.astype(np.int64)})

    partial = spread(docs.select(F.col(text_col).cast("string"))).mapInArrow(
        count, "length long, n long"
    )
    return partial.groupBy("length").agg(F.sum("n").alias("n_docs"))


def context_table(counts: DataFrame) -> DataFrame:
    """For each length that occurs, taken as a context limit, over all documents:

    n_docs of exactly this length, docs_at_least and tokens_at_least (suffix sums),
    docs_within (at most this length), tokens_truncated (sum of min(length, limit)), and the
    totals. Sums run in two levels, inside blocks of lengths and over the blocks. An empty
    table gives no rows.
    """
    # Read once more from the shared folder: the sums use it three times.
    counts = saved(
        counts.select(
            "length",
            "n_docs",
            (F.col("length") * F.col("n_docs")).alias("n_tokens"),
            F.floor(F.col("length") / BLOCK).cast("long").alias("block"),
        ),
        "lengths",
    )
    blocks = counts.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("n_tokens").alias("block_tokens")
    )
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("docs_base"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("tokens_base"),
    )
    total_docs, total_tokens = blocks.agg(F.sum("block_docs"), F.sum("block_tokens")).first()
    inside = (
        Window.partitionBy("block")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counts.join(bases, "block")
        .select(
            "length",
            "n_docs",
            (F.sum("n_docs").over(inside) + F.col("docs_base")).alias("docs_at_least"),
            (F.sum("n_tokens").over(inside) + F.col("tokens_base")).alias("tokens_at_least"),
            F.lit(total_docs).cast("long").alias("total_docs"),
            F.lit(total_tokens).cast("long").alias("total_tokens"),
        )
        .select(
            "*",
            (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_within"),
            (
                F.col("total_tokens")
                - F.col("tokens_at_least")
                + F.col("docs_at_least") * F.col("length")
            ).alias("tokens_truncated"),
        )
    )


def at_limits(contexts: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_over and tokens_truncated for any limits, from the nearest longer length."""
    spark = contexts.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    # `limits` is an argument of the caller, not data.
    longer = contexts.join(F.broadcast(wanted), F.col("length") > F.col("limit"))
    found = longer.groupBy("limit").agg(
        F.min_by(
            F.struct("docs_at_least", "tokens_at_least", "total_tokens"), "length"
        ).alias("next")
    )
    all_tokens = contexts.agg(F.max("total_tokens")).first()[0] or 0
    return (
        wanted.join(found, "limit", "left")
        .select(
            "limit",
            F.coalesce("next.docs_at_least", F.lit(0)).alias("docs_over"),
            (
                F.lit(all_tokens)
                - F.coalesce("next.tokens_at_least", F.lit(0))
                + F.coalesce("next.docs_at_least", F.lit(0)) * F.col("limit")
            ).alias("tokens_truncated"),
        )
    )


def quantiles(contexts: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the smallest length that at least this share of documents stays within."""
    wanted = contexts.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    reached = contexts.join(
        F.broadcast(wanted), F.col("docs_within") >= F.col("share") * F.col("total_docs")
    )
    return reached.groupBy("share").agg(F.min("length").alias("length"))
