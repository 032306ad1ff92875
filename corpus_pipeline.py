"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of `docs` as they are,
also columns that are not part of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import decontaminate, ngram_join, packing, quality
from lendscope.llm.common import saved, small_table, table, text_hash
from lendscope.llm.queries import tokenizer_path

#: Near copies: words of a shingle and similarity in per cent.
WORDS, PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Without labels nothing is rejected.

    The classifier learns from the documents of this stage's input; rows with a null or empty
    text are scored like any other.
    """
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: of the texts with the smallest id.

    Texts that share an id are judged one by one. Rows without words belong to no group and
    stay. Rows with a null id stay. Rows that repeat an id and a text count once.
    """
    gone = ngram_join.copies(docs, WORDS, PERCENT).select(
        F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")
    )
    gone = small_table(saved(gone, "copies"))
    same_row = (docs["doc_id"] == gone["_gone"]) & (text_hash(docs["text"]) == gone["_hash"])
    kept = docs.join(gone, same_row, "left_anti")
    repeated = saved(
        docs.where("doc_id is not null")
        .groupBy(F.col("doc_id").alias("_again"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select("_again"),
        "copies",
    )
    if repeated.isEmpty():
        return kept
    again = small_table(repeated)
    same = kept["doc_id"] == again["_again"]
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same, "left_anti").unionByName(once)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also none with other values. Rows with a null id
    or text hold none; texts that share an id are judged one by one."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.drop_leaks(docs, leaks)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batches of all documents that are left (see `packing.pack`)."""
    return packing.pack(packing.lengths(docs, tokenizer_path()))


STAGES = [
    ("quality", good_quality),
    ("near copies", one_of_each_group),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: A fitted classifier, tokenizer ids and a dynamic program have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
