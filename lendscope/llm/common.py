"""What the operators share: tables, intermediate results, ranks and prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.session import ship_package
from lendscope.sources.scratch import scratch_folder

#: Rows up to which a table of ids or keys is broadcast.
BROADCAST_ROWS = 1_000_000
#: Rows of ids, keys or links for which a task of its own is worth while; of whole sets, far fewer.
TASK_ROWS, TASK_SETS = 200_000, 10_000
#: Rows and bytes of one Arrow batch; texts may be long.
BATCH_ROWS, BATCH_BYTES = 4_000, 16 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts lineage: a lost executor costs a reread and never another run of what came before.
    """
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A saved table of ids or keys, broadcast if it is small; beyond that, joins with it
    shuffle both sides. Its rows decide: Spark would go by the size of its files, and a column of
    equal values or of runs takes next to nothing there."""
    return F.broadcast(df) if df.count() <= rows else df.hint("merge")


def text_hash(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(text.cast("string"))


def spread(df: DataFrame) -> DataFrame:
    """The rows over at least as many tasks as there are cores; a table of one row group
    would otherwise be one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def gathered(df: DataFrame, rows: int, per_task: int = TASK_ROWS) -> DataFrame:
    """`df`, of at most so many rows, in no more tasks than they and the cores need.

    The partitions of a shuffle can be many more, where adaptive execution does not join them,
    and each costs a task and a file. Nothing is dealt anew; all cores have work as before.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // per_task)))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Keep Arrow batches of whole texts small, and let the workers import this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def running_bases(totals: DataFrame, part: str, sums: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """For each part (in order, within each group of `by`) the sums of all parts before it.

    `totals` has one row for each part and group: it is bounded by their number, not by the
    rows they stand for.
    """
    before = (
        Window.partitionBy(*(by or []))
        .orderBy(part)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = [
        F.coalesce(F.sum(column).over(before), F.lit(0)).cast("long").alias(base)
        for base, column in sums.items()
    ]
    return totals.select(*(by or []), part, *bases)
