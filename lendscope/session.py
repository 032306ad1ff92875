"""Session settings the operators are written for."""

from __future__ import annotations

import pathlib
import zipfile

from pyspark.sql import SparkSession

# A row-level lookup against a one-row-per-key table is the only place where one key's
# rows meet unreduced; adaptive execution splits such a key, also when that costs a
# further exchange.
# Generated methods above HotSpot's limit would run uncompiled; below it they are split.
# All of these can also be set in a session that is already running.
RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
SETTINGS = RUNTIME_SETTINGS
# What shuffles whole tables begins with so many partitions that one can be sorted in a task's
# memory; adaptive execution joins them up to its advisory size. With as few as there are cores, a
# task's share grows with the input until joins and aggregates spill all of it.
# The same holds for what a task reads: a narrow table has 18 million rows in 128 MB of its files.
SHUFFLE_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.files.maxPartitionBytes": "8m",
}


def build_session(
    app_name: str, master: str | None = None, shuffle_partitions: int | None = None, **extra: str
) -> SparkSession:
    """Session for a job. On a cluster leave master and shuffle_partitions to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", "8g")
    settings = SETTINGS
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        settings = settings | SHUFFLE_SETTINGS
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once for each application.

    A no-op for jobs without Python code on the executors, who need not call it.
    """
    context = spark.sparkContext
    name = f"lendscope-{context.applicationId}.zip"
    if any(path.endswith(name) for path in context._python_includes):
        return
    package = pathlib.Path(__file__).parent
    archive = pathlib.Path(context._temp_dir, name)
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
