"""Small files and folders on whatever file system a path lies on, through Hadoop's client."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    location = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, location, location.getFileSystem(conf)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, None if there is none."""
    jvm, _, location, fs = _hadoop(spark, path)
    if not fs.exists(location):
        return None
    stream = fs.open(location)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    _, _, location, fs = _hadoop(spark, folder)
    if not fs.exists(location):
        return []
    return [status.getPath().getName() for status in fs.listStatus(location)]


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet, whole or not at all. False if another was first.

    The text is written beside the file and renamed without overwriting, which is one step on
    HDFS-like stores.
    """
    jvm, conf, location, fs = _hadoop(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(location.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    none[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(location.toUri(), conf)
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(location), none)
    except Exception:
        fs.delete(beside, False)
        if fs.exists(location):
            return False
        raise
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    _, _, location, fs = _hadoop(spark, path)
    fs.delete(location, True)
