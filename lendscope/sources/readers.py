"""Source files as DataFrames whose every column is text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_text(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, all text; an empty field is NULL, quoted or not.

    Without a schema the column names come from the header line and nothing is
    inferred. A row that does not fit the header stops the load. `multi_line` takes line
    breaks inside quotes; such a file cannot be split among tasks, so it is off by default.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
    )
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def write_sorted(df: DataFrame, path: str) -> None:
    """Parquet in the order of all columns, so equal content reads back equally.

    The row id only breaks ties: without it copies of one row could not be spread over
    several range partitions.
    """
    from pyspark.sql import functions as F

    order = [F.col(name) for name in df.columns] + [F.monotonically_increasing_id()]
    df.orderBy(*order).write.mode("error").option("compression", "zstd").parquet(path)
