"""Tables in key order: written as files that follow each other, and checked from the files.

``write_ordered`` deals rows in ranges of the key and sorts each range, so file n holds
only keys before those of file n + 1. No task sorts more than its range. ``read_ordered``
gives each row its place in that order from the file's number and the row's place in the
file, without sorting again; ``order_check`` proves it file by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def in_order(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    """Rows in ranges of ``keys``, each range sorted; nulls first. Without ``files`` the
    number of ranges follows the measured size of the data."""

    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def write_ordered(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Parquet files in key order; their names rise with the keys."""

    in_order(df, keys, files).write.mode("overwrite").parquet(path)


def _numbered(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their file and place in it, and one row for each file with the rows before it."""

    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    by_name = Window.orderBy("_file")  # a row for each file
    files = files.select(
        "_file",
        "_rows",
        (F.row_number().over(by_name) - 1).alias("_file_no"),
        (F.sum("_rows").over(by_name) - F.col("_rows")).alias("_before"),
    )
    return rows, files


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The table with each row's place in key order (from 1)."""

    rows, files = _numbered(spark, path)
    out = rows.join(files, "_file").withColumn(position, F.col("_before") + F.col("_row") + 1)
    return out.drop("_file", "_row", "_rows", "_file_no", "_before")


def order_check(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Per file: file_no, file, rows, whether its rows rise by ``keys``, and whether all its
    keys come after those of the file before."""

    rows, files = _numbered(spark, path)
    key: Column = F.struct(*keys)
    before = F.lag(key).over(Window.partitionBy("_file").orderBy("_row"))
    per_file = rows.withColumn("_key", key).withColumn("_prior", before).groupBy("_file").agg(
        F.coalesce(F.bool_and(F.col("_prior") <= F.col("_key")), F.lit(True)).alias("rows_in_order"),
        F.min("_key").alias("first"),
        F.max("_key").alias("last"),
    )
    joined = per_file.join(files, "_file")
    prior = F.lag("last").over(Window.orderBy("_file_no"))  # a row for each file
    return joined.select(
        F.col("_file_no").alias("file_no"),
        F.col("_file").alias("file"),
        F.col("_rows").alias("rows"),
        "rows_in_order",
        F.coalesce(prior < F.col("first"), F.lit(True)).alias("after_previous"),
    )
