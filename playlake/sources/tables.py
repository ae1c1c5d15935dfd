"""Readers for the input tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters applied later are pushed
    into the scan by Catalyst (see ``ReadSchema`` / ``PushedFilters``)."""

    return spark.read.parquet(table_path(sf_dir, name))


#: Rows that one task of per-row CPU work (JSON, contract) takes, about.
ROWS_PER_TASK = 100_000


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out for per-row CPU work (JSON, contract): a task for each ``ROWS_PER_TASK``
    of them, and at least one per core.

    Spark plans Parquet splits by bytes, but a row group is read by one task whatever splits
    it covers, so neither the file's size nor the number of splits says how many rows a task
    will get. The number of rows comes from the footers. Rows are dealt by a hash of the
    whole row: the same after a task retry, and unlike a round-robin exchange without a sort
    of all that a task has read.
    """

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(tasks, *[F.col(f"`{c}`") for c in df.columns])
