"""Stored Silver and marts that the registered reports read.

Reports run over stored tables, not over the events: Silver, ``content_daily`` and
``platform_hourly`` are written once for each input, partitioned by ``event_date``, so a
report on some days reads those folders only. The tables stand in the shared checkpoint
folder. They are built for one application and one state of the input (path, bytes, time of
change), and built anew for any other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.operators import marts
from playlake.session import file_system, scratch_path
from playlake.sources.tables import table_path

_BUILT: dict[tuple, str] = {}


def write_by_day(df: DataFrame, path: str, day: str = "event_date") -> None:
    """Write a table partitioned by day. ``rebalance`` gathers a day's rows, and splits a day
    or joins small ones by measured size, so files are neither many nor huge."""

    df.hint("rebalance", day).write.partitionBy(day).parquet(path)


def _state(spark: SparkSession, path: str) -> tuple[int, int]:
    fs, where = file_system(spark, path)
    return fs.getContentSummary(where).getLength(), fs.getFileStatus(where).getModificationTime()


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table ``name`` of an input; ``build`` gives its rows if it is not there yet."""

    key = (spark.sparkContext.applicationId, sf_dir, name, _state(spark, table_path(sf_dir, "events")))
    if key not in _BUILT:
        path = scratch_path(spark, f"lake-{name}-{uuid.uuid4().hex[:12]}")
        write_by_day(build(), path)
        _BUILT[key] = path
    return spark.read.parquet(_BUILT[key])


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playlake.plans import catalog

    return stored(spark, sf_dir, "silver", lambda: catalog.silver_plan(spark, sf_dir))


def content_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "content_daily", lambda: marts.content_daily(silver(spark, sf_dir)))


def platform_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``event_date``, the day of ``window_start``."""

    def build() -> DataFrame:
        return marts.platform_hourly(silver(spark, sf_dir)).withColumn("event_date", F.to_date("window_start"))

    return stored(spark, sf_dir, "platform_hourly", build)
