"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. They are applied only where the session does
# not already carry a value, so a cluster's spark-submit configuration wins.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Python's json decoder keeps the last of repeated keys; so do we.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Large state (dedupe ids within the watermark horizon) lives in RocksDB
    # off the JVM heap; commits write a change log instead of a snapshot of
    # every partition each micro-batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


# Runtime settings the results depend on (not tuning): UTC days and hours,
# and the last of repeated JSON keys wins, as in Python's decoder.
SEMANTIC_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def ensure_semantics(spark: SparkSession) -> SparkSession:
    """Set the settings results depend on, on a session built elsewhere."""

    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def delta_conf() -> dict[str, str]:
    """Extension and catalog of Delta tables, where the connector is installed; without them a
    Delta table can neither be merged into nor created by name."""

    if find_spec("delta") is None:
        return {}
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }


def build_session(
    app_name: str = "playlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session or build one with the playlake defaults.

    ``master`` is only set when given (tests pass ``local[*]``); on a cluster
    the launcher decides. Runtime SQL settings are applied to an existing
    session as well, but never overwrite a value the user already set.
    """

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**SESSION_DEFAULTS, **delta_conf()}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if key.startswith("spark.sql.") and not _is_set(spark, key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_set(spark: SparkSession, key: str) -> bool:
    try:
        return spark.conf.get(key, None) is not None
    except Exception:  # pragma: no cover - static conf lookups
        return True


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``. Only when it is unset and Spark runs
    in local mode (tests, laptops) is a fresh scratch folder created and set;
    on a cluster an unset value is an error, because a machine-local folder is
    not visible to other executors and does not survive their loss.
    """

    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ABFS, GCS) that every executor can reach"
        )
    root = tempfile.mkdtemp(prefix="playlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""

    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written intermediate."""

    return f"{checkpoint_root(spark)}/{name}"


def materialize(df, name: str, partition_by: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return the table read back.

    Used where one derived frame (e.g. Silver) feeds several branches of a
    plan: each branch then scans the stored columns it needs instead of
    recomputing the upstream work, and the lineage is cut, so a lost
    executor re-reads the table rather than replaying the parse. Each call
    writes a fresh folder (concurrent callers never share one).
    """

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared checkpoint folder and read back, for as long as the block
    runs: for a frame that several actions read and nobody needs afterwards."""

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)
