"""Keyed upsert of mart rows (matched -> replace, unmatched -> insert).

Update-mode stream output carries the full new value of every group it
touches, so an upsert must *replace* the stored row, never add to it. Keys
compare null-safely (a NULL country is a key like any other), so replaying a
batch leaves the mart unchanged.

* ``upsert_frame``: the pure DataFrame form (anti join + union).
* ``merge_into_path``: the sink. With Delta on the classpath it runs a
  ``MERGE``; otherwise each batch writes new folders for the days that it touches
  (``event_date=D/version=V``) and then replaces one small pointer file, which
  names the valid version of each day, in one rename. A writer that dies before
  the rename leaves the old table, one that dies after it the new one; no row
  is ever without a valid copy. ``read_current`` reads by the pointer.

One writer at a time, as with a stream's sink.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.session import delete_path, file_system, written

#: Partition column of a day's versions, and the file that names the valid ones.
VERSION, POINTER = "version", "_current.json"


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def upsert_frame(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``updates``, plus ``updates``.

    The anti join shuffles both sides on the keys (or broadcasts the update
    keys when AQE measures them small); ``updates`` must hold one row per key.
    """

    upd_keys = updates.select(*keys)
    kept = target.join(upd_keys, _null_safe_on(target, upd_keys, keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns), allowMissingColumns=False)


def _delta_available() -> bool:
    try:
        import delta.tables  # noqa: F401
    except ImportError:
        return False
    return True


def merge_into_path(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    keys: list[str],
    partition_by: str,
    fmt: str = "parquet",
) -> None:
    """Upsert ``updates`` into the table at ``path`` (created when missing)."""

    if fmt == "delta" and _delta_available():
        from delta.tables import DeltaTable

        if DeltaTable.isDeltaTable(spark, path):
            cond = " AND ".join(f"t.`{k}` <=> u.`{k}`" for k in keys)
            (
                DeltaTable.forPath(spark, path).alias("t")
                .merge(updates.alias("u"), cond)
                .whenMatchedUpdateAll()
                .whenNotMatchedInsertAll()
                .execute()
            )
        else:
            updates.write.format("delta").partitionBy(partition_by).mode("overwrite").save(path)
        return

    days = [str(r[0]) for r in updates.select(partition_by).distinct().collect()]
    if not days:
        return
    version = uuid.uuid4().hex
    pointer = read_pointer(spark, path)
    rows = updates
    held = {d: v for d, v in pointer.items() if d in days}
    if held:
        rows = upsert_frame(_load(spark, path, held, partition_by, fmt, updates.schema), updates, keys)
    rows.withColumn(VERSION, F.lit(version)).write.format(fmt).partitionBy(partition_by, VERSION).mode("append").save(path)
    replace_pointer(spark, path, {**pointer, **dict.fromkeys(days, version)})
    for d, v in held.items():  # no reader that starts now looks there
        delete_path(spark, f"{path}/{partition_by}={d}/{VERSION}={v}")


def read_pointer(spark: SparkSession, path: str) -> dict[str, str]:
    """Day -> version folder that holds it; empty before the first write."""

    fs, where = file_system(spark, f"{path}/{POINTER}")
    if not fs.exists(where):
        return {}
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def replace_pointer(spark: SparkSession, path: str, pointer: dict[str, str]) -> None:
    """Write the pointer beside itself and rename it into place: readers see the old or the new one."""

    fs, final = file_system(spark, f"{path}/{POINTER}")
    jvm = spark.sparkContext._jvm
    part = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
    out.close()
    final = fs.makeQualified(final)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    option = spark.sparkContext._gateway.new_array(rename, 1)
    option[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(part), final, option)


def _load(spark: SparkSession, path: str, days: dict[str, str], partition_by: str, fmt: str, schema=None) -> DataFrame:
    folders = [f"{path}/{partition_by}={d}/{VERSION}={v}" for d, v in sorted(days.items())]
    reader = spark.read.format(fmt).option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())]))
    return reader.load(folders).drop(VERSION)


def read_current(spark: SparkSession, path: str, partition_by: str = "event_date", fmt: str = "parquet") -> DataFrame:
    """The table as its pointer has it: each day from its one valid version folder, whatever an
    interrupted write or clean-up has left beside it."""

    pointer = read_pointer(spark, path)
    if not pointer:
        raise FileNotFoundError(f"no table at {path}")
    return _load(spark, path, pointer, partition_by, fmt)


def batch_upsert_writer(path: str, keys: list[str], partition_by: str, fmt: str = "parquet"):
    """foreachBatch callback: stamp lineage columns and upsert; empty batches
    are skipped, so a replayed empty batch is a no-op.

    The micro-batch is written once for the duration of the callback: the upsert
    takes several actions (touched days, merge, write), and each would otherwise
    run the micro-batch plan again, stateful operators and all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamped = batch.withColumns(
            {"last_updated_at": F.current_timestamp(), "source_batch_id": F.lit(int(batch_id)).cast("long")}
        )
        with written(stamped, f"upsert-{batch_id}") as rows:
            merge_into_path(spark, rows, path, keys, partition_by, fmt)

    return write
