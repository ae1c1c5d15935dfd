"""File sources and sinks: NDJSON landing files, JSON/CSV outputs, the run
summary, and small-file compaction.

``read_ndjson_bronze`` numbers lines exactly, like a line-by-line reader,
while the file is still read in parallel splits: each split counts its lines
(a tiny aggregate, one row per split), a running sum over the splits of a
file gives each split's first line number, and a row's line number is that
offset plus its position in the split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.functions.scalar import BLANK
from playlake.session import checkpoint_root, file_system, written


# One row per input split (~128 MB of text): 1M rows is ~100 MB, enough for
# ~120 TB of landing files. Above that the split table is joined, not
# broadcast.
MAX_BROADCAST_SPLITS = 1_000_000


def read_ndjson_bronze(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """NDJSON files -> Bronze rows (blank lines skipped, lines numbered).

    ``topic`` = file path, ``partition`` = 0, ``offset`` = 1-based line
    number (blank lines count, as in a text editor), so arrival order within
    a file is line order. The per-split table is written to the shared
    checkpoint folder (so ids stay fixed if an executor is lost) and
    broadcast only when its row count is below ``MAX_BROADCAST_SPLITS``.
    """

    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Consecutive within a split, so position = id - first id of split.
        F.monotonically_increasing_id().alias("_row"),
    )
    splits = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("_row").alias("_first_row")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_line_base", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
    splits = splits.select("file", "block", "_first_row", "_line_base")
    checkpoint_root(spark)
    splits = splits.checkpoint(eager=True)
    if splits.count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    numbered = lines.join(splits, ["file", "block"])
    numbered = numbered.withColumn("_line_no", F.col("_line_base") + (F.col("_row") - F.col("_first_row")) + 1)
    return numbered.where(~F.col("line").rlike(BLANK)).select(
        F.lit(None).cast("string").alias("message_key"),
        F.trim(F.col("line")).alias("raw_payload"),
        F.col("file").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("_line_no").cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("broker_timestamp"),
        F.current_timestamp().alias("bronze_ingested_at"),
        F.lit(run_id).alias("run_id"),
    )


def write_raw_ndjson(bronze: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write raw payloads as NDJSON text (one JSON document per line)."""

    df = bronze.select(F.col("raw_payload").alias("value"))
    if partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").text(path)


#: Rows of a landing file, about.
ROWS_PER_FILE = 100_000


def land_in_order(
    spark: SparkSession, rows: DataFrame, path: str, order: str, files: int = 1, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Raw payloads as NDJSON files, in one distributed write; a file stream reads them in the
    order of the values of ``order``. Returns the number of files that each value has: ``files``,
    or as many as the largest value needs to keep each file near ``rows_per_file``.

    Each file is written by a task of its own, so no task sorts a whole value's rows. A stream
    counts files, so a value that needs fewer of them gets empty ones.

    A file stream takes files by their time of change, which says nothing after a parallel
    write. So the times are set afterwards, a second apart in the order of the values
    (a call for each file on the driver; no data passes there).
    """

    with written(rows.groupBy(F.col(order).alias("step")).agg(F.count(F.lit(1)).alias("_rows")), "landing-steps") as counted:
        need = F.greatest(F.lit(files), F.ceil(F.col("_rows") / rows_per_file)).cast("int")
        first = F.sum("_files").over(Window.orderBy("step")) - F.col("_files")  # a row for each value
        steps = counted.withColumn("_files", need).withColumn("_first", first)
        total, most = steps.agg(F.sum("_files"), F.max("_files")).first()
        payloads = rows.select(F.col("raw_payload").alias("value"), F.col(order).alias("_step"))
        dealt = payloads.join(F.broadcast(steps), F.col("_step").eqNullSafe(F.col("step")))
        file_no = F.col("_first") + F.pmod(F.xxhash64("value"), F.col("_files"))
        landed = dealt.repartitionById(int(total or 1), file_no.cast("int")).select("value", "step")
        landed.write.mode("overwrite").partitionBy("step").text(path)
    fs, where = file_system(spark, path)
    folders = sorted((s.getPath() for s in fs.listStatus(where) if s.isDirectory()), key=lambda p: int(p.getName().split("=")[1]))
    for folder in folders:
        for at in range(len(fs.listStatus(folder)), most):
            fs.createNewFile(file_system(spark, f"{folder}/part-none-{at:05d}.txt")[1])
    begin = 1_000_000_000_000
    for at, f in enumerate(f for folder in folders for f in fs.listStatus(folder)):
        fs.setTimes(f.getPath(), begin + 1000 * at, -1)
    return most or files


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Compact JSON per row, keys sorted, nulls kept as ``null``."""

    df.select(*sorted(df.columns)).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", keys: list[str] | None = None) -> None:
    """CSV with a header; an empty frame gives an empty output. With ``keys`` the files
    follow each other in key order (``operators.ordered``)."""

    from playlake.operators.ordered import in_order

    out = in_order(df, keys) if keys else df
    out.write.mode(mode).option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with an explicit schema (no inference)."""

    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def summary_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("input_records", T.LongType()),
            T.StructField("valid_records", T.LongType()),
            T.StructField("duplicate_records", T.LongType()),
            T.StructField("quarantined_records", T.LongType()),
            T.StructField("gold_content_daily_rows", T.LongType()),
            T.StructField("gold_platform_hourly_rows", T.LongType()),
            T.StructField("quality_pass_rate", T.DoubleType()),
        ]
    )


def write_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a run summary; a missing path raises (the gate must fail)."""

    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


#: Size that compaction aims at, and how many files below half of it make a partition worth it.
TARGET_BYTES, MANY_SMALL = 256 << 20, 4


def compaction_plan(
    spark: SparkSession, path: str, partition_by: str, target_bytes: int = TARGET_BYTES, many_small: int = MANY_SMALL
) -> DataFrame:
    """Partitions with at least ``many_small`` files below half the target: their value, files,
    bytes, and ``new_files``, the number of files that brings them near the target.

    Only names and sizes are listed (in parallel), no row is read.
    """

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(partition_by, "length")
    per = files.groupBy(partition_by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.count_if(F.col("length") < target_bytes / 2).alias("small_files"),
    )
    out = per.withColumn("new_files", F.greatest(F.lit(1), F.round(F.col("bytes") / target_bytes)).cast("int"))
    return out.where((F.col("small_files") >= many_small) & (F.col("new_files") < F.col("files")))


def compact(
    spark: SparkSession, path: str, partition_by: str, target_bytes: int = TARGET_BYTES, many_small: int = MANY_SMALL
) -> DataFrame:
    """Rewrite the partitions that ``compaction_plan`` names, others stay as they are; returns the plan.

    The chosen partitions are copied to a staging folder first, so the overwrite (of those
    partitions only) never reads the files that it replaces and a lost executor starts again
    from the copy. A row's file follows from a hash of the row, so a repeated task deals rows
    the same way; each new file is one task. The staging folder is deleted at the end.
    """

    with written(compaction_plan(spark, path, partition_by, target_bytes, many_small), "compaction-plan") as stored_plan:
        plan = spark.createDataFrame(stored_plan.collect(), stored_plan.schema)  # a row for each partition to rewrite
        total = plan.agg(F.sum("new_files")).first()[0]
        if not total:
            return plan
        first = F.sum("new_files").over(Window.orderBy(partition_by)) - F.col("new_files")
        bins = plan.select(F.col(partition_by).alias("_part"), F.col("new_files").alias("_files"), first.alias("_first"))
        table = spark.read.parquet(path)
        # the plan has a row for each partition: a bound for the broadcast, and Spark prunes the others
        chosen = table.join(F.broadcast(bins), F.col(partition_by) == F.col("_part"))
        with written(chosen, "compaction") as staged:
            file_no = F.col("_first") + F.pmod(F.xxhash64(*[F.col(c) for c in table.columns]), F.col("_files"))
            dealt = staged.repartitionById(int(total), file_no.cast("int")).select(*table.columns)
            writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(partition_by).parquet(path)
        return plan


def bronze_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming Bronze from an NDJSON landing folder (one row per line)."""

    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(path)
    return lines.where(~F.col("value").rlike(BLANK)).select(
        F.lit(None).cast("string").alias("message_key"),
        F.trim(F.col("value")).alias("raw_payload"),
        F.col("_metadata.file_path").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.col("_metadata.file_modification_time").alias("broker_timestamp"),
        F.current_timestamp().alias("bronze_ingested_at"),
        F.lit(None).cast("string").alias("run_id"),
    )

