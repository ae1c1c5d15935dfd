"""Structured Streaming jobs: Bronze -> Silver / quarantine -> Gold.

The transformations are the batch ones (``playlake.operators``); only the
stateful parts differ:

* dedupe: ``dropDuplicatesWithinWatermark(['event_id'])`` on a watermark of
  ``event_ts``, so dedupe state is evicted once the watermark passes (plain
  ``dropDuplicates`` on the id alone would keep every id forever);
* marts: event-time windows on a watermarked stream in update mode; each
  micro-batch's changed groups replace their stored rows through
  ``foreachBatch`` + keyed upsert, so a replayed batch is harmless;
* viewers are approximate on streams (exact distinct is not supported).

Each query has its own checkpoint under the shared checkpoint folder, with a
version segment: changing keys, watermark or shuffle partitions needs a new
checkpoint, never a reused one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlake import schema as S
from playlake.config import Settings
from playlake.operators import layers, marts
from playlake.operators.idfilter import combined, id_filter, not_stored
from playlake.operators.upsert import batch_upsert_writer
from playlake.session import checkpoint_root, ensure_semantics, file_system, path_exists, written

MART_KEYS = {
    "content_hourly": list(S.CONTENT_HOURLY_KEYS),
    "platform_hourly": list(S.PLATFORM_HOURLY_KEYS),
    "content_daily": list(S.CONTENT_DAILY_KEYS),
}


def checkpoint_for(spark: SparkSession, settings: Settings, query: str) -> str:
    root = settings.checkpoint_root or checkpoint_root(spark)
    return f"{root.rstrip('/')}/streams/{settings.checkpoint_version}/{query}"


def _trigger(writer, settings: Settings):
    if settings.trigger_interval:
        return writer.trigger(processingTime=settings.trigger_interval)
    return writer.trigger(availableNow=True)


# ---- sources -----------------------------------------------------------------


def bronze_source(spark: SparkSession, settings: Settings) -> DataFrame:
    """Raw events as a stream, in the Bronze layout."""

    ensure_semantics(spark)
    if settings.source == "kafka":
        from playlake.sources.kafka import read_topic_stream

        rows = read_topic_stream(
            spark, settings.bootstrap_servers, settings.topic, settings.starting_offsets,
            settings.max_offsets_per_trigger,
        )
    else:
        from playlake.sources.files import bronze_file_stream

        rows = bronze_file_stream(spark, settings.landing_path, settings.max_files_per_trigger)
    if settings.source_partitions:
        rows = rows.repartition(settings.source_partitions)
    return rows


def _ensure_dir(spark: SparkSession, path: str) -> None:
    """Create an upstream table folder if it does not exist yet, so a
    downstream query can start before the upstream one has committed."""

    fs, where = file_system(spark, path)
    if not fs.exists(where):
        fs.mkdirs(where)


def table_stream(spark: SparkSession, path: str, schema, settings: Settings, max_files: int | None = None) -> DataFrame:
    """Read an upstream layer as a stream (explicit schema: an empty or not
    yet created upstream folder is legal)."""

    ensure_semantics(spark)
    _ensure_dir(spark, path)
    reader = spark.readStream.format(settings.table_format).schema(schema)
    if max_files or settings.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files or settings.max_files_per_trigger))
    return reader.load(path)


# ---- transformations ---------------------------------------------------------


def with_ingest_date(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("ingest_date", F.to_date("bronze_ingested_at"))


#: Names of the metrics that a Silver stream reports with each micro-batch.
OBSERVED_CONTRACT, OBSERVED_SILVER = "contract", "silver"


def silver_stream(bronze: DataFrame, settings: Settings) -> DataFrame:
    """classify -> valid -> typed Silver -> watermark -> dedupe within it.

    Two observations count on the way, in the pass that writes Silver: what came in and how
    the contract judged it, and what was new. ``batch_summaries`` reads them.
    """

    classified = layers.classify(bronze, settings.contract_profile).observe(
        OBSERVED_CONTRACT,
        F.count(F.lit(1)).alias("input_records"),
        F.count_if("is_valid").alias("valid_arrivals"),
        F.count_if(~F.col("is_valid")).alias("quarantined_records"),
    )
    typed = layers.to_silver_columns(layers.valid_rows(classified), profile=settings.contract_profile)
    deduped = dedupe_stream(typed, settings.watermark_delay)
    return deduped.observe(OBSERVED_SILVER, F.count(F.lit(1)).alias("valid_records"))


def batch_summaries(spark: SparkSession, query: StreamingQuery, run_id: str | None = None) -> DataFrame:
    """Per micro-batch with input: batch_no, input_records, valid_records, duplicate_records
    (repeats, late ones included), late_records (of those, dropped behind the watermark),
    quarantined_records and the pass rate. Nothing is read again: the counts come with the
    query's progress. A batch that was run twice counts once, by its last run.

    Spark keeps the progress of the last ``spark.sql.streaming.numRecentProgressUpdates``
    batches; a query that has run more is refused rather than summed up in part.
    """

    by_batch = {p["batchId"]: p for p in query.recentProgress}
    if by_batch and sorted(by_batch) != list(range(max(by_batch) + 1)):
        raise ValueError("progress of some batches is gone; raise spark.sql.streaming.numRecentProgressUpdates")
    rows = []
    for _, progress in sorted(by_batch.items()):
        seen = progress["observedMetrics"]
        if OBSERVED_CONTRACT not in seen or not seen[OBSERVED_CONTRACT]["input_records"]:
            continue
        contract, new = seen[OBSERVED_CONTRACT], seen[OBSERVED_SILVER]["valid_records"]
        late = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in progress.get("stateOperators", []))
        rows.append((
            run_id, len(rows), contract["input_records"], new, contract["valid_arrivals"] - new, late,
            contract["quarantined_records"], round(new / contract["input_records"], 4),
        ))
    return spark.createDataFrame(
        rows,
        "run_id string, batch_no bigint, input_records bigint, valid_records bigint, duplicate_records bigint, "
        "late_records bigint, quarantined_records bigint, quality_pass_rate double",
    )


def summary_of_batches(batches: DataFrame) -> DataFrame:
    """The run summary of a stream: the sums of its batches."""

    counts = ("input_records", "valid_records", "duplicate_records", "late_records", "quarantined_records")
    total = batches.groupBy("run_id").agg(*[F.sum(c).alias(c) for c in counts])
    return total.withColumn("quality_pass_rate", F.round(F.col("valid_records") / F.col("input_records"), 4))


def dedupe_stream(silver_rows: DataFrame, watermark_delay: str) -> DataFrame:
    """First copy of each event_id within the watermark horizon. A copy
    arriving after the watermark passed its event time is dropped as late
    (counted in ``numRowsDroppedByWatermark``); an id reused with a much
    newer event time is let in again (found by the duplicate-rate check)."""

    return silver_rows.withWatermark("event_ts", watermark_delay).dropDuplicatesWithinWatermark(["event_id"])


def quarantine_stream(bronze: DataFrame, settings: Settings) -> DataFrame:
    return layers.quarantine(layers.classify(bronze, settings.contract_profile))


def has_watermark(df: DataFrame, column: str = "event_ts") -> bool:
    """True when ``column`` already carries an event-time watermark (a
    chained query defines it once, at the dedupe)."""

    return "spark.watermarkDelayMs" in df.schema[column].metadata


def mart_stream(silver: DataFrame, mart: str, watermark_delay: str) -> DataFrame:
    """Update-mode mart over a watermarked Silver stream, with an
    ``event_date`` partition column for the stored table."""

    wm = silver if has_watermark(silver) else silver.withWatermark("event_ts", watermark_delay)
    if mart == "content_hourly":
        out = marts.content_hourly(wm, exact_viewers=False, title_scope="group")
        return out.withColumn("event_date", F.to_date("window_start"))
    if mart == "platform_hourly":
        out = marts.platform_hourly(wm, exact_viewers=False)
        return out.withColumn("event_date", F.to_date("window_start"))
    if mart == "content_daily":
        return marts.content_daily(wm, exact_viewers=False, title_scope="group")
    raise ValueError(f"unknown mart {mart!r}")


# ---- queries -----------------------------------------------------------------


def start_bronze(spark: SparkSession, settings: Settings) -> StreamingQuery:
    """Append raw events with their coordinates (immutable, by ingest day)."""

    w = (
        with_ingest_date(bronze_source(spark, settings))
        .writeStream.format(settings.table_format)
        .queryName("bronze_playback_events")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_for(spark, settings, "bronze"))
        .partitionBy("ingest_date")
    )
    return _trigger(w, settings).start(settings.bronze_path)


def bronze_table_schema():
    from pyspark.sql import types as T

    return T.StructType(S.bronze_schema().fields + [T.StructField("ingest_date", T.DateType())])


def start_silver(spark: SparkSession, settings: Settings) -> tuple[StreamingQuery, StreamingQuery]:
    """Two queries on the Bronze table, each with its own checkpoint: valid
    deduplicated events to Silver, violations to quarantine."""

    bronze = table_stream(spark, settings.bronze_path, bronze_table_schema(), settings)
    silver = silver_stream(bronze.drop("ingest_date"), settings)
    valid_q = _trigger(
        silver.writeStream.format(settings.table_format)
        .queryName("silver_playback_events")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_for(spark, settings, "silver"))
        .partitionBy("event_date"),
        settings,
    ).start(settings.silver_path)
    quarantine = with_ingest_date(quarantine_stream(bronze.drop("ingest_date"), settings))
    invalid_q = _trigger(
        quarantine.writeStream.format(settings.table_format)
        .queryName("quarantine_playback_events")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_for(spark, settings, "quarantine"))
        .partitionBy("ingest_date"),
        settings,
    ).start(settings.quarantine_path)
    return valid_q, invalid_q


def fan_out_writer(settings: Settings, buckets: int = 1):
    """``foreachBatch`` callback: parse a batch once, write quarantine and Silver from it.

    The classified batch is written once and both outputs are read from that copy. Each
    output of a batch is a folder of its own (``source_batch_id=N``) that a replay replaces,
    and ids of the same batch do not count as stored, so running a batch twice adds nothing.
    Silver keeps the first arrival of each id ever, not of those in a horizon: ids stored by
    earlier batches are found by the bitmaps of ``operators.idfilter`` and looked up in their
    days only. ``buckets``: bitmaps a day, see ``idfilter.buckets_for``; fixed for a table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mine = f"source_batch_id={int(batch_id)}"
        ids_path = f"{settings.silver_path.rstrip('/')}_ids"
        classified = layers.classify(batch.drop("ingest_date"), settings.contract_profile)
        with written(classified, f"classified-{batch_id}") as copy:
            layers.quarantine(copy).write.mode("overwrite").parquet(f"{settings.quarantine_path}/{mine}")
            arrivals = layers.dedupe_first_arrival(layers.valid_rows(copy), ("broker_timestamp", *S.ARRIVAL_ORDER))
            with written(layers.to_silver_columns(arrivals, profile=settings.contract_profile), f"arrivals-{batch_id}") as rows:
                earlier = _other_batches(spark, settings.silver_path, batch_id)
                if earlier is not None:
                    filters = combined(_other_batches(spark, ids_path, batch_id))
                    rows = not_stored(rows, earlier, filters, buckets)
                # ids first: a filter may know too much, never too little
                id_filter(rows, buckets).write.mode("overwrite").parquet(f"{ids_path}/{mine}")
                (
                    rows.write.mode("overwrite")
                    .option("partitionOverwriteMode", "static")
                    .partitionBy("event_date")
                    .parquet(f"{settings.silver_path}/{mine}")
                )

    return write


def _other_batches(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """A table of batch folders without that of this batch, None before the first one."""

    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).where(F.col("source_batch_id") != int(batch_id)).drop("source_batch_id")


def start_fan_out(spark: SparkSession, settings: Settings, buckets: int = 1) -> StreamingQuery:
    """One query from the source to Silver and quarantine: the source is read once a batch."""

    ensure_semantics(spark)
    w = (
        bronze_source(spark, settings)
        .writeStream.queryName("fan_out_playback_events")
        .foreachBatch(fan_out_writer(settings, buckets))
        .option("checkpointLocation", checkpoint_for(spark, settings, "fan_out"))
    )
    return _trigger(w, settings).start()


def start_gold(spark: SparkSession, settings: Settings, mart: str = "content_hourly") -> StreamingQuery:
    """Stateful mart over the Silver table, upserted per micro-batch."""

    ensure_semantics(spark)
    silver = table_stream(spark, settings.silver_path, S.silver_schema(), settings)
    out = mart_stream(silver, mart, settings.watermark_delay)
    writer = batch_upsert_writer(settings.gold_paths[mart], MART_KEYS[mart], "event_date", settings.table_format)
    w = (
        out.writeStream.queryName(f"gold_{mart}")
        .outputMode("update")
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint_for(spark, settings, f"gold_{mart}"))
    )
    return _trigger(w, settings).start()


def start_direct_gold(spark: SparkSession, settings: Settings, mart: str = "platform_hourly") -> StreamingQuery:
    """One query from Bronze to a mart: dedupe and window aggregate chained,
    a single watermark (no Silver hop that could hide lateness)."""

    silver = silver_stream(bronze_source(spark, settings), settings)
    out = mart_stream(silver, mart, settings.watermark_delay)
    writer = batch_upsert_writer(settings.gold_paths[mart], MART_KEYS[mart], "event_date", settings.table_format)
    w = (
        out.writeStream.queryName(f"direct_gold_{mart}")
        .outputMode("update")
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint_for(spark, settings, f"direct_gold_{mart}"))
    )
    return _trigger(w, settings).start()


def run_all(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    """Start Bronze, Silver, quarantine and the three marts; wait until any
    query ends (then stop the rest, so the job ends as one)."""

    queries = [start_bronze(spark, settings), *start_silver(spark, settings)]
    queries += [start_gold(spark, settings, m) for m in MART_KEYS]
    return queries


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
