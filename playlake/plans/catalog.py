"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the input tables under ``sf_dir`` in full (the playback
events are derived from ``events``, the content dimension from ``part``) and
runs the pipeline it names. Results go through ``checked`` so that both
engines print values alike: timestamps and dates as text, doubles rounded to
6 places, arrays joined with ','.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake import schema as S
from playlake.functions.scalar import pseudonymous_id
from playlake.operators import idfilter, layers, marts, measures, ordered, quality
from playlake.plans import analyses, lake, sql_reports
from playlake.sources import files
from playlake.sources.fixture import content_dimension_from_part, playback_broken, playback_raw, playback_typed
from playlake.session import ensure_semantics, materialize, scratch_path
from playlake.sources.tables import read_table, spread

# Report parameters (constants so every run is reproducible).
AS_OF_DATE = "2024-01-31"
AS_OF_TS = "2024-01-31 00:00:00"
TIER_START, TIER_END = "2024-01-08", "2024-01-21"
FUNNEL_DAY = "2024-01-15"
DASHBOARD_COUNTRIES = ("BR", "JP", "NO", "PL")
DASHBOARD_DEVICES = ("connected_tv", "mobile", "web")
RUN_ID = "fixture-run"
GATE_MIN_RATE = 0.98
GATE_PASSES_AT = 0.75
LOST_COUNTRY, LOST_EVERY = "ZA", 31
IDS_PER_DAY = 4000
RETRY_LATE_EVERY = 100
LANDING_FILES = 1
UPSERT_TARGET_BEFORE = "2024-01-20"
UPSERT_UPDATES_FROM = "2024-01-15"


def checked(df: DataFrame) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        elif isinstance(f.dataType, T.DateType):
            c = f"CAST({c} AS STRING)"
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0:
            c = f"CAST({c} AS BIGINT)"
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = f"round(CAST({c} AS DOUBLE), 6)"
        elif isinstance(f.dataType, T.ArrayType):
            c = f"concat_ws(',', {c})"
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = f"CAST({c} AS BIGINT)"
        exprs.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*exprs)


# ---- shared building blocks ------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_semantics(spark)
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return spread(read_table(spark, sf_dir, "events").select(*cols))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playback_raw(events(spark, sf_dir), run_id=RUN_ID)


def classified_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.classify(bronze(spark, sf_dir), "strict")


def classified_typed(spark: SparkSession, sf_dir: str, content_key: str = "catalogue") -> DataFrame:
    return layers.classify_typed(playback_typed(events(spark, sf_dir), content_key))


def silver_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a lazy plan (for queries that read it once)."""

    return layers.silver_batch(classified_typed(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once and read back, for queries that read it more
    than once (marts with their title dimension, reconciliation)."""

    return materialize(silver_plan(spark, sf_dir), "silver")


def content_daily_mart(spark, sf_dir):
    return marts.content_daily(silver(spark, sf_dir))


# ---- queries ---------------------------------------------------------------


def q_bronze_projection(spark, sf_dir):
    """Raw JSON Bronze -> from_json with the fixed schema -> event.* + coordinates."""

    b = bronze(spark, sf_dir)
    parsed = b.withColumn("event", F.from_json("raw_payload", S.event_schema()))
    return checked(
        parsed.select("event.*", "message_key", "topic", "partition", "offset", "broker_timestamp")
    )


def q_contract_errors_typed(spark, sf_dir):
    c = classified_typed(spark, sf_dir)
    return checked(c.select("event_id", "topic", "partition", "offset", "errors", "is_valid"))


def q_contract_errors_raw(spark, sf_dir):
    c = classified_raw(spark, sf_dir)
    return checked(c.select("event_id", "topic", "partition", "offset", "errors", "is_valid"))


def q_contract_broken(spark, sf_dir):
    """Payloads broken in every way the contract knows: the strict errors, and what the lenient
    gate makes of those that are one JSON object."""

    rows = playback_broken(events(spark, sf_dir))
    at = ["topic", "partition", "offset"]
    strict = layers.classify(rows, "strict").select(*at, "way", "errors", "is_valid")
    lenient = layers.classify(rows, "lenient").select(*at, F.col("is_valid").alias("ok"))
    object_ = ~F.col("way").isin(1, 2, 12, 13)
    joined = strict.join(lenient, at).withColumn("lenient_valid", F.when(object_, F.col("ok")))
    return checked(joined.drop("ok", "topic"))


def q_silver_strict(spark, sf_dir):
    """Full strict path from raw JSON: variant contract -> dedupe -> Silver."""

    s = layers.silver_batch(classified_raw(spark, sf_dir))
    return checked(s.drop("silver_processed_at", "bronze_ingested_at"))


def q_quarantine_strict(spark, sf_dir):
    q = layers.quarantine(classified_raw(spark, sf_dir))
    return checked(q.select("topic", "partition", "offset", "errors", "quarantine_reason"))


def q_quarantine_replay(spark, sf_dir):
    """Quarantined raw payloads replayed through the same contract: every
    row is rejected again with the same error list (E6)."""

    q = layers.quarantine(classified_raw(spark, sf_dir))
    again = layers.classify(q.drop("errors", "quarantine_reason", "quarantined_at"), "strict")
    return checked(again.select("topic", "partition", "offset", "errors", "is_valid"))


def q_silver_lenient(spark, sf_dir):
    s = layers.silver_batch(layers.classify(bronze(spark, sf_dir), "lenient"), profile="lenient")
    return checked(s.drop("silver_processed_at", "bronze_ingested_at"))


def q_quarantine_lenient(spark, sf_dir):
    q = layers.quarantine(layers.classify(bronze(spark, sf_dir), "lenient"))
    return checked(q.select("topic", "partition", "offset", "errors", "quarantine_reason"))


def q_dedupe_first_arrival(spark, sf_dir):
    s = silver_plan(spark, sf_dir)
    return checked(s.select("event_id", "topic", "partition", "offset", "event_ts", "event_date"))


def q_duplicate_count(spark, sf_dir):
    return checked(quality.duplicate_rate(classified_typed(spark, sf_dir), silver_plan(spark, sf_dir)))


def q_pseudonymize(spark, sf_dir):
    users = events(spark, sf_dir).select("user_id").distinct()
    return users.select(
        F.col("user_id").cast("long").alias("user_id"),
        pseudonymous_id("usr", F.col("user_id")).alias("user_key"),
        pseudonymous_id("prf", F.concat_ws("-", F.col("user_id").cast("string"), F.lit("1"))).alias("profile_key"),
    )


def q_content_daily(spark, sf_dir):
    return checked(content_daily_mart(spark, sf_dir))


def q_platform_hourly(spark, sf_dir):
    return checked(marts.platform_hourly(silver_plan(spark, sf_dir)))


def q_content_hourly(spark, sf_dir):
    return checked(marts.content_hourly(silver(spark, sf_dir)))


def q_content_daily_served(spark, sf_dir):
    return checked(measures.serve(content_daily_mart(spark, sf_dir)))


def q_hourly_to_daily_rollup(spark, sf_dir):
    """content_hourly rolled up to days from its stored integer parts: counts
    and rates equal content_daily's exactly; viewers become hour segments."""

    hourly = marts.content_hourly(silver_plan(spark, sf_dir)).withColumn("event_date", F.to_date("window_start"))
    keys = list(S.CONTENT_DAILY_KEYS)
    rolled = measures.recombine(hourly, keys).withColumnRenamed("unique_viewers", "viewer_hour_segments")
    return checked(rolled)


def q_title_latest(spark, sf_dir):
    return marts.latest_title(silver_plan(spark, sf_dir))


def q_title_join(spark, sf_dir):
    """Per-content totals with the title looked up from the latest-title
    dimension: aggregate first, then join (both sides one row per content)."""

    s = silver(spark, sf_dir)
    totals = s.groupBy("content_id").agg(*measures.measure_aggregates(True))
    joined = measures.finalise(totals).join(marts.latest_title(s), "content_id", "left")
    return checked(joined.select("content_id", "content_title", *S.MEASURES))


def q_dim_join_part(spark, sf_dir):
    """Events keyed by part, rolled up per content, then joined to the
    content dimension built from ``part`` (left join: unknown keys kept)."""

    s = layers.silver_batch(classified_typed(spark, sf_dir, content_key="part"))
    totals = measures.finalise(s.groupBy("content_id").agg(*measures.measure_aggregates(True)))
    dim = content_dimension_from_part(read_table(spark, sf_dir, "part"))
    joined = totals.join(dim, "content_id", "left").withColumn(
        "content_title", F.coalesce(F.col("content_title"), F.lit(S.UNKNOWN_TITLE))
    )
    return checked(joined.select("content_id", "content_title", "event_count", "plays", "unique_viewers",
                                 "watch_hours", "qoe_score"))


def q_mart_ordered(spark, sf_dir):
    """content_daily written in key order and read back with each row's place, taken from its
    file's number and its place in the file; and what the files say about their order."""

    keys = list(S.CONTENT_DAILY_KEYS)
    path = scratch_path(spark, f"ordered-{uuid.uuid4().hex[:12]}")
    ordered.write_ordered(measures.serve(lake.content_daily(spark, sf_dir)), path, keys)
    proof = ordered.order_check(spark, path, keys).agg(
        F.bool_and("rows_in_order").alias("rows_in_order"), F.bool_and("after_previous").alias("files_in_order")
    )
    rows = ordered.read_ordered(spark, path).select("position", *keys, "content_title", "event_count", "plays")
    return checked(rows.join(F.broadcast(proof), F.lit(True)))  # proof is one row


# The reports read stored tables that are partitioned by day: a filter on days reads only
# their folders.


def report_plans(spark, sf_dir) -> dict[str, DataFrame]:
    """The reports on some days, with the table each of them reads."""

    daily, hourly, events_ = lake.content_daily(spark, sf_dir), lake.platform_hourly(spark, sf_dir), lake.silver(spark, sf_dir)
    return {
        "top_content_by_day": analyses.top_content_by_day(daily, AS_OF_DATE),
        "qoe_regression": analyses.qoe_regression(hourly, AS_OF_TS),
        "qoe_regression_timeframe": analyses.qoe_regression(hourly, AS_OF_TS, time_true=True),
        "tier_comparison": analyses.tier_comparison(daily, TIER_START, TIER_END),
        "top_content_by_day_sql": sql_reports.top_content_by_day(spark, daily, AS_OF_DATE),
        "qoe_regression_sql": sql_reports.qoe_regression(spark, hourly, AS_OF_TS),
        "tier_comparison_sql": sql_reports.tier_comparison(spark, daily, TIER_START, TIER_END),
        "session_funnel_sql": sql_reports.session_funnel(spark, events_, FUNNEL_DAY),
    }


def q_top_content_by_day(spark, sf_dir):
    return checked(analyses.top_content_by_day(lake.content_daily(spark, sf_dir), AS_OF_DATE))


def q_qoe_regression(spark, sf_dir):
    return checked(analyses.qoe_regression(lake.platform_hourly(spark, sf_dir), AS_OF_TS))


def q_qoe_regression_timeframe(spark, sf_dir):
    return checked(analyses.qoe_regression(lake.platform_hourly(spark, sf_dir), AS_OF_TS, time_true=True))


def q_tier_comparison(spark, sf_dir):
    return checked(analyses.tier_comparison(lake.content_daily(spark, sf_dir), TIER_START, TIER_END))


def q_session_funnel(spark, sf_dir):
    return checked(analyses.session_funnel(lake.silver(spark, sf_dir), FUNNEL_DAY))


def q_top_content_by_day_sql(spark, sf_dir):
    return checked(sql_reports.top_content_by_day(spark, lake.content_daily(spark, sf_dir), AS_OF_DATE))


def q_qoe_regression_sql(spark, sf_dir):
    return checked(sql_reports.qoe_regression(spark, lake.platform_hourly(spark, sf_dir), AS_OF_TS))


def q_tier_comparison_sql(spark, sf_dir):
    return checked(sql_reports.tier_comparison(spark, lake.content_daily(spark, sf_dir), TIER_START, TIER_END))


def q_session_funnel_sql(spark, sf_dir):
    return checked(sql_reports.session_funnel(spark, lake.silver(spark, sf_dir), FUNNEL_DAY))


def _dashboard(spark, sf_dir):
    return analyses.dashboard_filter(lake.content_daily(spark, sf_dir), DASHBOARD_COUNTRIES, DASHBOARD_DEVICES)


def q_kpi_totals(spark, sf_dir):
    return checked(analyses.kpi_totals(_dashboard(spark, sf_dir)))


def q_top_titles(spark, sf_dir):
    return checked(analyses.top_titles(_dashboard(spark, sf_dir)))


def q_device_qoe(spark, sf_dir):
    return checked(analyses.device_qoe(_dashboard(spark, sf_dir)))


def q_hourly_health(spark, sf_dir):
    return checked(analyses.hourly_health(lake.platform_hourly(spark, sf_dir), DASHBOARD_COUNTRIES))


def q_filter_values(spark, sf_dir):
    return analyses.filter_values(lake.content_daily(spark, sf_dir))


def q_mart_detail(spark, sf_dir):
    return checked(analyses.mart_detail(_dashboard(spark, sf_dir)))


def _summary(spark, sf_dir) -> DataFrame:
    return quality.run_summary(classified_raw(spark, sf_dir), RUN_ID)


def q_run_summary(spark, sf_dir):
    return checked(_summary(spark, sf_dir))


def q_quality_gate(spark, sf_dir):
    """The same summary at two thresholds: it fails the published one and passes a lower."""

    summary = materialize(_summary(spark, sf_dir), "summary")
    strict, low = (quality.gate(summary, rate) for rate in (GATE_MIN_RATE, GATE_PASSES_AT))
    return checked(strict.unionByName(low).drop("checked_at"))


def q_sinks(spark, sf_dir):
    """The served daily mart through each file sink and back: rows, sums, and whether the rows
    that were read are those that were written; the run summary likewise."""

    keys = list(S.CONTENT_DAILY_KEYS)
    mart = measures.serve(lake.content_daily(spark, sf_dir))
    root = scratch_path(spark, f"sinks-{uuid.uuid4().hex[:12]}")
    schema = S.mart_schema(S.CONTENT_DAILY_KEYS, with_title=True)
    mart = mart.select(*schema.fieldNames())
    files.write_csv(mart, f"{root}/csv", keys=keys)
    files.write_ndjson(mart, f"{root}/ndjson")
    back = {"csv": files.read_csv(spark, f"{root}/csv", schema), "ndjson": spark.read.schema(schema).json(f"{root}/ndjson").select(*schema.fieldNames())}
    out = []
    for sink, rows in back.items():
        # equal multisets: every row as often on one side as on the other
        row = F.to_json(F.struct(*schema.fieldNames()), {"ignoreNullFields": "false"})
        both = mart.select(row.alias("r"), F.lit(1).alias("n")).unionAll(rows.select(row.alias("r"), F.lit(-1).alias("n")))
        off = both.groupBy("r").agg(F.sum("n").alias("n")).agg(F.count_if(F.col("n") != 0).alias("off"))
        sums = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_count").alias("events"), F.sum("plays").alias("plays"))
        out.append(sums.join(F.broadcast(off), F.lit(True)).select(F.lit(sink).alias("sink"), "rows", "events", "plays", (F.col("off") == 0).alias("same_rows")))
    files.write_summary(_summary(spark, sf_dir), f"{root}/summary")
    kept = files.read_summary(spark, f"{root}/summary", files.summary_schema())
    out.append(kept.select(
        F.lit("run_summary").alias("sink"), F.lit(1).cast("long").alias("rows"), F.col("input_records").alias("events"),
        F.col("valid_records").alias("plays"), (F.col("run_id") == RUN_ID).alias("same_rows"),
    ))
    return checked(out[0].unionByName(out[1]).unionByName(out[2]))


def q_reconciliation(spark, sf_dir):
    """Stored marts against stored Silver, and one mart that lost a country: the check finds it."""

    s, daily = lake.silver(spark, sf_dir), lake.content_daily(spark, sf_dir)
    out = quality.reconciliation(
        s,
        {
            "content_daily": daily,
            "platform_hourly": lake.platform_hourly(spark, sf_dir),
            "content_hourly": marts.content_hourly(s),
            "content_daily_with_loss": daily.where(F.col("country") != LOST_COUNTRY),
        },
    )
    return checked(out)


def q_key_skew(spark, sf_dir):
    return checked(quality.key_skew(lake.silver(spark, sf_dir)))


def q_ingestion_lag(spark, sf_dir):
    return checked(quality.ingestion_lag(lake.silver(spark, sf_dir)))


def q_lag_by_day(spark, sf_dir):
    """Hourly lag sketches merged to days, next to the exact quantiles of the days."""

    return checked(quality.lag_by_day(lake.silver(spark, sf_dir)))


def update_log(silver_rows: DataFrame) -> DataFrame:
    """An append-only log of mart updates, derived from Silver: a batch ends every ten minutes
    and writes the mart rows whose events were handed over in it. One batch in seven ends ten
    minutes late, one in 97 writes nothing."""

    slot = F.floor(F.unix_seconds("source_ingestion_ts") / 600)
    rows = silver_rows.select(
        F.date_trunc("hour", "event_ts").alias("window_start"), *quality.FRESHNESS_KEYS[1:], slot.alias("slot")
    ).where(F.col("slot") % 97 != 0)
    end = (F.col("slot") + F.when(F.col("slot") % 7 == 0, 2).otherwise(1)) * 600
    return rows.distinct().select(*quality.FRESHNESS_KEYS, F.timestamp_seconds(end).alias("updated_at"))


def q_freshness(spark, sf_dir):
    s = lake.silver(spark, sf_dir)
    return checked(quality.freshness(s, update_log(s)))


def _split_runs(spark, sf_dir):
    """Silver stored by a first run (with its id filter), and the arrivals of a second that
    repeats some of its days."""

    buckets = idfilter.buckets_for(IDS_PER_DAY)
    all_ = lake.silver(spark, sf_dir)
    path = scratch_path(spark, f"run-one-{uuid.uuid4().hex[:12]}")
    lake.write_by_day(all_.where(F.col("event_date") < F.lit(UPSERT_TARGET_BEFORE).cast("date")), path)
    one = spark.read.parquet(path)
    filters = materialize(idfilter.id_filter(one, buckets), "ids")
    two = all_.where(F.col("event_date") >= F.lit(UPSERT_UPDATES_FROM).cast("date"))
    return one, filters, two, buckets


def q_incremental_dedupe(spark, sf_dir):
    """A second run whose input overlaps the first by five days adds its new ids only."""

    one, filters, two, buckets = _split_runs(spark, sf_dir)
    new = idfilter.not_stored(two, one, filters, buckets)
    cols = ["event_id", "event_ts", "event_date", "event_type"]
    return checked(one.select(*cols, F.lit(1).alias("run_no")).unionByName(new.select(*cols, F.lit(2).alias("run_no"))))


def q_late_audit(spark, sf_dir):
    """Valid events that a stored Silver lacks: here it lost every 31st offset."""

    path = scratch_path(spark, f"lossy-{uuid.uuid4().hex[:12]}")
    valid = lake.silver(spark, sf_dir)
    lake.write_by_day(valid.where(F.col("offset") % LOST_EVERY != 0), path)
    lossy = spark.read.parquet(path)
    buckets = idfilter.buckets_for(IDS_PER_DAY)
    filters = materialize(idfilter.id_filter(lossy, buckets), "ids")
    missing = quality.late_audit_stored(valid, lossy, filters, buckets)
    return checked(missing.select("event_id", "topic", "partition", "offset", "event_ts", "event_date"))


def q_upsert_result(spark, sf_dir):
    """Keyed replace of a content_hourly target by a later batch of rows:
    target rows whose key is in the updates are replaced, others kept."""

    from playlake.operators.upsert import upsert_frame

    s = silver(spark, sf_dir)
    target = marts.content_hourly(s.where(F.col("event_ts") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp")))
    updates = marts.content_hourly(s.where(F.col("event_ts") >= F.lit(UPSERT_UPDATES_FROM).cast("timestamp")))
    return checked(upsert_frame(target, updates, list(S.CONTENT_HOURLY_KEYS)))


def _viewers_checked(sketched: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """Exact viewers of each group and whether the sketch's estimate is within its bound."""

    real = exact.select(*keys, F.col("unique_viewers").alias("viewers"))
    near = F.expr(f"abs(unique_viewers - viewers) <= {measures.viewers_bound('viewers')}")
    return sketched.join(real, keys).withColumn("estimate_within_bound", near)


def q_approx_viewers(spark, sf_dir):
    """Stream-form content_hourly (a viewers sketch) next to the exact viewers."""

    s, keys = lake.silver(spark, sf_dir), list(S.CONTENT_HOURLY_KEYS)
    out = _viewers_checked(marts.content_hourly(s, exact_viewers=False), marts.content_hourly(s), keys)
    return checked(out.drop("unique_viewers", measures.SKETCH))


def q_viewers_rollup(spark, sf_dir):
    """Hourly viewer sketches rolled up twice, to days and to the days of a country, next to
    the exact distinct viewers of those groups."""

    s = lake.silver(spark, sf_dir)
    hourly = materialize(marts.content_hourly(s, exact_viewers=False).withColumn("event_date", F.to_date("window_start")), "sketched")
    daily = measures.recombine(hourly, list(S.CONTENT_DAILY_KEYS))
    country = measures.recombine(daily, ["event_date", "country"])
    out = []
    for level, rolled, keys in (("content", daily, list(S.CONTENT_DAILY_KEYS)), ("country", country, ["event_date", "country"])):
        exact = s.groupBy(*keys).agg(F.count_distinct("user_id").alias("unique_viewers"))
        shown = _viewers_checked(rolled, exact, keys)
        none = [F.lit(None).cast("string").alias(c) for c in S.CONTENT_DAILY_KEYS if c not in keys]
        out.append(shown.select(F.lit(level).alias("level"), *keys, *none, "event_count", "viewers", "estimate_within_bound"))
    return checked(out[0].unionByName(out[1]))


# ---- streaming queries -------------------------------------------------------


def _stream_settings(spark: SparkSession, sf_dir: str):
    """Land the raw fixture events as NDJSON files, one step per event week in time order.

    Half of the retried copies land with their week, the others in a last step after all
    weeks. Each step is one micro-batch (availableNow) of ``LANDING_FILES`` files, of more
    where a step has more rows than files of ``files.ROWS_PER_FILE`` take.
    """

    from playlake.config import Settings

    root = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    week = "floor(unix_seconds(broker_timestamp) / 604800)"
    last = f"`partition` = 1 AND `offset` % {RETRY_LATE_EVERY} = 0"
    staged = bronze(spark, sf_dir).selectExpr("raw_payload", f"CASE WHEN {last} THEN 9999999 ELSE {week} END AS step")
    step_files = files.land_in_order(spark, staged, f"{root}/landing", "step", LANDING_FILES, files.ROWS_PER_FILE)
    return Settings(
        landing_path=f"{root}/landing/*",
        checkpoint_root=f"{root}/checkpoints",
        trigger_interval=None,
        max_files_per_trigger=step_files,
        bronze_path=f"{root}/bronze",
        silver_path=f"{root}/silver",
        quarantine_path=f"{root}/quarantine",
        gold_paths={"platform_hourly": f"{root}/gold_platform_hourly"},
        source_partitions=spark.sparkContext.defaultParallelism,
    )


def q_stream_dedupe(spark, sf_dir):
    """Silver stream (strict contract, dedupe within a 15-minute watermark)
    over the landing files; equals the batch first-arrival Silver."""

    st = _stream_settings(spark, sf_dir)
    _silver_query(spark, st)
    out = spark.read.parquet(st.silver_path)
    return checked(out.select("event_id", "event_ts", "event_date", "user_id", "content_id", "event_type"))


def _silver_query(spark, st):
    from playlake.streaming import jobs

    q = (
        jobs.silver_stream(jobs.bronze_source(spark, st), st)
        .writeStream.format("parquet")
        .option("checkpointLocation", jobs.checkpoint_for(spark, st, "silver"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start(st.silver_path)
    )
    q.awaitTermination()
    return q


def q_stream_run_summary(spark, sf_dir):
    """The Silver stream's own counts, batch by batch, from its observed metrics: no second
    pass over any layer."""

    from playlake.streaming import jobs

    q = _silver_query(spark, _stream_settings(spark, sf_dir))
    return checked(jobs.batch_summaries(spark, q, RUN_ID).drop("late_records"))


def q_stream_fan_out(spark, sf_dir):
    """One query that parses a batch once and writes Silver and quarantine from it; the rows of
    both, with the batch that wrote them."""

    from playlake.streaming import jobs

    st = _stream_settings(spark, sf_dir)
    jobs.start_fan_out(spark, st, idfilter.buckets_for(IDS_PER_DAY)).awaitTermination()
    ok = spark.read.parquet(st.silver_path).select(F.lit("silver").alias("layer"), "event_id", F.lit(None).cast("string").alias("errors"), "source_batch_id")
    bad = spark.read.parquet(st.quarantine_path)
    bad = bad.select(F.lit("quarantine").alias("layer"), F.get_json_object("raw_payload", "$.event_id").alias("event_id"), F.concat_ws(",", "errors").alias("errors"), "source_batch_id")
    return checked(ok.unionByName(bad).withColumnRenamed("source_batch_id", "batch_no"))


def q_stream_platform_hourly(spark, sf_dir):
    """Bronze -> dedupe -> hourly mart in one stateful query, upserted per
    micro-batch; equals the batch mart (viewers left out: approximate)."""

    from playlake.streaming import jobs

    st = _stream_settings(spark, sf_dir)
    from playlake.operators.upsert import read_current

    jobs.start_direct_gold(spark, st, "platform_hourly").awaitTermination()
    gold = read_current(spark, st.gold_paths["platform_hourly"])
    cols = [c for c in S.PLATFORM_HOURLY_KEYS + S.MEASURES + S.RECOMBINABLE if c != "unique_viewers"]
    return checked(gold.select(*cols))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_projection": q_bronze_projection,
    "contract_errors_typed": q_contract_errors_typed,
    "contract_errors_raw": q_contract_errors_raw,
    "contract_broken": q_contract_broken,
    "silver_strict": q_silver_strict,
    "quarantine_strict": q_quarantine_strict,
    "quarantine_replay": q_quarantine_replay,
    "silver_lenient": q_silver_lenient,
    "quarantine_lenient": q_quarantine_lenient,
    "dedupe_first_arrival": q_dedupe_first_arrival,
    "duplicate_count": q_duplicate_count,
    "pseudonymize": q_pseudonymize,
    "content_daily": q_content_daily,
    "platform_hourly": q_platform_hourly,
    "content_hourly": q_content_hourly,
    "content_daily_served": q_content_daily_served,
    "hourly_to_daily_rollup": q_hourly_to_daily_rollup,
    "title_latest": q_title_latest,
    "title_join": q_title_join,
    "dim_join_part": q_dim_join_part,
    "top_content_by_day": q_top_content_by_day,
    "qoe_regression": q_qoe_regression,
    "qoe_regression_timeframe": q_qoe_regression_timeframe,
    "tier_comparison": q_tier_comparison,
    "session_funnel": q_session_funnel,
    "top_content_by_day_sql": q_top_content_by_day_sql,
    "qoe_regression_sql": q_qoe_regression_sql,
    "tier_comparison_sql": q_tier_comparison_sql,
    "session_funnel_sql": q_session_funnel_sql,
    "kpi_totals": q_kpi_totals,
    "top_titles": q_top_titles,
    "device_qoe": q_device_qoe,
    "hourly_health": q_hourly_health,
    "filter_values": q_filter_values,
    "mart_detail": q_mart_detail,
    "run_summary": q_run_summary,
    "quality_gate": q_quality_gate,
    "reconciliation": q_reconciliation,
    "key_skew": q_key_skew,
    "ingestion_lag": q_ingestion_lag,
    "upsert_result": q_upsert_result,
    "approx_viewers": q_approx_viewers,
    "viewers_rollup": q_viewers_rollup,
    "mart_ordered": q_mart_ordered,
    "sinks": q_sinks,
    "lag_by_day": q_lag_by_day,
    "freshness": q_freshness,
    "incremental_dedupe": q_incremental_dedupe,
    "late_audit": q_late_audit,
    "stream_dedupe": q_stream_dedupe,
    "stream_run_summary": q_stream_run_summary,
    "stream_fan_out": q_stream_fan_out,
    "stream_platform_hourly": q_stream_platform_hourly,
}
