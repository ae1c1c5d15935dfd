"""Streaming: dedupe within the watermark, update-mode marts, upsert replay,
restart from a checkpoint, and stream = batch on the fixture."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from playlake.config import Settings
from playlake.operators import layers, marts
from playlake.operators.upsert import batch_upsert_writer, read_current
from playlake.plans import catalog
from playlake.sources import files
from playlake.streaming import jobs

SF = "/root/testdata/sf0.001"


def _event(eid: str, ts: str) -> str:
    return json.dumps({
        "event_id": eid, "event_type": "playback_progress", "event_ts": ts, "ingestion_ts": ts,
        "user_id": "usr_1", "profile_id": "prf_1", "session_id": "ses_1", "content_id": "cnt_101",
        "content_title": "Harbor Lights", "device_type": "web", "country": "US",
        "subscription_tier": "standard", "position_seconds": 1.0, "watch_seconds": 1.0,
        "startup_ms": None, "bitrate_kbps": 800, "rebuffer_seconds": 0.0, "error_code": None,
        "schema_version": 1,
    })


STEPS = [
    [("a", "00:00"), ("b", "00:01")],
    [("c", "02:00"), ("a", "00:50")],
    [("late", "00:05"), ("b", "02:10"), ("d", "04:00")],
    [("e", "06:00")],
    [("later", "00:10")],
]


def _land(folder: str, steps) -> None:
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(steps):
        path = os.path.join(folder, f"step-{i:02d}.json")
        with open(path, "w") as f:
            for eid, hm in rows:
                f.write(_event(eid, f"2026-07-01T{hm}:00Z") + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def _settings(tmp, **kw) -> Settings:
    return Settings(
        landing_path=str(tmp / "landing"), checkpoint_root=str(tmp / "ckpt"), trigger_interval=None,
        max_files_per_trigger=1, watermark_delay="15 minutes", **kw,
    )


def test_dedupe_within_watermark(spark, tmp_path):
    _land(str(tmp_path / "landing"), STEPS)
    st = _settings(tmp_path)
    silver = jobs.silver_stream(jobs.bronze_source(spark, st), st)
    q = (silver.select("event_id", F.date_format("event_ts", "HH:mm").alias("t"))
         .writeStream.format("memory").queryName("dedupe_out").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck1")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("dedupe_out").collect())
    # Spark filters late rows with the previous batch's watermark and evicts
    # state with the current one: 'late' (00:05) arrives in the batch that
    # moves the watermark to 01:45, so it is kept; 'b' at 02:10 meets b's
    # still-live state (evicted after that batch) and is a duplicate;
    # 'later' (00:10) arrives one batch after and is dropped as late.
    assert got == sorted([("a", "00:00"), ("b", "00:01"), ("c", "02:00"), ("late", "00:05"), ("d", "04:00"),
                          ("e", "06:00")])
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1
    last = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert last <= 1  # state shrank to the ids still inside the horizon


def test_hourly_update_mode(spark, tmp_path):
    _land(str(tmp_path / "landing"), STEPS)
    st = _settings(tmp_path)
    rows = layers.to_silver_columns(layers.valid_rows(layers.classify(jobs.bronze_source(spark, st))))
    out = jobs.mart_stream(rows, "platform_hourly", st.watermark_delay)
    q = (out.select(F.date_format("window_start", "HH").alias("h"), "event_count")
         .writeStream.format("memory").queryName("hourly_out").outputMode("update")
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    # Last emitted value per hour = the final count of that window.
    final = {}
    for r in spark.table("hourly_out").collect():
        final[r["h"]] = max(final.get(r["h"], 0), r["event_count"])
    assert final == {"00": 4, "02": 2, "04": 1, "06": 1}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1  # 'later' arrived after the 00h window was evicted


def test_upsert_replay_is_idempotent(spark, tmp_path):
    mart = marts.content_hourly(catalog.silver(spark, SF)).withColumn("event_date", F.to_date("window_start"))
    path = str(tmp_path / "gold")
    write = batch_upsert_writer(path, jobs.MART_KEYS["content_hourly"], "event_date")
    write(mart, 0)
    first = read_current(spark, path).drop("last_updated_at", "source_batch_id")
    snap = sorted(tuple(r) for r in first.collect())
    write(mart, 0)  # the same batch delivered again
    again = read_current(spark, path).drop("last_updated_at", "source_batch_id")
    assert sorted(tuple(r) for r in again.collect()) == snap
    assert len(snap) == mart.count()


def test_stream_equals_batch_across_restart(spark, tmp_path):
    """Fixture events land as day-range files (retried copies last); the
    stream runs twice on the same checkpoint; the upserted mart equals the
    batch mart (viewers excluded: approximate on streams)."""

    bronze = catalog.bronze(spark, SF).withColumn("_day", F.dayofmonth("broker_timestamp"))
    landing = tmp_path / "landing"
    groups = [(1, 8), (8, 16), (16, 24), (24, 32)]
    paths = []
    for i, (lo, hi) in enumerate(groups):
        part = bronze.where((F.col("partition") == 0) & (F.col("_day") >= lo) & (F.col("_day") < hi))
        paths.append((str(landing / f"f{i}"), part))
    paths.append((str(landing / "f9"), bronze.where(F.col("partition") == 1)))
    for i, (p, df) in enumerate(paths):
        files.write_raw_ndjson(df.orderBy("offset").coalesce(1), p + "_dir")
        src = [f for f in os.listdir(p + "_dir") if f.startswith("part-")][0]
        os.makedirs(str(landing), exist_ok=True)
        dst = str(landing / f"batch-{i:02d}.json")
        os.link(os.path.join(p + "_dir", src), dst)
    st = _settings(tmp_path).with_(landing_path=str(landing / "batch-*.json"),
                                   gold_paths={"platform_hourly": str(tmp_path / "gold_ph")})
    for i in range(len(paths)):
        os.utime(str(landing / f"batch-{i:02d}.json"), (1_700_000_000 + i * 10,) * 2)
    # First run sees all files; a second run on the same checkpoint must
    # find nothing new and leave the mart unchanged.
    jobs.start_direct_gold(spark, st, "platform_hourly").awaitTermination()
    first = read_current(spark, str(tmp_path / "gold_ph")).count()
    jobs.start_direct_gold(spark, st, "platform_hourly").awaitTermination()
    gold = read_current(spark, str(tmp_path / "gold_ph"))
    assert gold.count() == first
    cols = ["window_start", "country", "device_type", "event_count", "plays", "completes", "playback_errors",
            "watch_micros", "rebuffer_micros", "startup_micros", "startup_samples", "qoe_score"]
    batch_mart = marts.platform_hourly(catalog.silver(spark, SF)).select(*cols)
    got = gold.select(*cols)
    assert got.exceptAll(batch_mart).count() == 0
    assert batch_mart.exceptAll(got).count() == 0


def test_multi_hop_jobs(spark, tmp_path):
    """Bronze append -> Silver + quarantine (two queries, own checkpoints)
    -> Gold content_hourly upsert, each hop reading the upstream table as a
    stream; then a replay of all hops changes nothing."""

    steps = [rows for rows in STEPS[:4]]
    _land(str(tmp_path / "landing"), steps)
    with open(tmp_path / "landing" / "step-09.json", "w") as f:
        f.write("not json\n" + _event("bad", "2026-07-01T07:00:00Z").replace('"schema_version": 1', '"schema_version": 2') + "\n")
    os.utime(tmp_path / "landing" / "step-09.json", (1_700_000_100,) * 2)
    st = _settings(tmp_path).with_(
        max_files_per_trigger=None,
        bronze_path=str(tmp_path / "bronze"),
        silver_path=str(tmp_path / "silver"),
        quarantine_path=str(tmp_path / "quarantine"),
        gold_paths={"content_hourly": str(tmp_path / "gold")},
    )

    def run_all_hops():
        jobs.start_bronze(spark, st).awaitTermination()
        for q in jobs.start_silver(spark, st):
            q.awaitTermination()
        jobs.start_gold(spark, st, "content_hourly").awaitTermination()

    run_all_hops()
    bronze = spark.read.parquet(st.bronze_path)
    silver = spark.read.parquet(st.silver_path)
    quarantine = spark.read.parquet(st.quarantine_path)
    gold = read_current(spark, st.gold_paths["content_hourly"])
    assert bronze.count() == sum(len(s) for s in steps) + 2
    assert quarantine.count() == 2
    assert sorted(r[0] for r in quarantine.selectExpr("concat_ws(',', errors)").collect()) == [
        "invalid_json", "unsupported:schema_version"]
    # one batch: the duplicate 'a' and 'b' copies are dropped, the rest kept
    assert sorted(r[0] for r in silver.select("event_id").collect()) == ["a", "b", "c", "d", "e", "late"]
    assert gold.agg(F.sum("event_count")).first()[0] == silver.count()
    snapshot = sorted(tuple(r) for r in gold.drop("last_updated_at", "source_batch_id").collect())
    run_all_hops()  # nothing new: every hop finds its checkpoint up to date
    gold2 = read_current(spark, st.gold_paths["content_hourly"]).drop("last_updated_at", "source_batch_id")
    assert sorted(tuple(r) for r in gold2.collect()) == snapshot


def test_batch_summaries_equal_the_batch_run(spark, tmp_path):
    """Counts observed by the Silver stream, batch by batch: late rows are repeats that the
    watermark drops, and the sums are those of the batch summary."""

    from playlake.operators import quality

    st = catalog._stream_settings(spark, SF)
    q = catalog._silver_query(spark, st)
    batches = jobs.batch_summaries(spark, q, "r")
    total = jobs.summary_of_batches(batches).first()
    want = quality.run_summary(catalog.classified_raw(spark, SF), "r").first()
    for c in ("input_records", "valid_records", "duplicate_records", "quarantined_records", "quality_pass_rate"):
        assert total[c] == want[c], c
    rows = batches.orderBy("batch_no").collect()
    # half of the retries come with their week and meet live state, the others come late
    assert sum(r["duplicate_records"] for r in rows[:-1]) > 0 and rows[-1]["late_records"] > 0
    assert rows[-1]["valid_records"] == 0


def test_summaries_refuse_lost_progress(spark):
    class Query:
        recentProgress = [{"batchId": 3, "observedMetrics": {}}]

    with pytest.raises(ValueError):
        jobs.batch_summaries(spark, Query())


def _rows(spark, path, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(path).selectExpr(*cols).collect())


def test_fan_out_replay_adds_nothing(spark, tmp_path):
    """A batch that is delivered again replaces its own folders; a repeat far beyond any
    watermark is found by the id bitmaps."""

    st = _settings(tmp_path).with_(silver_path=str(tmp_path / "silver"), quarantine_path=str(tmp_path / "quarantine"))
    write = jobs.fan_out_writer(st)

    def batch(rows):
        payloads = [(None, p, "t", 0, i, None, None, None) for i, p in enumerate(rows)]
        from playlake import schema as S

        return spark.createDataFrame(payloads, S.bronze_schema())

    one = batch([_event("a", "2026-07-01T00:00:00Z"), _event("a", "2026-07-01T00:00:00Z"), "not json", _event("b", "2026-07-02T00:00:00Z")])
    two = batch([_event("a", "2026-07-01T00:00:00Z"), _event("c", "2026-07-09T00:00:00Z"), "[]"])
    ids = lambda: _rows(spark, st.silver_path, "event_id", "source_batch_id")
    bad = lambda: _rows(spark, st.quarantine_path, "raw_payload", "source_batch_id")
    write(one, 0)
    write(one, 0)
    assert ids() == [("a", 0), ("b", 0)] and bad() == [("not json", 0)]
    write(two, 1)
    write(two, 1)
    assert ids() == [("a", 0), ("b", 0), ("c", 1)] and bad() == [("[]", 1), ("not json", 0)]
    write(one, 0)  # a late replay of the first batch
    assert ids() == [("a", 0), ("b", 0), ("c", 1)]


def test_fan_out_reads_the_source_once_a_batch(spark, tmp_path):
    _land(str(tmp_path / "landing"), STEPS)
    st = _settings(tmp_path).with_(silver_path=str(tmp_path / "silver"), quarantine_path=str(tmp_path / "quarantine"))
    q = jobs.start_fan_out(spark, st)
    q.awaitTermination()
    assert q.recentProgress and all(p["numInputRows"] == len(rows) for p, rows in zip(q.recentProgress, STEPS))
    assert [r[0] for r in _rows(spark, st.silver_path, "event_id")] == ["a", "b", "c", "d", "e", "late", "later"]


def test_state_survives_a_restart_and_shrinks(spark, tmp_path):
    """A second run on the same checkpoint, with new files: a retry inside the horizon still
    meets its state, a late one is dropped, and the state store holds only ids behind the
    watermark's horizon."""

    landing = tmp_path / "landing"
    _land(str(landing), [[("a", "00:00"), ("b", "00:01")], [("c", "02:00")]])
    st = _settings(tmp_path).with_(silver_path=str(tmp_path / "silver"))
    checkpoint = jobs.checkpoint_for(spark, st, "silver")

    def run():
        q = (jobs.silver_stream(jobs.bronze_source(spark, st), st).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(st.silver_path))
        q.awaitTermination()
        return q

    def state_ids():
        rows = spark.read.format("statestore").load(checkpoint).selectExpr("key.event_id").collect()
        return sorted(r[0] for r in rows)

    run()
    assert state_ids() == ["c"]  # a and b left the state behind the watermark
    for i, rows in enumerate([[("c", "02:00"), ("d", "02:05")], [("b", "00:01"), ("e", "03:00")], [("f", "05:00")]], start=2):
        path = landing / f"step-{i:02d}.json"
        path.write_text("".join(_event(e, f"2026-07-01T{hm}:00Z") + "\n" for e, hm in rows))
        os.utime(path, (1_700_000_000 + i * 10,) * 2)
    q = run()
    got = sorted(r[0] for r in spark.read.parquet(st.silver_path).select("event_id").collect())
    assert got == ["a", "b", "c", "d", "e", "f"]  # the retry of c met its state, that of b was late
    assert sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"]) == 1
    assert state_ids() == ["f"]


def test_one_query_ends_all(spark, tmp_path):
    _land(str(tmp_path / "landing"), STEPS[:1])
    st = _settings(tmp_path).with_(bronze_path=str(tmp_path / "bronze"))
    spark.streams.resetTerminated()
    ends = jobs.start_bronze(spark, st)
    waits = st.with_(trigger_interval="1 second", silver_path=str(tmp_path / "silver"), gold_paths={"platform_hourly": str(tmp_path / "gold")})
    stays = jobs.start_gold(spark, waits, "platform_hourly")
    jobs.await_any(spark, [ends, stays])
    assert not stays.isActive


def test_downstream_starts_before_upstream_exists(spark, tmp_path):
    """run_all order: Gold may start before Silver has written anything."""

    st = _settings(tmp_path).with_(silver_path=str(tmp_path / "not_yet"),
                                   gold_paths={"platform_hourly": str(tmp_path / "gold")})
    q = jobs.start_gold(spark, st, "platform_hourly")
    q.awaitTermination()
    assert q.exception() is None


def test_steps_of_several_files_are_one_batch_each(spark, tmp_path):
    """A large step lands in files of bounded size, a small one in as many (some empty), and
    each step is still one micro-batch, in order."""

    sizes = {3: 40, 7: 1, 20: 900}
    rows = spark.createDataFrame([(json.dumps({"n": n, "s": s}), s) for s, size in sizes.items() for n in range(size)], "raw_payload string, step long")
    path = str(tmp_path / "landing")
    most = files.land_in_order(spark, rows, path, "step", rows_per_file=100)
    assert most == 9
    for s, size in sizes.items():
        lines = [sum(1 for _ in open(f"{path}/step={s}/{f}")) for f in os.listdir(f"{path}/step={s}") if f.startswith("part-")]
        assert len(lines) == most and sum(lines) == size and max(lines) < 200
    seen = []

    def note(batch, _):
        seen.append({r["s"]: r["n"] for r in batch.selectExpr("get_json_object(raw_payload, '$.s') AS s").groupBy("s").agg(F.count("*").alias("n")).collect()})

    stream = files.bronze_file_stream(spark, f"{path}/*", most)
    stream.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert seen == [{"3": 40}, {"7": 1}, {"20": 900}]


def test_landing_of_a_large_step_keeps_its_batches(spark, monkeypatch):
    """The stream's batch counts do not depend on the number of files."""

    def batches():
        st = catalog._stream_settings(spark, SF)
        rows = jobs.batch_summaries(spark, catalog._silver_query(spark, st), "r").orderBy("batch_no").collect()
        return st.max_files_per_trigger, [tuple(r) for r in rows]

    few, want = batches()
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    many, got = batches()
    assert few == 1 and many == 3 and got == want


def test_landing_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "raw_payload string, step long")
    assert files.land_in_order(spark, none, str(tmp_path / "landing"), "step") == 1
