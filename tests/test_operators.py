"""Smaller operators: topic framing, null-safe upsert, late audit,
freshness, multi-file NDJSON numbering, lenient vs strict."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from playlake.operators import layers, quality
from playlake.operators.upsert import upsert_frame
from playlake.plans import catalog
from playlake.sources import files
from playlake.sources.kafka import topic_frame

SF = "/root/testdata/sf0.001"


def test_topic_frame_round_trips(spark):
    typed = catalog.classified_typed(spark, SF).where("is_valid").limit(50)
    framed = topic_frame(typed)
    assert framed.columns == ["key", "value"]
    row = framed.first()
    payload = json.loads(row["value"])
    assert payload["session_id"] == row["key"]
    assert "startup_ms" in payload  # nulls kept
    # The framed value goes through the same contract.
    bronze = framed.selectExpr("key AS message_key", "value AS raw_payload", "'t' AS topic", "0 AS partition",
                               "CAST(0 AS BIGINT) AS offset")
    assert layers.classify(bronze).where("NOT is_valid").count() == 0


def test_topic_frame_unknown_key(spark):
    df = spark.createDataFrame([("e1", None)], "event_id string, session_id string")
    assert topic_frame(df).first()["key"] == "unknown"


def test_upsert_null_keys_replace_not_duplicate(spark):
    schema = "k1 string, k2 string, v long"
    target = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], schema)
    updates = spark.createDataFrame([("a", None, 10), ("c", "y", 3)], schema)
    out = sorted(tuple(r) for r in upsert_frame(target, updates, ["k1", "k2"]).collect())
    assert out == [("a", None, 10), ("b", "x", 2), ("c", "y", 3)]
    again = sorted(tuple(r) for r in upsert_frame(upsert_frame(target, updates, ["k1", "k2"]), updates,
                                                  ["k1", "k2"]).collect())
    assert again == out


def test_late_audit_finds_missing_ids(spark):
    classified = catalog.classified_typed(spark, SF)
    silver = catalog.silver_plan(spark, SF)
    assert quality.late_audit(classified, silver).count() == 0
    victim = silver.orderBy("event_id").first()["event_id"]
    dropped = silver.where(F.col("event_id") != victim)
    missing = quality.late_audit(classified, dropped).select("event_id").distinct().collect()
    assert [r[0] for r in missing] == [victim]


def test_ndjson_numbering_across_files(spark, tmp_path):
    lines_a = ["{}", "", "  ", "[1]"]
    lines_b = ['{"a": 1}', "not json"]
    (tmp_path / "a.json").write_text("\n".join(lines_a) + "\n")
    (tmp_path / "b.json").write_text("\n".join(lines_b) + "\n")
    b = files.read_ndjson_bronze(spark, str(tmp_path), "r")
    got = sorted((r["topic"].rsplit("/", 1)[-1], r["offset"], r["raw_payload"]) for r in b.collect())
    assert got == [("a.json", 1, "{}"), ("a.json", 4, "[1]"), ("b.json", 1, '{"a": 1}'), ("b.json", 2, "not json")]


def test_lenient_admits_more_than_strict(spark):
    raw = catalog.bronze(spark, SF)
    strict = layers.classify(raw, "strict").where("is_valid").count()
    lenient = layers.classify(raw, "lenient").where("is_valid").count()
    assert lenient >= strict


def test_key_skew_shares(spark):
    ks = quality.key_skew(catalog.silver_plan(spark, SF)).collect()
    by_key = {}
    for r in ks:
        by_key.setdefault(r["key_name"], []).append(r)
    assert set(by_key) == {"content_id", "country", "device_type", "subscription_tier"}
    for rows in by_key.values():
        assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
        assert all(0 < r["share"] <= 1 for r in rows)


def test_publish_audit(spark, tmp_path):
    summary = quality.run_summary(catalog.classified_raw(spark, SF), "audit-run")
    quality.publish_audit(quality.gate(summary, 0.98), str(tmp_path / "audit"))
    quality.publish_audit(quality.gate(summary, 0.5), str(tmp_path / "audit"))
    rows = spark.read.json(str(tmp_path / "audit")).select("status", "run_id").collect()
    assert sorted(tuple(r) for r in rows) == [("FAIL", "audit-run"), ("PASS", "audit-run")]


def test_run_summary_retry_storm(spark):
    """One id arriving thousands of times (plus garbage lines with no id):
    counts stay exact; dedupe keeps one copy."""

    base = catalog.bronze(spark, SF)
    storm_row = base.where("`partition` = 0").orderBy("offset").limit(1)
    one = storm_row.first()
    storm = spark.range(3000).select(
        F.lit(one["message_key"]).alias("message_key"), F.lit(one["raw_payload"]).alias("raw_payload"),
        F.lit(one["topic"]).alias("topic"), F.lit(2).alias("partition"), F.col("id").alias("offset"),
        F.lit(one["broker_timestamp"]).alias("broker_timestamp"), F.current_timestamp().alias("bronze_ingested_at"),
        F.lit(one["run_id"]).alias("run_id"))
    garbage = spark.range(500).selectExpr(
        "CAST(NULL AS STRING) AS message_key", "'{oops' AS raw_payload", "'t' AS topic", "CAST(3 AS INT) AS partition",
        "id AS offset", "CAST(NULL AS TIMESTAMP) AS broker_timestamp", "current_timestamp() AS bronze_ingested_at",
        "'r' AS run_id")
    classified = layers.classify(base.unionByName(storm).unionByName(garbage))
    s = quality.run_summary(classified, "storm").first()
    plain = quality.run_summary(layers.classify(base), "plain").first()
    first_valid = layers.classify(storm_row).first()["is_valid"]
    assert s["input_records"] == plain["input_records"] + 3500
    assert s["quarantined_records"] == plain["quarantined_records"] + 500 + (0 if first_valid else 3000)
    assert s["valid_records"] == plain["valid_records"]
    assert s["duplicate_records"] == plain["duplicate_records"] + (3000 if first_valid else 0)
    assert s["gold_content_daily_rows"] == plain["gold_content_daily_rows"]
    silver = layers.silver_batch(classified)
    assert silver.count() == plain["valid_records"]


def test_reclassify_classified_rows(spark):
    """Classifying an already classified frame (a replay) works in both
    profiles and gives the same verdicts."""

    for profile in ("strict", "lenient"):
        once = layers.classify(catalog.bronze(spark, SF), profile)
        twice = layers.classify(once, profile)
        assert sorted(twice.columns) == sorted(once.columns)
        a = once.select("partition", "offset", "errors")
        b = twice.select("partition", "offset", "errors")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_spread_follows_rows_not_files(spark, tmp_path, monkeypatch):
    """One row group of many rows, in files of any number, is dealt out by its rows."""

    from playlake.sources import tables

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 4000, 1, 1).selectExpr("id AS event_id", "id % 7 AS user_id", "nullif(concat('x', id % 3), 'x0') AS props")
    rows = rows.unionAll(rows.where("event_id < 50")).coalesce(1)
    rows.write.parquet(str(tmp_path / "one"))
    rows.sparkSession.range(0, cores * 3, 1, cores * 3).selectExpr("id AS event_id", "id % 7 AS user_id", "'x' AS props").write.parquet(str(tmp_path / "many"))
    table = spark.read.parquet(str(tmp_path / "one"), str(tmp_path / "many"))
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    out = tables.spread(table)
    sizes = [n for n in out.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()]
    assert len(sizes) == -(-(4050 + cores * 3) // 100)
    assert max(sizes) < 300
    assert out.exceptAll(table).isEmpty() and table.exceptAll(out).isEmpty()
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 10**9)
    assert tables.spread(table).rdd.getNumPartitions() == cores
