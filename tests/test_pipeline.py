"""Batch medallion run end to end on landing NDJSON built from the fixture."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from playlake.operators import quality
from playlake.plans import batch, catalog
from playlake.sources import files

SF = "/root/testdata/sf0.001"
# FIXTURES.md §2, sf0.001
EXPECTED = {
    "input_records": 1020,
    "valid_records": 793,
    "duplicate_records": 16,
    "quarantined_records": 211,
    "gold_content_daily_rows": 734,
    "gold_platform_hourly_rows": 759,
    "quality_pass_rate": 0.7775,
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    landing = str(root / "landing")
    # One file in arrival order: originals by id, then the retried copies.
    bronze = catalog.bronze(spark, SF).orderBy("partition", "offset").coalesce(1)
    files.write_raw_ndjson(bronze, landing)
    out = str(root / "out")
    summary = batch.run_from_ndjson(spark, landing, out, "test-run")
    return spark, out, summary


def test_summary_counts(run):
    _, _, summary = run
    row = summary.first().asDict()
    assert row["run_id"] == "test-run"
    for k, v in EXPECTED.items():
        assert row[k] == v, k
    assert row["valid_records"] + row["duplicate_records"] + row["quarantined_records"] == row["input_records"]


def test_line_numbers_exact(run):
    spark, out, _ = run
    b = spark.read.parquet(f"{out}/bronze")
    offs = b.agg(F.min("offset"), F.max("offset"), F.countDistinct("offset"), F.count("*")).first()
    assert tuple(offs) == (1, 1020, 1020, 1020)


def test_layers_written(run):
    spark, out, _ = run
    silver = spark.read.parquet(f"{out}/silver")
    assert silver.count() == 793
    assert silver.select("event_id").distinct().count() == 793
    q = spark.read.parquet(f"{out}/quarantine")
    assert q.count() == 211
    assert q.where(F.size("errors") == 0).count() == 0
    assert spark.read.parquet(f"{out}/content_daily").count() == 734


def test_gate(run):
    _, _, summary = run
    assert quality.gate(summary, 0.98).first()["status"] == "FAIL"
    assert quality.gate(summary, 0.75).first()["status"] == "PASS"
    with pytest.raises(quality.QualityGateFailed):
        quality.enforce_gate(quality.gate(summary, 0.98))
    record = quality.enforce_gate(quality.gate(summary, 0.75))
    assert record["run_id"] == "test-run"


def test_gate_missing_keys(run):
    _, _, summary = run
    status = quality.gate(summary.drop("quality_pass_rate", "valid_records"), 0.5).first()
    assert status["status"] == "FAIL"
    assert "quality_pass_rate" in status["reason"] and "valid_records" in status["reason"]


def test_summary_round_trip_and_missing(run, tmp_path):
    spark, out, summary = run
    files.write_summary(summary, str(tmp_path / "s"))
    back = files.read_summary(spark, str(tmp_path / "s"), files.summary_schema()).first().asDict()
    assert back == summary.first().asDict()
    with pytest.raises(Exception):
        files.read_summary(spark, str(tmp_path / "missing")).first()


def test_ndjson_and_csv_sinks(run, tmp_path):
    spark, out, _ = run
    cd = spark.read.parquet(f"{out}/content_daily")
    files.write_ndjson(cd, str(tmp_path / "cd_json"))
    text = spark.read.text(str(tmp_path / "cd_json")).first()[0]
    assert text.startswith('{"avg_startup_ms"')  # keys sorted
    files.write_csv(cd, str(tmp_path / "cd_csv"))
    from playlake import schema as S

    schema = S.mart_schema(S.CONTENT_DAILY_KEYS, with_title=True)
    back = files.read_csv(spark, str(tmp_path / "cd_csv"), schema)
    assert back.count() == cd.count()


def test_compaction_keeps_rows(run, spark):
    _, out, _ = run
    before = spark.read.parquet(f"{out}/silver").select("event_id", "event_date")
    snapshot = [tuple(r) for r in before.collect()]
    files.compact(spark, f"{out}/silver", "event_date")
    after = spark.read.parquet(f"{out}/silver").select("event_id", "event_date")
    assert sorted(tuple(r) for r in after.collect()) == sorted(snapshot)


def test_replay_quarantine_through_contract(run, spark):
    """Quarantined raw payloads replayed through the same functions give the
    same verdicts (the quarantine is replayable)."""

    from playlake.operators import layers

    _, out, _ = run
    q = spark.read.parquet(f"{out}/quarantine")
    again = layers.classify(q.drop("errors", "quarantine_reason", "quarantined_at"), "strict")
    assert again.where("is_valid").count() == 0
    assert again.select("offset", "errors").exceptAll(q.select("offset", "errors")).count() == 0


def test_second_run_replaces_the_first(spark, tmp_path):
    """Two runs into one folder, on other days: only the second one counts."""

    bronze = catalog.bronze(spark, SF)
    out = str(tmp_path / "out")
    batch.run_pipeline(spark, bronze.where("offset % 3 = 0"), out, "first")
    row = batch.run_pipeline(spark, bronze.where("offset % 50 = 1"), out, "second").first()
    assert row["input_records"] == bronze.where("offset % 50 = 1").count()
    assert row["valid_records"] + row["duplicate_records"] + row["quarantined_records"] == row["input_records"]
    assert 0 <= row["quality_pass_rate"] <= 1 and row["duplicate_records"] >= 0


def test_compaction_keeps_tables_of_one_name_apart(spark, tmp_path):
    for name, days in (("a", ["d1", "d2"]), ("b", ["d3"])):
        spark.createDataFrame([(d, i) for d in days for i in range(3)], "day string, x int").write.partitionBy("day").parquet(str(tmp_path / name / "silver"))
    for name in ("a", "b"):
        files.compact(spark, str(tmp_path / name / "silver"), "day")
    rows = {n: {r["day"] for r in spark.read.parquet(str(tmp_path / n / "silver")).collect()} for n in ("a", "b")}
    assert rows == {"a": {"d1", "d2"}, "b": {"d3"}}


def test_blank_lines_are_no_records(spark, tmp_path):
    (tmp_path / "in.ndjson").write_text('{"a":1}\n\t\n  \n \t \n{"a":2}\n')
    assert files.read_ndjson_bronze(spark, str(tmp_path / "in.ndjson"), "r").count() == 2
