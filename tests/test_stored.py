"""Stored tables: pruned reports, key order, compaction, versioned upserts, id bitmaps,
exact quantiles, viewer sketches, freshness, sums of the largest values."""

from __future__ import annotations

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.config import Settings
from playlake.operators import idfilter, layers, marts, measures, ordered, quality, quantiles, upsert
from playlake.plans import catalog, lake
from playlake.session import scratch_path
from playlake.sources import files

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(["top_content_by_day", "qoe_regression", "qoe_regression_timeframe", "tier_comparison",
                                         "top_content_by_day_sql", "qoe_regression_sql", "tier_comparison_sql", "session_funnel_sql"]))
def test_reports_read_their_days_only(spark, name):
    report = catalog.report_plans(spark, SF)[name]
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_of(report))
    assert found and all("event_date" in f for f in found)


def test_dataframe_funnel_reads_one_day(spark):
    day = lake.silver(spark, SF).where(F.col("event_date") == F.lit(dt.date.fromisoformat(catalog.FUNNEL_DAY)))
    days = {r[0] for r in day.select("event_date").distinct().collect()}
    assert days == {dt.date.fromisoformat(catalog.FUNNEL_DAY)}
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan_of(day))


def test_lake_is_built_once_for_an_input(spark):
    a, b = lake.silver(spark, SF).inputFiles(), lake.silver(spark, SF).inputFiles()
    assert a == b


def test_ordered_files(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "é", None]), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    path = str(tmp_path / "t")
    ordered.write_ordered(df, path, ["k", "n", "v"], files=6)
    check = ordered.order_check(spark, path, ["k", "n", "v"]).collect()
    assert len(check) == 6 and all(r["rows_in_order"] and r["after_previous"] for r in check)
    got = [tuple(r)[:3] for r in ordered.read_ordered(spark, path).orderBy("position").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1], r[2]))


def test_order_check_sees_disorder(spark, tmp_path):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "k int, v int").coalesce(1)
    df.write.parquet(str(tmp_path / "one"))
    assert not ordered.order_check(spark, str(tmp_path / "one"), ["k"]).first()["rows_in_order"]
    df.orderBy("v").repartitionByRange(3, "v").sortWithinPartitions("k").write.parquet(str(tmp_path / "three"))
    check = ordered.order_check(spark, str(tmp_path / "three"), ["k"]).collect()
    assert all(r["rows_in_order"] for r in check) and not all(r["after_previous"] for r in check)


def test_csv_files_follow_each_other(spark, tmp_path):
    mart = measures.serve(lake.content_daily(spark, SF))
    keys = list(S.CONTENT_DAILY_KEYS)
    schema = S.mart_schema(S.CONTENT_DAILY_KEYS, with_title=True)
    files.write_csv(mart.select(*schema.fieldNames()), str(tmp_path / "csv"), keys=keys)
    lines = []
    for name in sorted(f for f in os.listdir(tmp_path / "csv") if f.startswith("part-")):
        lines += (tmp_path / "csv" / name).read_text().splitlines()[1:]
    got = [[x.split(",")[i] for i in (0, 1, 3, 4, 5)] for x in lines]
    assert got == sorted(got) and len(got) == mart.count()
    served = measures.serve_ordered(lake.content_daily(spark, SF), keys).select(*keys).collect()
    assert [tuple(r) for r in served] == sorted(tuple(r) for r in served)


def _parts(path):
    return {d: sorted((f, os.path.getsize(os.path.join(path, d, f))) for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet"))
            for d in os.listdir(path) if "=" in d}


def test_compaction_leaves_large_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = spark.range(40_000).selectExpr("id", "uuid() AS u", "'2026-01-01' AS day")
    wide.coalesce(1).write.partitionBy("day").parquet(path)  # one large file
    for i in range(12):  # many small files
        spark.range(3_000).selectExpr(f"id + {i} * 3000 AS id", "uuid() AS u", "'2026-01-02' AS day").coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    before = sorted((r["id"], r["u"], str(r["day"])) for r in spark.read.parquet(path).collect())
    old = _parts(path)
    small = sum(s for _, s in old["day=2026-01-02"])
    target = small // 3
    staged = set(os.listdir(scratch_path(spark, "").rstrip("/").removeprefix("file:")))
    plan = files.compact(spark, path, "day", target_bytes=target, many_small=4).collect()
    assert [(str(r["day"]), r["files"], r["new_files"]) for r in plan] == [("2026-01-02", 12, 3)]
    new = _parts(path)
    assert new["day=2026-01-01"] == old["day=2026-01-01"]
    assert len(new["day=2026-01-02"]) == 3 and all(0.5 * target < s < 1.6 * target for _, s in new["day=2026-01-02"])
    assert sorted((r["id"], r["u"], str(r["day"])) for r in spark.read.parquet(path).collect()) == before
    assert set(os.listdir(scratch_path(spark, "").rstrip("/").removeprefix("file:"))) == staged
    assert files.compact(spark, path, "day", target_bytes=target, many_small=4).count() == 0


UPSERT = "event_date date, k string, v int"


def _day(n):
    return dt.date(2026, 1, n)


def _current(spark, path):
    return sorted(((r["event_date"].day, r["k"], r["v"]) for r in upsert.read_current(spark, path).collect()), key=str)


def test_upsert_survives_a_crash_at_any_point(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    first = spark.createDataFrame([(_day(1), "a", 1), (_day(1), None, 2), (_day(2), "b", 3)], UPSERT)
    second = spark.createDataFrame([(_day(1), None, 20), (_day(3), "c", 4)], UPSERT)
    keys = ["event_date", "k"]
    upsert.merge_into_path(spark, first, path, keys, "event_date")
    old = _current(spark, path)
    assert old == sorted([(1, "a", 1), (1, None, 2), (2, "b", 3)], key=str)

    class Killed(Exception):
        pass

    def die(*a, **k):
        raise Killed

    # the new folders are there, the pointer is not
    with monkeypatch.context() as m:
        m.setattr(upsert, "replace_pointer", die)
        with pytest.raises(Killed):
            upsert.merge_into_path(spark, second, path, keys, "event_date")
    assert _current(spark, path) == old
    # the pointer is replaced, the old folders are not deleted
    with monkeypatch.context() as m:
        m.setattr(upsert, "delete_path", die)
        with pytest.raises(Killed):
            upsert.merge_into_path(spark, second, path, keys, "event_date")
    new = sorted([(1, "a", 1), (1, None, 20), (2, "b", 3), (3, "c", 4)], key=str)
    assert _current(spark, path) == new
    upsert.merge_into_path(spark, second, path, keys, "event_date")  # the replay
    assert _current(spark, path) == new


def test_id_bitmaps(spark):
    day = [_day(1 + i % 4) for i in range(4000)]
    old = spark.createDataFrame([(f"e{i}", day[i]) for i in range(0, 4000, 2)], "event_id string, event_date date")
    new = spark.createDataFrame([(f"e{i}", day[i]) for i in range(4000)] + [("x", None)], "event_id string, event_date date")
    for buckets in (1, 3):
        f = idfilter.id_filter(old, buckets)
        marked = idfilter.maybe_stored(new, f, buckets).collect()
        stored = {r["event_id"] for r in old.collect()}
        assert all(r["_maybe"] for r in marked if r["event_id"] in stored)  # never a miss
        wrong = sum(r["_maybe"] for r in marked if r["event_id"] not in stored)
        assert wrong < 0.02 * 2000
        got = [r["event_id"] for r in idfilter.not_stored(new, old, f, buckets).collect()]
        assert sorted(got) == sorted([f"e{i}" for i in range(1, 4000, 2)] + ["x"])
    # two filters as one, and a filter so full that it knows everything: exact all the same
    half = old.where("hash(event_id) % 2 = 0"), old.where("hash(event_id) % 2 <> 0")
    both = idfilter.combined(idfilter.id_filter(half[0], 1).unionAll(idfilter.id_filter(half[1], 1)))
    assert idfilter.not_stored(new, old, both, 1).count() == 2001
    full = idfilter.id_filter(spark.range(200_000).selectExpr("CAST(id AS STRING) AS event_id", "DATE'2026-01-01' AS event_date"), 1)
    assert idfilter.not_stored(new.where("event_date = DATE'2026-01-01'"), old, full, 1).count() == 0 + new.where("event_date = DATE'2026-01-01'").count() - old.where("event_date = DATE'2026-01-01'").count()


def test_exact_quantiles(spark):
    rng = random.Random(5)
    rows = [("big", rng.gauss(0, 100)) for _ in range(20_000)] + [("ties", float(rng.randrange(3))) for _ in range(3_000)]
    rows += [("one", 7.0), ("two", 1.0), ("two", 2.0), (None, 5.0), (None, 6.0), ("empty", None), ("big", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = [0.0, 0.01, 0.25, 0.5, 0.95, 0.999, 1.0]
    sketches = quantiles.quantile_sketches(df, ["g"], "v")
    got = {(r["g"], r["probability"]): r["exact"] for r in quantiles.exact_quantiles(df, ["g"], "v", points, sketches).collect()}
    want = {}
    for g in ("big", "ties", "one", "two", None):
        values = sorted(v for k, v in rows if k == g and v is not None)
        for p in points:
            want[g, p] = values[max(1, -(-int(round(p * len(values) * 1000)) // 1000)) - 1]
    assert got == want


def test_sketches_of_hours_serve_days(spark):
    rows = quality.lag_rows(lake.silver(spark, SF))
    hours = quantiles.quantile_sketches(rows, ["window_start"], "lag_seconds")
    days = quantiles.rolled_up(hours.withColumn("day", F.to_date("window_start")), ["day"])
    assert days.agg(F.sum("values")).first()[0] == rows.count()
    assert all(r["estimate_within_bound"] for r in quality.lag_by_day(lake.silver(spark, SF)).collect())


def test_viewer_sketches_roll_up(spark):
    events = spark.range(60_000).selectExpr(
        "CAST(id % 20000 AS STRING) AS user_id", "id % 6 AS hour", "'playback_progress' AS event_type",
        "1.0D AS watch_seconds", "0.0D AS rebuffer_seconds", "CAST(NULL AS DOUBLE) AS startup_ms")
    hourly = measures.finalise(events.groupBy("hour").agg(*measures.measure_aggregates(False)))
    total = measures.recombine(hourly.withColumn("all", F.lit(1)), ["all"]).first()
    assert abs(total["unique_viewers"] - 20_000) <= 4 * 1.04 / 64 * 20_000
    assert total["event_count"] == 60_000
    assert hourly.agg(F.sum("unique_viewers")).first()[0] > 55_000  # a plain sum counts segments


FRESH = "event_ts timestamp, source_ingestion_ts timestamp, event_date date, content_id string, country string, subscription_tier string, device_type string"


def test_an_update_before_the_event_does_not_show_it(spark):
    t = lambda h, m, s=0: dt.datetime(2026, 7, 1, h, m, s)
    key = ("c", None, "standard", "web")
    rows = [(t(10, 0), t(10, 0), t(0, 0).date(), *key), (t(10, 1), t(10, 2), t(0, 0).date(), *key), (t(10, 50), t(10, 59), t(0, 0).date(), *key),
            (t(11, 0), t(11, 1), t(0, 0).date(), "other", "NO", "standard", "web")]
    silver = spark.createDataFrame(rows, FRESH)
    log = spark.createDataFrame(
        [(t(10, 0), *key, t(9, 0)), (t(10, 0), *key, t(10, 2)), (t(10, 0), *key, t(10, 6))],
        "window_start timestamp, content_id string, country string, subscription_tier string, device_type string, updated_at timestamp")
    r = quality.freshness(silver, log).first()
    # 10:00 shows at 10:02, 10:02 shows at 10:02, 10:59 and the other content never
    assert (r["events"], r["within_target"], r["never_visible"], r["max_delay_seconds"]) == (4, 2, 2, 120.0)
    assert quality.freshness(silver, log, within_seconds=60).first()["within_target"] == 1
    assert quality.freshness(silver, log.limit(0)).first()["never_visible"] == 4


def _events_with(spark, values):
    base = catalog.bronze(spark, SF).where("offset % 97 <> 0").limit(1).first()["raw_payload"]
    import json

    row = json.loads(base) | {"event_type": "playback_progress", "rebuffer_seconds": 0.0, "schema_version": 1, "startup_ms": None}
    payloads = [json.dumps(row | {"event_id": f"e{i}", "watch_seconds": v}) for i, v in enumerate(values)]
    return spark.createDataFrame([(p, "t", 0, i) for i, p in enumerate(payloads)], "raw_payload string, topic string, partition int, offset bigint")


@pytest.mark.parametrize(("profile", "values"), [("strict", [8e12, 8e12]), ("lenient", [1e13, 10.0]), ("lenient", [1e20, 1e20, 5.0]), ("strict", [9e12] * 50)])
def test_sums_neither_overflow_nor_lose_values(spark, profile, values):
    silver = layers.silver_batch(layers.classify(_events_with(spark, values), profile), profile=profile)
    r = marts.platform_hourly(silver).first()
    assert r["event_count"] == len(values)
    assert int(r["watch_micros"]) == sum(int(v) for v in values) * 1_000_000
    assert marts.content_daily(silver).first()["watch_hours"] == pytest.approx(sum(values) / 3600)


def test_values_beyond_any_sum(spark):
    """The strict contract rejects them; the lenient gate lets them in, and they add no time."""

    bad = _events_with(spark, [1e22, 1e300, 10.0])
    assert layers.classify(bad, "strict").where("is_valid").count() == 1
    r = marts.platform_hourly(layers.silver_batch(layers.classify(bad, "lenient"), profile="lenient")).first()
    assert r["event_count"] == 3 and int(r["watch_micros"]) == 10_000_000


def test_heavy_values_are_exact(spark):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.4 else f"v{rng.randrange(5000)}", rng.choice(["x", None])) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = {(r["key_name"], r["key_value"]): r["events"] for r in quality.key_skew(df, ("a", "b"), top=2, tracked=256).collect()}
    assert got["a", "hot"] == sum(a == "hot" for a, _ in rows)
    assert got["b", None] == sum(b is None for _, b in rows) and got["b", "x"] == sum(b == "x" for _, b in rows)


def test_settings_take_mart_paths_from_the_environment(monkeypatch):
    monkeypatch.setenv("PLAYLAKE_GOLD_CONTENT_HOURLY_PATH", "s3://x/ch")
    st = Settings.from_env()
    assert st.gold_paths["content_hourly"] == "s3://x/ch" and st.gold_paths["content_daily"] == "out/gold/content_daily"


def test_delta_settings_follow_the_connector(monkeypatch):
    from playlake import session

    monkeypatch.setattr(session, "find_spec", lambda name: None)
    assert session.delta_conf() == {}
    monkeypatch.setattr(session, "find_spec", lambda name: object())
    assert set(session.delta_conf()) == {"spark.sql.extensions", "spark.sql.catalog.spark_catalog"}
