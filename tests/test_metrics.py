"""QoE score, guarded ratios, exact rounding and mart invariants."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from playlake.functions.scalar import qoe_score_sql, round_half_even_sql
from playlake.operators import marts, measures
from playlake.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "startup,rebuffer,error,expected",
    [(500.0, 0.001, 0.0, 94.5), (4000.0, 0.20, 0.50, 0.0), (0.0, 0.0, 0.0, 100.0), (None, 0.0, 0.0, 100.0)],
)
def test_qoe_fixture(spark, startup, rebuffer, error, expected):
    df = spark.createDataFrame([(startup, rebuffer, error)], "s double, r double, e double")
    got = df.selectExpr(qoe_score_sql("s", "r", "e") + " AS q").selectExpr(round_half_even_sql("q", 2)).first()[0]
    assert got == expected


def test_qoe_bounded_and_monotone(spark):
    rows = [(random.uniform(0, 9000), random.uniform(0, 1), random.uniform(0, 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "s double, r double, e double")
    q = df.selectExpr(qoe_score_sql("s", "r", "e") + " AS q", qoe_score_sql("s * 2", "r * 2", "e * 2") + " AS worse")
    assert q.where((F.col("q") < 0) | (F.col("q") > 100)).count() == 0
    assert q.where(F.col("worse") > F.col("q")).count() == 0


def test_round_matches_python(spark):
    random.seed(3)
    vals = [round(random.uniform(0, 500), 2) / 3600 for _ in range(3000)] + [0.125, 2.5, 0.0078125, 1e-12]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for p in (2, 4):
        got = [r[0] for r in df.selectExpr(round_half_even_sql("x", p)).collect()]
        assert got == [round(v, p) for v in vals]


def test_zero_divisors_give_zero_in_marts(spark):
    rows = [("evt_1", "playback_progress", 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "event_id string, event_type string, watch_seconds double, "
                                     "rebuffer_seconds double, startup_ms double")
    out = measures.finalise(df.groupBy().agg(*measures.measure_aggregates(True)[:2],
                                             *measures.measure_aggregates(True)[3:])
                            .withColumn("unique_viewers", F.lit(1)))
    r = out.first()
    assert (r.completion_rate, r.error_rate, r.rebuffer_ratio, r.avg_startup_ms, r.qoe_score) == (0.0, 0.0, 0.0, None, 100.0)


def test_rollups_preserve_event_count(spark):
    silver = catalog.silver(spark, SF)
    n = silver.count()
    for mart in (marts.content_daily(silver), marts.platform_hourly(silver), marts.content_hourly(silver)):
        assert mart.agg(F.sum("event_count")).first()[0] == n


def test_recombine_is_exact(spark):
    """Rolling content_hourly up to days equals content_daily's additive parts."""

    silver = catalog.silver(spark, SF)
    hourly = marts.content_hourly(silver).withColumn("event_date", F.to_date("window_start"))
    keys = ["event_date", "content_id", "country", "subscription_tier", "device_type"]
    rolled = measures.recombine(hourly, keys).select(*keys, "event_count", "watch_micros", "rebuffer_ratio", "qoe_score")
    daily = marts.content_daily(silver).select(*keys, "event_count", "watch_micros", "rebuffer_ratio", "qoe_score")
    assert rolled.exceptAll(daily).count() == 0 and daily.exceptAll(rolled).count() == 0


def test_results_do_not_depend_on_session_zone(spark):
    """A session in another zone gets the same UTC days and hours."""

    import __spark_entry__ as E

    expected = sorted(tuple(r) for r in E.queries()["platform_hourly"](spark, SF).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = sorted(tuple(r) for r in E.queries()["platform_hourly"](spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expected
