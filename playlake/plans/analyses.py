"""Analyses over the marts and Silver (the four SQL reports and the
dashboard's queries), as DataFrame functions.

Dates and times are parameters (``as_of``, ``start``/``end``, ``day``), never
``now()``, so a report is reproducible. Filters are written on the stored
column itself so they reach the Parquet scan and partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.functions.scalar import safe_ratio, weighted_mean
from playlake.operators.quantiles import exact_quantiles, quantile_sketches
from playlake.session import materialize


def _date(value) -> F.Column:
    return F.lit(dt.date.fromisoformat(str(value)))


def _ts(value) -> F.Column:
    return F.to_timestamp(F.lit(str(value)))


def top_content_by_day(content_daily: DataFrame, as_of: str, days: int = 7, top: int = 10) -> DataFrame:
    """Contents ranked by watch hours per day over the last ``days`` days;
    ties share a rank (dense rank), so a day may list more than ``top``."""

    recent = content_daily.where(F.col("event_date") >= F.date_sub(_date(as_of), days))
    g = recent.groupBy("event_date", "content_id").agg(
        F.min("content_title").alias("content_title"),
        F.sum("watch_hours").alias("watch_hours"),
        F.sum("plays").alias("playback_starts"),
        safe_ratio(F.sum("completes"), F.sum("plays")).alias("completion_rate"),
        weighted_mean(F.col("qoe_score"), F.col("event_count")).alias("weighted_qoe_score"),
    )
    rank = F.dense_rank().over(Window.partitionBy("event_date").orderBy(F.col("watch_hours").desc()))
    return (
        g.withColumn("_rank", rank)
        .where(F.col("_rank") <= top)
        .drop("_rank")
        .orderBy(F.col("event_date").desc(), F.col("watch_hours").desc(), "content_id")
    )


def qoe_regression(
    platform_hourly: DataFrame,
    as_of: str,
    lookback_hours: int = 48,
    baseline_rows: int = 24,
    drop_points: float = 10.0,
    time_true: bool = False,
) -> DataFrame:
    """Hours whose QoE fell more than ``drop_points`` below the trailing mean.

    Default baseline: the previous ``baseline_rows`` *rows* of the same
    country and device (gaps stretch it, as in the published report).
    ``time_true=True``: the previous 24 hours by the clock, whatever the gaps.
    """

    since = dt.datetime.fromisoformat(str(as_of)) - dt.timedelta(hours=lookback_hours)
    recent = platform_hourly.where(F.col("window_start") >= _ts(since))
    if "event_date" in platform_hourly.columns:  # the stored mart's folders; the day follows from the hour
        recent = recent.where(F.col("event_date") >= F.lit(since.date()))
    hourly = (
        recent.groupBy("window_start", "country", "device_type")
        .agg(
            weighted_mean(F.col("qoe_score"), F.col("event_count")).alias("qoe_score"),
            safe_ratio(F.sum("playback_errors"), F.sum("plays")).alias("error_rate"),
        )
    )
    part = Window.partitionBy("country", "device_type")
    if time_true:
        frame = part.orderBy(F.unix_seconds(F.col("window_start"))).rangeBetween(-86400, -3600)
    else:
        frame = part.orderBy("window_start").rowsBetween(-baseline_rows, -1)
    with_baseline = hourly.withColumn("prior_24h_qoe", F.avg("qoe_score").over(frame))
    return (
        with_baseline.where(
            F.col("prior_24h_qoe").isNotNull()
            & (F.col("qoe_score") < F.col("prior_24h_qoe") - F.lit(drop_points))
        )
        .withColumn("qoe_delta", F.col("qoe_score") - F.col("prior_24h_qoe"))
        .orderBy("qoe_delta", "window_start", "country", "device_type")
    )


def tier_comparison(content_daily: DataFrame, start: str, end: str) -> DataFrame:
    """Engagement and reliability per subscription tier for a date range.
    ``viewer_day_segments`` sums per-row viewers: not a distinct count."""

    return (
        content_daily.where(F.col("event_date").between(_date(start), _date(end)))
        .groupBy("subscription_tier")
        .agg(
            F.sum("plays").alias("playback_starts"),
            F.sum("unique_viewers").alias("viewer_day_segments"),
            F.sum("watch_hours").alias("watch_hours"),
            safe_ratio(F.sum("completes"), F.sum("plays")).alias("completion_rate"),
            safe_ratio(F.sum("playback_errors"), F.sum("plays")).alias("error_rate"),
            weighted_mean(F.col("qoe_score"), F.col("event_count")).alias("weighted_qoe_score"),
        )
        .orderBy(F.col("watch_hours").desc(), "subscription_tier")
    )


def session_funnel(silver: DataFrame, day: str) -> DataFrame:
    """Per device: sessions, how many started / progressed / completed /
    failed, and the median watch time per session, for one event day.

    Two chained aggregations (session, then device); both are partial
    aggregates before their shuffle. The day's sessions are written once: the
    counts, the sketch and the exact median (``operators.quantiles``) read them. The day filter is written on the
    ``event_date`` partition column and as an ``event_ts`` range, so stored
    Silver prunes partitions and row groups (``event_date`` is the UTC date
    of ``event_ts`` by construction).
    """

    d = _date(day)
    day_rows = silver.where(
        (F.col("event_date") == d)  # partition pruning on stored Silver
        & (F.col("event_ts") >= d.cast("timestamp"))
        & (F.col("event_ts") < F.date_add(d, 1).cast("timestamp"))
        & (F.to_date("event_ts") == d)
    )
    et = F.col("event_type")
    # Silver rows passed the contract, so device_type is one of the enum
    # values (listed in sorted order): the smallest index is the smallest
    # name, and an integer minimum keeps the session aggregate hash-based
    # (a string minimum would force a sort-based aggregate over the day).
    devices = F.array(*[F.lit(d) for d in S.DEVICE_TYPES])
    sessions = day_rows.groupBy("session_id").agg(
        F.element_at(devices, F.min(F.array_position(devices, F.col("device_type"))).cast("int")).alias(
            "device_type"
        ),
        (F.count_if(et == "playback_started") > 0).alias("started"),
        (F.count_if(et == "playback_progress") > 0).alias("progressed"),
        (F.count_if(et == "playback_completed") > 0).alias("completed"),
        (F.count_if(et == "playback_error") > 0).alias("failed"),
        F.sum(F.coalesce(F.col("watch_seconds"), F.lit(0.0))).alias("watch_seconds"),
    )
    sessions = materialize(sessions, "sessions")
    counts = sessions.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("started").alias("starts"),
        F.count_if("progressed").alias("progressed_sessions"),
        F.count_if("completed").alias("completions"),
        F.count_if("failed").alias("failed_sessions"),
    )
    sketches = materialize(quantile_sketches(sessions, ["device_type"], "watch_seconds"), "session-sketches")
    median = exact_quantiles(sessions, ["device_type"], "watch_seconds", [0.5], sketches)
    median = median.select("device_type", F.col("exact").alias("median_watch_seconds"))
    return counts.join(median, "device_type", "left").orderBy(F.col("sessions").desc(), "device_type")


# ---- dashboard queries ------------------------------------------------------


def dashboard_filter(content_daily: DataFrame, countries=None, devices=None) -> DataFrame:
    out = content_daily
    if countries is not None:
        out = out.where(F.col("country").isin(list(countries)))
    if devices is not None:
        out = out.where(F.col("device_type").isin(list(devices)))
    return out


def kpi_totals(filtered: DataFrame) -> DataFrame:
    """Playback starts, watch hours, weighted QoE and errors; 0 when empty."""

    return filtered.agg(
        F.coalesce(F.sum("plays"), F.lit(0)).cast("long").alias("playback_starts"),
        F.coalesce(F.sum("watch_hours"), F.lit(0.0)).alias("watch_hours"),
        F.coalesce(weighted_mean(F.col("qoe_score"), F.col("event_count")), F.lit(0.0)).alias(
            "weighted_qoe_score"
        ),
        F.coalesce(F.sum("playback_errors"), F.lit(0)).cast("long").alias("playback_errors"),
    )


def top_titles(filtered: DataFrame, top: int = 10) -> DataFrame:
    """Top titles by watch hours (a top-k report; ties broken by title)."""

    return (
        filtered.groupBy("content_title")
        .agg(F.sum("watch_hours").alias("watch_hours"))
        .orderBy(F.col("watch_hours").desc(), "content_title")
        .limit(top)
    )


def device_qoe(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy("device_type").agg(
        weighted_mean(F.col("qoe_score"), F.col("event_count")).alias("qoe_score")
    )


def hourly_health(platform_hourly: DataFrame, countries=None) -> DataFrame:
    """Unweighted mean QoE and error rate of the hourly rows per hour."""

    rows = platform_hourly
    if countries is not None:
        rows = rows.where(F.col("country").isin(list(countries)))
    return rows.groupBy("window_start").agg(
        F.avg("qoe_score").alias("qoe_score"), F.avg("error_rate").alias("error_rate")
    )


def filter_values(content_daily: DataFrame) -> DataFrame:
    """Sorted distinct non-null countries and devices offered as filters."""

    countries = content_daily.select(F.lit("country").alias("filter"), F.col("country").alias("value"))
    devices = content_daily.select(F.lit("device_type").alias("filter"), F.col("device_type").alias("value"))
    return countries.unionByName(devices).dropna().distinct().orderBy("filter", "value")


def mart_detail(filtered: DataFrame) -> DataFrame:
    return filtered.orderBy(F.col("watch_hours").desc(), "event_date", "content_id", "country",
                            "subscription_tier", "device_type")
