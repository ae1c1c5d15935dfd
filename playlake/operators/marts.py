"""Gold marts: content_daily, platform_hourly, content_hourly.

Each mart is one ``groupBy(window(event_ts, ...), keys).agg(measures)`` and
therefore runs unchanged on a batch or a watermarked stream. Exact viewers in
batch (one extra shuffle on keys + user_id, which also spreads a hot key over
many reducers), a viewers sketch and its estimate on streams, where exact
distinct is refused.

The content title is an attribute, never a key: the title of the latest
event (by event_ts, event_id). ``title_scope='run'`` takes the latest over the
whole input (batch); ``'group'`` takes the latest within the group (streams).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.functions.scalar import sql_literal
from playlake.operators.measures import finalise, mart_columns, measure_aggregates


def _title_parts() -> list[Column]:
    return [F.expr("max_by(content_title, struct(event_ts, event_id)) AS _title")]


def _with_title(groups: DataFrame, silver: DataFrame, title_scope: str) -> DataFrame:
    """Attach the content title (an attribute, never a key).

    ``run``: the latest title of each content over the whole input, from a
    separate per-content aggregate joined on content_id. The mart aggregate
    itself then holds only counts and sums, so it runs as a hash aggregate
    (a string ``max_by`` buffer would force a sort-based one over every
    row). The title side has one row per content; AQE broadcasts it when its
    measured size is under the broadcast threshold and shuffle-joins it
    otherwise.
    ``group``: the latest title within the group (streams, where a
    run-wide dimension does not exist yet), carried in the aggregate.
    """

    if title_scope == "run":
        titled = groups.join(latest_title(silver), "content_id", "left")
        return titled.withColumn("content_title", F.expr(f"coalesce(content_title, {sql_literal(S.UNKNOWN_TITLE)})"))
    if title_scope == "group":
        return groups.selectExpr("*", f"coalesce(_title, {sql_literal(S.UNKNOWN_TITLE)}) AS content_title")
    raise ValueError(f"unknown title scope {title_scope!r}")


def content_daily(silver: DataFrame, exact_viewers: bool = True, title_scope: str = "run") -> DataFrame:
    """Daily engagement and QoE per content, country, tier and device (A16)."""

    g = silver.groupBy(
        F.window("event_ts", "1 day").alias("_w"),
        "content_id",
        "country",
        "subscription_tier",
        "device_type",
    ).agg(*measure_aggregates(exact_viewers), *(_title_parts() if title_scope == "group" else []))
    g = g.selectExpr("*", "to_date(_w.start) AS event_date")
    g = _with_title(g, silver, title_scope)
    return finalise(g).select(*mart_columns(S.CONTENT_DAILY_KEYS, with_title=True, exact_viewers=exact_viewers))


def platform_hourly(silver: DataFrame, exact_viewers: bool = True) -> DataFrame:
    """Hourly platform health per country and device (A17)."""

    g = silver.groupBy(
        F.window("event_ts", "1 hour").alias("_w"), "country", "device_type"
    ).agg(*measure_aggregates(exact_viewers))
    g = g.selectExpr("*", "_w.start AS window_start")
    return finalise(g).select(*mart_columns(S.PLATFORM_HOURLY_KEYS, with_title=False, exact_viewers=exact_viewers))


def content_hourly(silver: DataFrame, exact_viewers: bool = True, title_scope: str = "run") -> DataFrame:
    """Hourly content mart with window bounds (A18)."""

    g = silver.groupBy(
        F.window("event_ts", "1 hour").alias("_w"),
        "content_id",
        "country",
        "subscription_tier",
        "device_type",
    ).agg(*measure_aggregates(exact_viewers), *(_title_parts() if title_scope == "group" else []))
    g = g.selectExpr("*", "_w.start AS window_start", "_w.end AS window_end")
    g = _with_title(g, silver, title_scope)
    cols = mart_columns(S.CONTENT_HOURLY_KEYS, with_title=True, exact_viewers=exact_viewers)
    cols.insert(1, "window_end")
    return finalise(g).select(*cols)


def latest_title(silver: DataFrame) -> DataFrame:
    """content_id -> title of its latest event, 'Unknown' if missing (A15)."""

    return silver.groupBy("content_id").agg(
        F.expr(f"coalesce(max_by(content_title, struct(event_ts, event_id)), {sql_literal(S.UNKNOWN_TITLE)})"
               " AS content_title")
    )
