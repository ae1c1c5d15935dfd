"""Playback events derived from the driver's generic ``events`` table.

A deterministic, row-local mapping (no shuffle): every ``events`` row becomes
one playback event; rows whose ``event_id`` is a multiple of 50 arrive a
second time after all others (a producer retry). ``signup`` rows keep their
type and so violate the contract, as do rows with ``schema_version`` 99 and
rows whose rebuffer time exceeds the watch time. The same mapping is written
in DuckDB SQL in ``playlake.plans.oracle``.

Arrival coordinates: ``topic`` = 'events', ``partition`` = copy number,
``offset`` = source event_id, so arrival order is (copy, event_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.functions.scalar import sql_literal

# Fixed values of the fixture mapping (FIXTURES.md §2). The titles are our
# own invented catalogue.
TYPE_MAP = (
    ("view", "playback_started"),
    ("click", "playback_progress"),
    ("purchase", "playback_completed"),
    ("error", "playback_error"),
)
CATALOGUE_TITLES = (
    "Harbor Lights",
    "Quiet Orbit",
    "Salt and Cedar",
    "The Long Relay",
    "Paper Comets",
    "Northbound",
    "A Field of Clocks",
    "Understudy",
    "Seven Tin Bridges",
    "Low Tide Radio",
    "The Glass Orchard",
    "Winter Keys",
    "Copper Saints",
    "Ferry to Nowhere",
)
MARKETS = ("DE", "BR", "JP", "ZA", "NO", "PH", "PL")
BITRATES = (450, 1200, 2200, 3600, 5200)
ERROR_CODES = ("MANIFEST_GONE", "BUFFER_STALLED", "LICENSE_EXPIRED")
DUPLICATE_EVERY = 50
BAD_VERSION_EVERY = 97
CONTENT_BASE = 7001


def _pick(values: tuple, index_sql: str) -> str:
    """SQL: values[index] for a 0-based integer expression."""

    return f"element_at(array({', '.join(sql_literal(v) for v in values)}), CAST({index_sql} AS INT) + 1)"


def playback_typed(events: DataFrame, content_key: str = "catalogue") -> DataFrame:
    """Typed playback rows (contract field types) plus arrival coordinates.

    ``content_key='catalogue'`` maps ``k`` onto the titled contents;
    ``content_key='part'`` uses ``k`` itself as the content key (title left
    NULL, to be joined from a content dimension). One narrow projection per
    step, written as SQL expressions; no shuffle.
    """

    e = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        f"explode(CASE WHEN event_id % {DUPLICATE_EVERY} = 0 THEN array(0, 1) ELSE array(0) END) AS copy_no",
    )
    e = e.selectExpr("*", "try_cast(get_json_object(props, '$.k') AS INT) AS k", "CAST(ts AS TIMESTAMP) AS ts_utc")
    type_case = " ".join(f"WHEN {sql_literal(a)} THEN {sql_literal(b)}" for a, b in TYPE_MAP)
    if content_key == "part":
        content_id, title = "concat('cnt_', CAST(k AS STRING))", "CAST(NULL AS STRING)"
    else:
        content_id = f"concat('cnt_', CAST({CONTENT_BASE} + k % {len(CATALOGUE_TITLES)} AS STRING))"
        title = _pick(CATALOGUE_TITLES, f"k % {len(CATALOGUE_TITLES)}")
    iso = sql_literal("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    session = "concat('ses_', CAST(user_id AS STRING), '_', date_format(ts_utc, 'yyyyMMdd'))"
    watch = "CASE WHEN event_type = 'click' THEN value ELSE 0.0D END"
    return e.selectExpr(
        "concat('evt_', CAST(event_id AS STRING)) AS event_id",
        f"CASE event_type {type_case} ELSE event_type END AS event_type",
        f"date_format(ts_utc, {iso}) AS event_ts",
        f"date_format(timestampadd(SECOND, event_id % 81, ts_utc), {iso}) AS ingestion_ts",
        "concat('usr_', CAST(user_id AS STRING)) AS user_id",
        "concat('prf_', CAST(user_id AS STRING), '_', CAST(event_id % 3 AS STRING)) AS profile_id",
        f"{session} AS session_id",
        f"{content_id} AS content_id",
        f"{title} AS content_title",
        f"{_pick(S.DEVICE_TYPES, f'user_id % {len(S.DEVICE_TYPES)}')} AS device_type",
        f"{_pick(MARKETS, f'user_id % {len(MARKETS)}')} AS country",
        f"{_pick(S.SUBSCRIPTION_TIERS, f'user_id % {len(S.SUBSCRIPTION_TIERS)}')} AS subscription_tier",
        f"{watch} AS position_seconds",
        f"{watch} AS watch_seconds",
        "CASE WHEN event_type = 'view' THEN 150.0D + 20.0D * value END AS startup_ms",
        f"CAST({_pick(BITRATES, 'event_id % 5')} AS DOUBLE) AS bitrate_kbps",
        "CASE WHEN event_type = 'click' AND k = 99 THEN value + 1.0D "
        "WHEN event_type = 'click' AND k % 10 = 0 THEN value / 10.0D ELSE 0.0D END AS rebuffer_seconds",
        f"CASE WHEN event_type = 'error' THEN {_pick(ERROR_CODES, 'event_id % 3')} END AS error_code",
        f"CASE WHEN event_id % {BAD_VERSION_EVERY} = 0 THEN 99 ELSE 1 END AS schema_version",
        "'events' AS topic",
        "CAST(copy_no AS INT) AS partition",
        "CAST(event_id AS BIGINT) AS offset",
        "ts_utc AS broker_timestamp",
        f"{session} AS message_key",
    )


def playback_raw(events: DataFrame, run_id: str = "fixture") -> DataFrame:
    """Bronze-shaped rows: the playback event serialised as JSON text.

    Null fields are written as JSON ``null`` (the contract allows that for
    the optional numbers and strings).
    """

    typed = playback_typed(events)
    payload = f"to_json(struct({', '.join(S.EVENT_FIELDS)}), map('ignoreNullFields', 'false'))"
    return typed.selectExpr(
        "message_key",
        f"{payload} AS raw_payload",
        "topic",
        "`partition`",
        "`offset`",
        "broker_timestamp",
        "current_timestamp() AS bronze_ingested_at",
        f"{sql_literal(run_id)} AS run_id",
    )


#: Ways to break a payload (fixed values of the fixture): number of the way -> the changed
#: column as SQL, for those that change a value before the payload is written ...
BROKEN_COLUMNS = {
    3: ("country", "' '"),
    4: ("user_id", "CAST(NULL AS STRING)"),
    5: ("event_ts", "replace(event_ts, 'Z', '')"),
    6: ("watch_seconds", "-1.0D"),
    9: ("device_type", "'fridge'"),
    10: ("ingestion_ts", "'yesterday'"),
    11: ("position_seconds", "1.0E13D"),
    15: ("subscription_tier", "CAST(NULL AS STRING)"),
    16: ("rebuffer_seconds", "watch_seconds + 5.0D"),
}
#: ... and the payload as SQL, for those that change its text.
BROKEN_TEXTS = {
    1: "substr(p, 1, length(p) - 3)",
    2: "concat('[', p, ']')",
    7: "regexp_replace(p, '\"bitrate_kbps\":([0-9.]+)', '\"bitrate_kbps\":\"$1\"')",
    8: "regexp_replace(p, '\"schema_version\":[0-9]+', '\"schema_version\":true')",
    12: "concat(p, '}')",
    13: "'\"just text\"'",
    14: "regexp_replace(p, '\"profile_id\":\"[^\"]*\"', '\"profile_id\":12')",
}
BROKEN_WAYS = 17  # 0: unbroken


def playback_broken(events: DataFrame) -> DataFrame:
    """Bronze rows whose payloads break the contract in way ``way`` = source event_id % 17."""

    typed = playback_typed(events).withColumn("way", F.col("offset") % BROKEN_WAYS)
    changed = {c: f"CASE WHEN way = {n} THEN {sql} ELSE `{c}` END" for n, (c, sql) in BROKEN_COLUMNS.items()}
    typed = typed.selectExpr(*[f"{changed[c]} AS `{c}`" if c in changed else f"`{c}`" for c in typed.columns])
    payload = f"to_json(struct({', '.join(S.EVENT_FIELDS)}), map('ignoreNullFields', 'false'))"
    rows = typed.selectExpr("topic", "`partition`", "`offset`", "CAST(way AS INT) AS way", f"{payload} AS p")
    text = " ".join(f"WHEN {n} THEN {sql}" for n, sql in BROKEN_TEXTS.items())
    return rows.selectExpr("topic", "`partition`", "`offset`", "way", f"CASE way {text} ELSE p END AS raw_payload")


def content_dimension_from_part(part: DataFrame) -> DataFrame:
    """Content dimension (content_id, content_title) from the ``part`` table."""

    return part.select(
        F.concat(F.lit("cnt_"), F.col("p_partkey").cast("string")).alias("content_id"),
        F.col("p_name").alias("content_title"),
    )
