"""Event contract v1, layer schemas and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written: they are the published
# event contract (v1), its error codes and the QoE formula constants.
# ---------------------------------------------------------------------------
EVENT_TYPES = ("playback_started", "playback_progress", "playback_completed", "playback_error")
DEVICE_TYPES = ("connected_tv", "mobile", "tablet", "web")
SUBSCRIPTION_TIERS = ("ad_supported", "standard", "premium")
REQUIRED_STRING_FIELDS = (
    "event_id",
    "event_type",
    "event_ts",
    "ingestion_ts",
    "user_id",
    "profile_id",
    "session_id",
    "content_id",
    "device_type",
    "country",
    "subscription_tier",
)
NON_NEGATIVE_NUMBER_FIELDS = (
    "position_seconds",
    "watch_seconds",
    "startup_ms",
    "bitrate_kbps",
    "rebuffer_seconds",
)
SUPPORTED_SCHEMA_VERSION = 1
ERR_INVALID_JSON = "invalid_json"
ERR_NOT_OBJECT = "record_must_be_an_object"
ERR_MISSING = "missing_or_invalid:"
ERR_UNSUPPORTED = "unsupported:"
ERR_INVALID = "invalid:"
ERR_NEGATIVE = "invalid_non_negative_number:"
ERR_REBUFFER = "invalid:rebuffer_exceeds_watch_time"
QUARANTINE_REASON = "EVENT_CONTRACT_VIOLATION"
UNKNOWN_TITLE = "Unknown"
# QoE = 100 - min(avg_startup_ms / 100, 30) - min(rebuffer_ratio * 500, 40)
#           - min(error_rate * 100, 30), floored at 0.
QOE_STARTUP_DIVISOR, QOE_STARTUP_CAP = 100.0, 30.0
QOE_REBUFFER_WEIGHT, QOE_REBUFFER_CAP = 500.0, 40.0
QOE_ERROR_WEIGHT, QOE_ERROR_CAP = 100.0, 30.0
# Largest number the strict contract takes; beyond it, and for infinity, a row goes to
# quarantine with the code of its number field. The lenient profile has no such rule; the
# marts sum any value up to MAX_SUMMED exactly (``functions.scalar.micros_sql``).
MAX_NUMBER = 9.0e12
MAX_SUMMED = 1.0e21
# Serving precision of the marts.
ROUND_RATE, ROUND_HOURS, ROUND_STARTUP, ROUND_SCORE = 4, 4, 2, 2
# ---------------------------------------------------------------------------



def event_schema() -> T.StructType:
    """The 19 fields of contract v1 as they appear in the JSON payload.

    Requiredness is enforced by the contract, not by nullability: ``from_json``
    returns every field nullable anyway.
    """

    s, d = T.StringType(), T.DoubleType()
    return T.StructType(
        [
            T.StructField("event_id", s),
            T.StructField("event_type", s),
            T.StructField("event_ts", s),
            T.StructField("ingestion_ts", s),
            T.StructField("user_id", s),
            T.StructField("profile_id", s),
            T.StructField("session_id", s),
            T.StructField("content_id", s),
            T.StructField("content_title", s),
            T.StructField("device_type", s),
            T.StructField("country", s),
            T.StructField("subscription_tier", s),
            T.StructField("position_seconds", d),
            T.StructField("watch_seconds", d),
            T.StructField("startup_ms", d),
            T.StructField("bitrate_kbps", d),
            T.StructField("rebuffer_seconds", d),
            T.StructField("error_code", s),
            T.StructField("schema_version", T.IntegerType()),
        ]
    )


EVENT_FIELDS = tuple(f.name for f in event_schema().fields)


def bronze_schema() -> T.StructType:
    """Raw payload plus where it came from.

    ``topic``/``partition``/``offset`` are the broker coordinates; for files
    they are the file path, 0 and the 1-based line number. Together they
    define arrival order, which decides which copy of a duplicate wins.
    """

    return T.StructType(
        [
            T.StructField("message_key", T.StringType()),
            T.StructField("raw_payload", T.StringType()),
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
            T.StructField("broker_timestamp", T.TimestampType()),
            T.StructField("bronze_ingested_at", T.TimestampType()),
            T.StructField("run_id", T.StringType()),
        ]
    )


BRONZE_META = ("message_key", "topic", "partition", "offset", "broker_timestamp", "bronze_ingested_at", "run_id")
ARRIVAL_ORDER = ("topic", "partition", "offset")


def silver_schema() -> T.StructType:
    """Typed, valid, deduplicated event fact (one row per event_id)."""

    s, d, ts = T.StringType(), T.DoubleType(), T.TimestampType()
    fields = [
        T.StructField("event_id", s),
        T.StructField("event_type", s),
        T.StructField("event_ts", ts),
        T.StructField("source_ingestion_ts", ts),
        T.StructField("user_id", s),
        T.StructField("profile_id", s),
        T.StructField("session_id", s),
        T.StructField("content_id", s),
        T.StructField("content_title", s),
        T.StructField("device_type", s),
        T.StructField("country", s),
        T.StructField("subscription_tier", s),
        T.StructField("position_seconds", d),
        T.StructField("watch_seconds", d),
        T.StructField("startup_ms", d),
        T.StructField("bitrate_kbps", d),
        T.StructField("rebuffer_seconds", d),
        T.StructField("error_code", s),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("topic", s),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("broker_timestamp", ts),
        T.StructField("bronze_ingested_at", ts),
        T.StructField("run_id", s),
        T.StructField("silver_processed_at", ts),
        T.StructField("event_date", T.DateType()),
    ]
    return T.StructType(fields)


SILVER_FIELDS = tuple(f.name for f in silver_schema().fields)

MEASURES = (
    "event_count",
    "plays",
    "unique_viewers",
    "completes",
    "playback_errors",
    "watch_hours",
    "completion_rate",
    "error_rate",
    "rebuffer_ratio",
    "avg_startup_ms",
    "qoe_score",
)
# Kept after the published measures so rates can be recombined exactly:
# whole microseconds of watch, rebuffer and startup time, startup samples.
RECOMBINABLE = ("watch_micros", "rebuffer_micros", "startup_micros", "startup_samples")

CONTENT_DAILY_KEYS = ("event_date", "content_id", "country", "subscription_tier", "device_type")
PLATFORM_HOURLY_KEYS = ("window_start", "country", "device_type")
CONTENT_HOURLY_KEYS = ("window_start", "content_id", "country", "subscription_tier", "device_type")


def mart_schema(keys: tuple[str, ...], with_title: bool = False) -> T.StructType:
    """Column layout of a stored mart (measures unrounded)."""

    types = {
        "event_date": T.DateType(),
        "window_start": T.TimestampType(),
        "window_end": T.TimestampType(),
    }
    fields = [T.StructField(k, types.get(k, T.StringType())) for k in keys]
    if with_title:
        fields.insert(keys.index("content_id") + 1, T.StructField("content_title", T.StringType()))
    for m in MEASURES:
        is_count = m in ("event_count", "plays", "unique_viewers", "completes", "playback_errors")
        fields.append(T.StructField(m, T.LongType() if is_count else T.DoubleType()))
    for m in RECOMBINABLE:
        fields.append(T.StructField(m, T.LongType() if m == "startup_samples" else T.DecimalType(38, 0)))
    return T.StructType(fields)
