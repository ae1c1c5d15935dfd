"""Contract table: raw JSON text -> exact error list (strict) and the
verdict of the lenient stream gate."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.operators import layers

BASE = {
    "event_id": "evt_1",
    "event_type": "playback_progress",
    "event_ts": "2026-07-01T10:30:00Z",
    "ingestion_ts": "2026-07-01T10:30:05Z",
    "user_id": "usr_a",
    "profile_id": "prf_a",
    "session_id": "ses_a",
    "content_id": "cnt_101",
    "content_title": "Harbor Lights",
    "device_type": "mobile",
    "country": "US",
    "subscription_tier": "premium",
    "position_seconds": 120.0,
    "watch_seconds": 60.0,
    "startup_ms": None,
    "bitrate_kbps": 2500,
    "rebuffer_seconds": 0.0,
    "error_code": None,
    "schema_version": 1,
}


def event(**changes) -> str:
    e = dict(BASE)
    for k, v in changes.items():
        if v is _DROP:
            e.pop(k)
        else:
            e[k] = v
    return json.dumps(e)


_DROP = object()
NEG = S.ERR_NEGATIVE

CASES = [
    # (id, raw, strict errors, lenient valid)
    ("valid", event(), [], True),
    ("not_json", "not json", ["invalid_json"], False),
    ("trailing_text", event() + " x", ["invalid_json"], True),
    ("closes_array", event() + "]", ["invalid_json"], True),
    ("closes_array_text", event() + "] junk", ["invalid_json"], True),
    ("closes_array_more", event() + '],{"a":1}', ["invalid_json"], True),
    ("second_element", event() + ',{"a":1}]', ["invalid_json"], True),
    ("array", "[1]", ["record_must_be_an_object"], False),
    ("null", "null", ["record_must_be_an_object"], False),
    ("string", '"s"', ["record_must_be_an_object"], False),
    ("number", "5", ["record_must_be_an_object"], False),
    ("neg_watch_v2", event(watch_seconds=-1, schema_version=2),
     [NEG + "watch_seconds", "unsupported:schema_version"], False),
    ("no_country", event(country=_DROP), ["missing_or_invalid:country"], True),
    ("blank_user", event(user_id="  "), ["missing_or_invalid:user_id"], True),
    ("bad_type", event(event_type="paused"), ["unsupported:event_type"], False),
    ("list_type", event(event_type=["a"]), ["missing_or_invalid:event_type", "unsupported:event_type"], False),
    ("ts_no_zone", event(event_ts="2026-07-01T10:30:00"), ["invalid:event_ts"], True),
    ("ts_time_only", event(event_ts="10:30:00Z"), ["invalid:event_ts"], True),
    ("ts_null", event(event_ts=None), ["missing_or_invalid:event_ts", "invalid:event_ts"], False),
    ("ts_offset", event(event_ts="2026-07-01T23:30:00-02:00"), [], True),
    # the lenient gate takes what Spark's own parser takes
    ("ts_space_minutes", event(event_ts="2026-07-01 10:30+05:30"), [], False),
    ("ts_plain_offset", event(event_ts="2026-07-01T10:30+0530"), [], False),
    ("ts_plain_offset_seconds", event(event_ts="2026-07-01 10:30:01.5+0530"), [], True),
    ("watch_infinite", event().replace('"watch_seconds": 60.0', '"watch_seconds": 1e400'), [NEG + "watch_seconds"], True),
    ("watch_beyond", event(watch_seconds=1e13), [NEG + "watch_seconds"], True),
    ("watch_text", event(watch_seconds="12"), [NEG + "watch_seconds"], True),
    ("watch_bool", event(watch_seconds=True), [NEG + "watch_seconds"], True),
    ("watch_nan", event().replace('"watch_seconds": 60.0', '"watch_seconds": NaN'), ["invalid_json"], True),
    ("rebuffer_gt_watch", event(watch_seconds=10, rebuffer_seconds=11), [S.ERR_REBUFFER], False),
    ("rebuffer_no_watch", event(watch_seconds=None, rebuffer_seconds=3), [], False),
    ("neg_startup", event(startup_ms=-1), [NEG + "startup_ms"], True),
    ("version_float", event(schema_version=1.0), [], False),
    ("version_bool", event(schema_version=True), ["unsupported:schema_version"], False),
    ("dup_keys", event()[:-1] + ', "country": "CA"}', [], True),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(i, raw) for i, (_, raw, _, _) in enumerate(CASES)]
    bronze = spark.createDataFrame(rows, "offset long, raw_payload string").select(
        F.lit(None).cast("string").alias("message_key"),
        "raw_payload",
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(None).cast("timestamp").alias("broker_timestamp"),
        F.current_timestamp().alias("bronze_ingested_at"),
        F.lit("r").alias("run_id"),
    )
    classified = layers.classify(bronze, "strict")
    strict = {r["offset"]: r for r in classified.collect()}
    lenient = {r["offset"]: r for r in layers.classify(bronze, "lenient").collect()}
    silver = {r["offset"]: r for r in layers.to_silver_columns(layers.valid_rows(classified)).collect()}
    return strict, lenient, silver


@pytest.mark.parametrize("idx", range(len(CASES)), ids=[c[0] for c in CASES])
def test_strict_errors(classified, idx):
    strict = classified[0]
    _, _, expected, _ = CASES[idx]
    assert list(strict[idx]["errors"]) == expected
    assert strict[idx]["is_valid"] == (not expected)


@pytest.mark.parametrize("idx", range(len(CASES)), ids=[c[0] for c in CASES])
def test_lenient_verdict(classified, idx):
    lenient = classified[1]
    assert lenient[idx]["is_valid"] == CASES[idx][3]


def test_offset_timestamp_lands_on_next_utc_day(classified):
    silver = classified[2]
    idx = [c[0] for c in CASES].index("ts_offset")
    assert str(silver[idx]["event_date"]) == "2026-07-02"
    assert set(silver) == {i for i, c in enumerate(CASES) if not c[2]}


def test_duplicate_keys_last_wins(classified):
    idx = [c[0] for c in CASES].index("dup_keys")
    assert classified[0][idx]["country"] == "CA"


def test_errors_typed_match_raw(spark):
    """Typed rows and their JSON text give the same verdicts."""

    from playlake.plans import catalog

    typed = catalog.classified_typed(spark, "/root/testdata/sf0.001").select("event_id", "partition", "errors")
    raw = catalog.classified_raw(spark, "/root/testdata/sf0.001").select("event_id", "partition", "errors")
    assert typed.exceptAll(raw).count() == 0
    assert raw.exceptAll(typed).count() == 0


def test_device_domain_is_sorted():
    """The session funnel takes the minimum device by its index in this
    list; that equals the minimum name only while the list is sorted."""

    assert list(S.DEVICE_TYPES) == sorted(S.DEVICE_TYPES)
