"""Event contract v1 as Spark SQL expressions.

The strict contract reports every violated rule as an error code, in a fixed
order, in an ``ARRAY<STRING>``; a row is valid when the array is empty. The
rules are written once (``_rule_codes``) against a *field reader*, which
answers three questions per field: its value if it is a JSON string, its
value if it is a JSON number (booleans excluded), and whether it is present
and not null. Two readers exist:

* ``_variant_stage`` reads the raw payload through ``try_parse_json``; the
  variant keeps the JSON type, so ``"12"`` or ``true`` in a number field is
  an error (``from_json`` would silently turn it into NULL).
* ``_typed_fields`` reads already typed columns (e.g. a decoded topic value
  or the fixture adapter); types are taken from the DataFrame schema.

Expressions are generated as SQL text and applied with one ``selectExpr``
per stage: the plan is built with a handful of JVM calls instead of one per
expression node. Each stage materialises values the next one reads several
times (parse once, look up each field once), and Catalyst keeps the stages
apart because their outputs are reused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake import schema as S
from playlake.functions.scalar import blank_sql, iso_ts_sql, sql_literal

_CHECKED_FIELDS = tuple(
    dict.fromkeys(S.REQUIRED_STRING_FIELDS + S.NON_NEGATIVE_NUMBER_FIELDS + ("schema_version",))
)
_NUMERIC_VARIANT = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _in_list(values) -> str:
    return "(" + ", ".join(sql_literal(v) for v in values) + ")"


@dataclass(frozen=True)
class Fields:
    """Per-field SQL snippets a rule may use."""

    text: dict[str, str]
    number: dict[str, str]
    present: dict[str, str]
    is_json: str
    is_object: str


def _variant_stage(df: DataFrame, raw: str) -> tuple[DataFrame, Fields, list[str]]:
    """Parse once, then derive each checked field's JSON type and value."""

    r = f"`{raw}`"
    df = df.selectExpr(
        "*",
        f"try_parse_json({r}) AS _v",
        # try_parse_json accepts trailing text after a complete value. Inside
        # [payload, hash of payload] such text shows: a payload that closes the
        # array leaves no second element or one that is not its own hash.
        f"concat('[', {r}, ',\"', md5({r}), '\"]') AS _wrapped",
    )
    df = df.selectExpr(
        "*",
        f"coalesce(json_array_length(_wrapped) = 2 AND get_json_object(_wrapped, '$[1]') = md5({r}), false) AS _json_ok",
    )
    df = df.selectExpr(
        "*",
        "schema_of_variant(_v) AS _t_root",
        *[f"try_variant_get(_v, '$.{f}', 'variant') AS _f_{f}" for f in _CHECKED_FIELDS],
    )
    df = df.selectExpr("*", *[f"schema_of_variant(_f_{f}) AS _t_{f}" for f in _CHECKED_FIELDS])
    numeric = _in_list(_NUMERIC_VARIANT)
    df = df.selectExpr(
        "*",
        *[f"CASE WHEN _t_{f} = 'STRING' THEN try_variant_get(_f_{f}, '$', 'string') END AS _s_{f}"
          for f in _CHECKED_FIELDS],
        *[f"CASE WHEN _t_{f} IN {numeric} OR startswith(_t_{f}, 'DECIMAL') "
          f"THEN try_variant_get(_f_{f}, '$', 'double') END AS _n_{f}" for f in _CHECKED_FIELDS],
        *[f"coalesce(_t_{f} <> 'VOID', false) AS _p_{f}" for f in _CHECKED_FIELDS],
        "_v IS NOT NULL AND _json_ok AS _is_json",
        "coalesce(startswith(_t_root, 'OBJECT'), false) AS _is_object",
    )
    helpers = ["_v", "_wrapped", "_json_ok", "_t_root", "_is_json", "_is_object"]
    for prefix in ("_f_", "_t_", "_s_", "_n_", "_p_"):
        helpers += [prefix + f for f in _CHECKED_FIELDS]
    fields = Fields(
        text={f: f"_s_{f}" for f in _CHECKED_FIELDS},
        number={f: f"_n_{f}" for f in _CHECKED_FIELDS},
        present={f: f"_p_{f}" for f in _CHECKED_FIELDS},
        is_json="_is_json",
        is_object="_is_object",
    )
    return df, fields, helpers


def _typed_fields(df: DataFrame) -> Fields:
    types = {f.name: f.dataType for f in df.schema.fields}
    text, number, present = {}, {}, {}
    for f in _CHECKED_FIELDS:
        dt = types.get(f)
        c = f"`{f}`"
        text[f] = c if isinstance(dt, T.StringType) else "CAST(NULL AS STRING)"
        number[f] = f"CAST({c} AS DOUBLE)" if isinstance(dt, _NUMERIC_TYPES) else "CAST(NULL AS DOUBLE)"
        present[f] = f"({c} IS NOT NULL)" if dt is not None else "false"
    return Fields(text, number, present, "true", "true")


def _rule_codes(fx: Fields) -> list[str]:
    """One nullable code per rule, in contract order (SQL text)."""

    codes: list[str] = []
    for f in S.REQUIRED_STRING_FIELDS:
        v = fx.text[f]
        codes.append(f"CASE WHEN {v} IS NULL OR {blank_sql(v)} THEN {sql_literal(S.ERR_MISSING + f)} END")
    for f, domain in (
        ("event_type", S.EVENT_TYPES),
        ("device_type", S.DEVICE_TYPES),
        ("subscription_tier", S.SUBSCRIPTION_TIERS),
    ):
        codes.append(
            f"CASE WHEN NOT coalesce({fx.text[f]} IN {_in_list(domain)}, false) "
            f"THEN {sql_literal(S.ERR_UNSUPPORTED + f)} END"
        )
    for f in ("event_ts", "ingestion_ts"):
        codes.append(f"CASE WHEN ({iso_ts_sql(fx.text[f])}) IS NULL THEN {sql_literal(S.ERR_INVALID + f)} END")

    def valid_number(f: str) -> str:
        n = fx.number[f]
        return f"coalesce({n} IS NOT NULL AND NOT isnan({n}) AND {n} >= 0 AND {n} <= {S.MAX_NUMBER!r}D, false)"

    for f in S.NON_NEGATIVE_NUMBER_FIELDS:
        codes.append(f"CASE WHEN {fx.present[f]} AND NOT {valid_number(f)} THEN {sql_literal(S.ERR_NEGATIVE + f)} END")
    codes.append(
        f"CASE WHEN {valid_number('watch_seconds')} AND {valid_number('rebuffer_seconds')} "
        f"AND {fx.number['rebuffer_seconds']} > {fx.number['watch_seconds']} THEN {sql_literal(S.ERR_REBUFFER)} END"
    )
    codes.append(
        f"CASE WHEN NOT coalesce({fx.number['schema_version']} = {float(S.SUPPORTED_SCHEMA_VERSION)}, false) "
        f"THEN {sql_literal(S.ERR_UNSUPPORTED + 'schema_version')} END"
    )
    return codes


def _errors_sql(fx: Fields) -> str:
    return (
        f"CASE WHEN NOT {fx.is_json} THEN array({sql_literal(S.ERR_INVALID_JSON)}) "
        f"WHEN NOT {fx.is_object} THEN array({sql_literal(S.ERR_NOT_OBJECT)}) "
        f"ELSE array_compact(array({', '.join(_rule_codes(fx))})) END"
    )


def with_errors_from_raw(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    """Add ``errors`` plus typed event columns parsed from raw JSON text.

    Typed columns follow ``schema.event_schema()`` (timestamps stay text, see
    ``playlake.operators.layers`` for the Silver types); they are only
    meaningful on rows whose ``errors`` is empty.
    """

    keep = [c for c in df.columns if c not in S.EVENT_FIELDS and c not in ("errors", "is_valid")]
    df, fx, helpers = _variant_stage(df, raw)
    typed = []
    for field in S.event_schema().fields:
        f = field.name
        if isinstance(field.dataType, T.StringType):
            typed.append(f"try_variant_get(_v, '$.{f}', 'string') AS {f}")
        else:
            typed.append(f"try_cast({fx.number[f]} AS {field.dataType.simpleString()}) AS {f}")
    return df.selectExpr(*[f"`{c}`" for c in keep], f"{_errors_sql(fx)} AS errors", *typed)


def with_errors_typed(df: DataFrame) -> DataFrame:
    """Add ``errors`` to a frame whose event fields are already typed."""

    keep = [f"`{c}`" for c in df.columns if c not in ("errors", "is_valid")]
    return df.selectExpr(*keep, f"{_errors_sql(_typed_fields(df))} AS errors")


# The lenient profile: columns of ``from_json`` output that may not be null, and times of
# which the second may not exceed the first; missing times count as 0.
LENIENT_REQUIRED = ("event_id", "user_id", "session_id", "content_id")
LENIENT_ENUMS = {"event_type": S.EVENT_TYPES, "device_type": S.DEVICE_TYPES, "subscription_tier": S.SUBSCRIPTION_TIERS}
LENIENT_TIMES = ("watch_seconds", "rebuffer_seconds")


def lenient_sql(event_ts: str = "event_ts") -> str:
    """The weaker stream gate (profile 'lenient') as SQL; a NULL verdict counts as invalid.

    ``event_ts`` is the parsed event time. Times have no upper bound here; see
    ``scalar.micros_sql`` for what the marts make of those that no sum can hold.
    """

    times = [f"coalesce({c}, 0.0D)" for c in LENIENT_TIMES]
    rules = [
        *[f"{c} IS NOT NULL" for c in (*LENIENT_REQUIRED, f"({event_ts})")],
        *[f"{c} IN {_in_list(values)}" for c, values in LENIENT_ENUMS.items()],
        *[f"{t} >= 0.0D" for t in times],
        f"{times[1]} <= {times[0]}",
        f"schema_version = {S.SUPPORTED_SCHEMA_VERSION}",
    ]
    return f"coalesce({' AND '.join(rules)}, false)"


def lenient_condition(event_ts: str = "event_ts") -> Column:
    return F.expr(lenient_sql(event_ts))
