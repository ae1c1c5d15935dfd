"""Scalar functions of the domain, all JVM-side built-ins (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlake import schema as S

# ISO-8601 text with an explicit zone: date, 'T' or space, time, then 'Z' or
# a numeric offset. Spark's own parser alone would also accept zone-less text,
# region names and a bare time (as today's date), which the contract rejects.
ISO_TS_WITH_ZONE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"
# Blank: only white space (Unicode White_Space plus the ASCII separators).
BLANK = r"(?U)^[\s\x1c-\x1f]*$"


def sql_literal(value) -> str:
    """A Python value as a Spark SQL literal (strings escaped)."""

    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


ISO_MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mmXXX"


def iso_ts_sql(text_sql: str) -> str:
    """SQL: ISO-8601 text with a zone -> TIMESTAMP (UTC session), else NULL."""

    # One spelling for the parser: 'T' between date and time, a colon in the offset.
    plain = f"regexp_replace(replace({text_sql}, ' ', 'T'), '([+-][0-9][0-9])([0-9][0-9])$', '$1:$2')"
    return (
        f"CASE WHEN {text_sql} RLIKE {sql_literal(ISO_TS_WITH_ZONE)} THEN coalesce("
        f"try_to_timestamp({plain}), try_to_timestamp({plain}, {sql_literal(ISO_MINUTE_FORMAT)})) END"
    )


def blank_sql(text_sql: str) -> str:
    return f"{text_sql} RLIKE {sql_literal(BLANK)}"


def dbl(x: float) -> str:
    """A double literal in Spark SQL (a bare ``1.0`` would be DECIMAL)."""

    return f"{float(x)!r}D"


def ratio_or_zero_sql(numerator: str, denominator: str) -> str:
    """Mart ratio: 0 when the divisor is 0 (never raises under ANSI)."""

    return f"CASE WHEN {denominator} > 0 THEN {numerator} / {denominator} ELSE 0.0D END"


def qoe_score_sql(avg_startup_ms: str, rebuffer_ratio: str, error_rate: str) -> str:
    """0-100 explainable score; missing startup counts as no penalty."""

    return (
        f"greatest(0.0D, 100.0D"
        f" - least(coalesce({avg_startup_ms}, 0.0D) / {dbl(S.QOE_STARTUP_DIVISOR)}, {dbl(S.QOE_STARTUP_CAP)})"
        f" - least({rebuffer_ratio} * {dbl(S.QOE_REBUFFER_WEIGHT)}, {dbl(S.QOE_REBUFFER_CAP)})"
        f" - least({error_rate} * {dbl(S.QOE_ERROR_WEIGHT)}, {dbl(S.QOE_ERROR_CAP)}))"
    )


def micros_sql(value: str, factor: float = 1_000_000.0) -> str:
    """Non-negative time value -> whole micro-units (NULL -> 0), DECIMAL(28,0).

    Any value up to ``schema.MAX_SUMMED`` fits, and a sum (DECIMAL(38,0)) has room for
    10^10 of the largest: no sum overflows. Beyond it are only infinity, NaN and times of
    more than 3 * 10^13 years, which the strict contract rejects; an event that the lenient
    gate lets in with such a value is counted and adds no time.
    """

    amount = f"coalesce({value}, 0.0D)"
    return f"CAST(CASE WHEN abs({amount}) <= {S.MAX_SUMMED!r}D THEN round({amount} * {dbl(factor)}) ELSE 0.0D END AS DECIMAL(28, 0))"


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Analysis ratio: NULL when the divisor is 0 (SAFE_DIVIDE)."""

    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum(value * weight) / sum(weight), NULL on zero weight."""

    return F.try_divide(F.sum(value * weight), F.sum(weight).cast("double"))


_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp splitting constant


def _split(v: float) -> tuple[float, float]:
    c = _SPLIT * v
    hi = c - (c - v)
    return hi, v - hi


def round_half_even_sql(x: str, places: int) -> str:
    """SQL: the exact binary value of a double rounded to ``places`` decimals, ties to
    even: the result Python's ``round(x, places)`` gives.

    Spark's ``round`` rounds the JDK's decimal text of the double half-up, which
    disagrees with the exact value near ties. Here ``|x| * 10^places`` is formed with
    its exact rounding error (Dekker's product), so the fraction is compared with 0.5
    exactly; only built-in arithmetic is used.
    """

    scale = float(10**places)
    s_hi, s_lo = _split(scale)
    a = f"abs({x})"
    prod = f"({a} * {dbl(scale)})"
    c = f"({a} * {dbl(_SPLIT)})"
    a_hi = f"({c} - ({c} - {a}))"
    a_lo = f"({a} - {a_hi})"
    err = (f"((({a_hi} * {dbl(s_hi)} - {prod}) + {a_hi} * {dbl(s_lo)} + {a_lo} * {dbl(s_hi)})"
           f" + {a_lo} * {dbl(s_lo)})")
    units = f"CAST(floor({prod}) AS DOUBLE)"
    half = f"(({prod} - {units}) - 0.5D)"
    up = (f"CASE WHEN {half} > 0 THEN 1.0D WHEN {half} < 0 THEN 0.0D WHEN {err} > 0 THEN 1.0D "
          f"WHEN {err} < 0 THEN 0.0D ELSE pmod({units}, 2.0D) END")
    return (f"CASE WHEN isnan({x}) OR {a} = double('inf') THEN {x} "
            f"ELSE signum({x}) * (({units} + {up}) / {dbl(scale)}) END")


def pseudonymous_id(prefix: str, value: Column) -> Column:
    """prefix + '_' + first 12 hex digits of SHA-256 of the text."""

    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(value.cast("string"), 256), 1, 12))
