"""Engagement and QoE measures: one list of aggregates plus a finalise step.

Aggregates are built-in declarative functions, so Spark plans a map-side
partial aggregate before every shuffle. Time is summed in whole
microseconds (DECIMAL, which no sum of valid values overflows): exact, order-independent (a replayed or re-partitioned batch
gives bit-identical marts) The stored marts
keep those sums and the startup sample count next to the published
measures, so rates can be recombined exactly at any coarser grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.functions.scalar import micros_sql, qoe_score_sql, ratio_or_zero_sql, round_half_even_sql


#: Size of a viewers sketch: 2**12 buckets, about 1.6 % standard error once it is full.
SKETCH_LG_K = 12
SKETCH = "viewers_sketch"


def viewers_bound(exact: str) -> str:
    """SQL: how far a sketch's estimate may be off, four standard errors and never below 1."""

    return f"greatest(1.0D, {4 * 1.04 / 2 ** (SKETCH_LG_K / 2)!r}D * {exact})"


def measure_aggregates_sql(exact_viewers: bool = True) -> list[str]:
    """Aggregates over Silver rows (A1, A2, A4/A5, A6, A7 parts), as SQL.

    Exact viewers are a distinct count; else they are a HyperLogLog sketch, which streams can
    keep and which rolls up to coarser groups (``recombine``).
    """

    viewers = "count(DISTINCT user_id) AS unique_viewers" if exact_viewers else f"hll_sketch_agg(user_id, {SKETCH_LG_K}) AS {SKETCH}"
    return [
        "count(1) AS event_count",
        "count_if(event_type = 'playback_started') AS plays",
        viewers,
        "count_if(event_type = 'playback_completed') AS completes",
        "count_if(event_type = 'playback_error') AS playback_errors",
        f"coalesce(sum({micros_sql('watch_seconds')}), 0) AS watch_micros",
        f"coalesce(sum({micros_sql('rebuffer_seconds')}), 0) AS rebuffer_micros",
        f"coalesce(sum({micros_sql('startup_ms', 1000.0)}), 0) AS startup_micros",
        "count(startup_ms) AS startup_samples",
    ]


def measure_aggregates(exact_viewers: bool = True) -> list[Column]:
    return [F.expr(a) for a in measure_aggregates_sql(exact_viewers)]


FINALISE_SQL = [
    "CAST(watch_micros AS DOUBLE) / 3600000000.0D AS watch_hours",
    f"{ratio_or_zero_sql('completes', 'plays')} AS completion_rate",
    f"{ratio_or_zero_sql('playback_errors', 'plays')} AS error_rate",
    f"{ratio_or_zero_sql('CAST(rebuffer_micros AS DOUBLE)', 'CAST(watch_micros AS DOUBLE)')} AS rebuffer_ratio",
    "CASE WHEN startup_samples > 0 THEN (CAST(startup_micros AS DOUBLE) / 1000.0D) / startup_samples END AS avg_startup_ms",
]


def finalise(df: DataFrame) -> DataFrame:
    """Rates guarded to 0 on a zero divisor, mean startup NULL without
    samples (0 inside the score), and the QoE score; all unrounded."""

    derived = {"watch_hours", "completion_rate", "error_rate", "rebuffer_ratio", "avg_startup_ms", "qoe_score"}
    keep = [f"`{c}`" for c in df.columns if c not in derived]
    if SKETCH in df.columns and "unique_viewers" not in df.columns:
        keep.append(f"hll_sketch_estimate({SKETCH}) AS unique_viewers")
    df = df.selectExpr(*keep, *FINALISE_SQL)
    return df.selectExpr("*", f"{qoe_score_sql('avg_startup_ms', 'rebuffer_ratio', 'error_rate')} AS qoe_score")


def mart_columns(keys: tuple[str, ...], with_title: bool, exact_viewers: bool = True) -> list[str]:
    cols = list(keys)
    if with_title:
        cols.insert(cols.index("content_id") + 1, "content_title")
    return cols + list(S.MEASURES) + list(S.RECOMBINABLE) + ([] if exact_viewers else [SKETCH])


def serve(mart: DataFrame) -> DataFrame:
    """Served form: rounded like the published marts (Python rounding of the
    exact value), 0 for a missing mean startup and 'Unknown' for a missing
    title. Stored marts stay unrounded."""

    rounding = {
        "watch_hours": ("watch_hours", S.ROUND_HOURS),
        "completion_rate": ("completion_rate", S.ROUND_RATE),
        "error_rate": ("error_rate", S.ROUND_RATE),
        "rebuffer_ratio": ("rebuffer_ratio", S.ROUND_RATE),
        "avg_startup_ms": ("coalesce(avg_startup_ms, 0.0D)", S.ROUND_STARTUP),
        "qoe_score": ("qoe_score", S.ROUND_SCORE),
    }
    out = mart.selectExpr(
        *[f"{round_half_even_sql(*rounding[c])} AS {c}" if c in rounding else f"`{c}`" for c in mart.columns]
    )
    if "content_title" in mart.columns:
        out = out.withColumn("content_title", F.coalesce(F.col("content_title"), F.lit(S.UNKNOWN_TITLE)))
    return out


def serve_ordered(mart: DataFrame, keys: list[str]) -> DataFrame:
    """The served form in key order (a sort by ranges of the key; T4)."""

    return serve(mart).orderBy(*keys)


def recombine(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Roll a stored mart up to coarser ``keys`` exactly.

    Viewers are not additive: with a sketch in the mart they are estimated from the union of
    the sketches, which is kept for the next roll-up; without one they come out as a sum of
    segments.
    """

    sketched = SKETCH in parts.columns
    viewers = F.expr(f"hll_union_agg({SKETCH}) AS {SKETCH}") if sketched else F.sum("unique_viewers").alias("unique_viewers")
    agg = parts.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        F.sum("plays").alias("plays"),
        viewers,
        F.sum("completes").alias("completes"),
        F.sum("playback_errors").alias("playback_errors"),
        F.sum("watch_micros").alias("watch_micros"),
        F.sum("rebuffer_micros").alias("rebuffer_micros"),
        F.sum("startup_micros").alias("startup_micros"),
        F.sum("startup_samples").alias("startup_samples"),
    )
    return finalise(agg)
