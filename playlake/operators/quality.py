"""Run summary, quality gate, reconciliation and monitoring measures.

All results are small DataFrames built from distributed aggregates; nothing
is collected to the driver except by ``enforce_gate``, which reads the one
status row it has to act on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions.scalar import iso_ts_sql, sql_literal
from playlake.operators.idfilter import not_stored
from playlake.operators.quantiles import RANK_ERROR, estimates, exact_quantiles, quantile_sketches, rolled_up
from playlake.session import materialize

SUMMARY_REQUIRED = ("run_id", "input_records", "valid_records", "quarantined_records", "quality_pass_rate")
DEFAULT_MIN_PASS_RATE = 0.98
RECONCILIATION_TOLERANCE = 0.0001


def _one_row(metrics: list[tuple[str, DataFrame]]) -> DataFrame:
    """Combine single-value frames ``(name, value)`` into one wide row with a
    union and a global aggregate (no cross join)."""

    long = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("metric"), F.col("value").cast("long").alias("value")) for name, df in metrics],
    )
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n, _ in metrics])


def run_summary(classified: DataFrame, run_id: str, order: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """Counts in / valid / duplicate / quarantined / mart rows and the pass
    rate valid / input (duplicates lower it), rounded to 4 places.

    One pass over the classified rows, two aggregates, no window:
    1. per event id: how many valid and invalid copies arrived, and the mart
       keys of the first valid arrival (``min_by`` over the arrival order,
       the Silver rule). Copies of one id are combined map-side before the
       shuffle, so a retry storm on a single id costs one row per map task;
    2. over those per-id rows: every count, with the mart row counts as the
       distinct grouping keys of first arrivals (exactly the mart rows).
    """

    arrival = "struct(" + ", ".join(f"`{c}`" for c in order) + ")"
    ts = iso_ts_sql("event_ts")
    keys = (
        f"struct(to_date({ts}) AS day, date_trunc('hour', {ts}) AS hour, content_id, country, "
        "subscription_tier, device_type)"
    )
    per_id = classified.groupBy("event_id").agg(
        F.expr("count_if(is_valid) AS valid_copies"),
        F.expr("count_if(NOT is_valid) AS invalid_copies"),
        F.expr(f"min_by(CASE WHEN is_valid THEN {keys} END, CASE WHEN is_valid THEN {arrival} END) AS k"),
    )
    counts = per_id.agg(
        F.expr("sum(valid_copies + invalid_copies) AS input_records"),
        F.expr("count_if(valid_copies > 0) AS valid_records"),
        F.expr("sum(valid_copies) - count_if(valid_copies > 0) AS duplicate_records"),
        F.expr("sum(invalid_copies) AS quarantined_records"),
        F.expr(
            "count(DISTINCT CASE WHEN valid_copies > 0 THEN struct(k.day, k.content_id, k.country, "
            "k.subscription_tier, k.device_type) END) AS gold_content_daily_rows"
        ),
        F.expr(
            "count(DISTINCT CASE WHEN valid_copies > 0 THEN struct(k.hour, k.country, k.device_type) END)"
            " AS gold_platform_hourly_rows"
        ),
    )
    return counts.selectExpr(
        f"{sql_literal(run_id)} AS run_id",
        "coalesce(input_records, 0) AS input_records",
        "valid_records",
        "coalesce(duplicate_records, 0) AS duplicate_records",
        "coalesce(quarantined_records, 0) AS quarantined_records",
        "gold_content_daily_rows",
        "gold_platform_hourly_rows",
        "coalesce(round(try_divide(CAST(valid_records AS DOUBLE), CAST(input_records AS DOUBLE)), 4), 0.0D)"
        " AS quality_pass_rate",
    )


def run_summary_from_tables(
    classified: DataFrame, silver: DataFrame, content_daily: DataFrame, platform_hourly: DataFrame, run_id: str
) -> DataFrame:
    """The same summary from already written layers (batch run): counts of
    the stored tables, cheap because each is a separate small aggregate."""

    counts = classified.agg(
        F.count(F.lit(1)).alias("input_records"),
        F.count_if(F.col("is_valid")).alias("valid_candidates"),
        F.count_if(~F.col("is_valid")).alias("quarantined_records"),
    )
    wide = _one_row(
        [
            ("input_records", counts.select(F.col("input_records").alias("value"))),
            ("valid_candidates", counts.select(F.col("valid_candidates").alias("value"))),
            ("quarantined_records", counts.select(F.col("quarantined_records").alias("value"))),
            ("valid_records", silver.agg(F.count(F.lit(1)).alias("value"))),
            ("gold_content_daily_rows", content_daily.agg(F.count(F.lit(1)).alias("value"))),
            ("gold_platform_hourly_rows", platform_hourly.agg(F.count(F.lit(1)).alias("value"))),
        ]
    )
    return wide.selectExpr(
        f"{sql_literal(run_id)} AS run_id",
        "input_records",
        "valid_records",
        "valid_candidates - valid_records AS duplicate_records",
        "quarantined_records",
        "gold_content_daily_rows",
        "gold_platform_hourly_rows",
        "coalesce(round(try_divide(CAST(valid_records AS DOUBLE), CAST(input_records AS DOUBLE)), 4), 0.0D)"
        " AS quality_pass_rate",
    )


def gate(summary: DataFrame, min_pass_rate: float = DEFAULT_MIN_PASS_RATE) -> DataFrame:
    """One status row: PASS when every required key is there and the pass
    rate reaches the minimum, else FAIL with the reason."""

    missing = sorted(set(SUMMARY_REQUIRED) - set(summary.columns))
    checked_at = F.current_timestamp().alias("checked_at")
    if missing:
        return summary.limit(1).select(
            F.lit("FAIL").alias("status"),
            (F.col("run_id") if "run_id" in summary.columns else F.lit(None).cast("string")).alias("run_id"),
            F.lit(None).cast("double").alias("quality_pass_rate"),
            F.lit(float(min_pass_rate)).alias("min_pass_rate"),
            F.lit("summary contract missing keys: " + ", ".join(missing)).alias("reason"),
            checked_at,
        )
    rate = F.col("quality_pass_rate").cast("double")
    ok = F.coalesce(rate >= F.lit(float(min_pass_rate)), F.lit(False))
    return summary.select(
        F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.col("run_id").cast("string").alias("run_id"),
        rate.alias("quality_pass_rate"),
        F.lit(float(min_pass_rate)).alias("min_pass_rate"),
        F.when(ok, F.lit(None).cast("string"))
        .otherwise(F.format_string("quality pass rate %.4f is below the %.4f threshold", rate, F.lit(float(min_pass_rate))))
        .alias("reason"),
        checked_at,
    )


class QualityGateFailed(RuntimeError):
    pass


def enforce_gate(status: DataFrame) -> dict:
    """Raise on FAIL; return the audit record on PASS (one row to driver)."""

    row = status.first()
    if row is None:
        raise QualityGateFailed("no run summary")
    record = row.asDict()
    if record["status"] != "PASS":
        raise QualityGateFailed(record["reason"])
    return record


def publish_audit(status: DataFrame, path: str) -> None:
    """Append the gate's status row (status, run_id, rate, reason,
    checked_at) to an audit table, PASS or FAIL."""

    status.write.mode("append").option("ignoreNullFields", "false").json(path)


def reconciliation(silver: DataFrame, marts: dict[str, DataFrame], tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """Per mart: Silver events vs the sum of the mart's event_count."""

    # One row per mart plus one Silver row (at most a handful of rows); the
    # Silver count is spread to the mart rows by a window over that union.
    long = reduce(
        DataFrame.unionByName,
        [silver.agg(F.lit(None).cast("string").alias("mart"), F.count(F.lit(1)).cast("long").alias("events"))]
        + [
            m.agg(F.lit(name).alias("mart"), F.coalesce(F.sum("event_count"), F.lit(0)).cast("long").alias("events"))
            for name, m in marts.items()
        ],
    )
    everything = Window.partitionBy(F.lit(0))
    joined = long.withColumn(
        "silver_events", F.max(F.when(F.col("mart").isNull(), F.col("events"))).over(everything)
    ).where(F.col("mart").isNotNull()).withColumnRenamed("events", "mart_events")
    diff = F.col("mart_events") - F.col("silver_events")
    rel = F.coalesce(F.try_divide(F.abs(diff).cast("double"), F.col("silver_events").cast("double")), F.lit(0.0))
    return joined.select(
        "mart",
        "silver_events",
        "mart_events",
        diff.alias("difference"),
        rel.alias("relative_difference"),
        (rel < F.lit(tolerance)).alias("within_tolerance"),
    )


def duplicate_rate(classified: DataFrame, silver: DataFrame) -> DataFrame:
    """Share of valid arrivals that were duplicates, and the residual
    duplicate rate left in Silver (target < 0.1 %)."""

    valid = classified.where(F.col("is_valid")).agg(
        F.count(F.lit(1)).alias("value")
    )
    s = silver.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("d"))
    wide = _one_row(
        [
            ("valid_arrivals", valid),
            ("silver_rows", s.select(F.col("n").alias("value"))),
            ("silver_distinct_ids", s.select(F.col("d").alias("value"))),
        ]
    )
    return wide.select(
        "valid_arrivals",
        "silver_rows",
        "silver_distinct_ids",
        (F.col("valid_arrivals") - F.col("silver_rows")).alias("duplicates_removed"),
        F.coalesce(
            F.try_divide((F.col("valid_arrivals") - F.col("silver_rows")).cast("double"), F.col("valid_arrivals").cast("double")),
            F.lit(0.0),
        ).alias("arrival_duplicate_rate"),
        F.coalesce(
            F.try_divide((F.col("silver_rows") - F.col("silver_distinct_ids")).cast("double"), F.col("silver_rows").cast("double")),
            F.lit(0.0),
        ).alias("silver_duplicate_rate"),
    )


SKEW_KEYS = ("content_id", "country", "device_type", "subscription_tier")
#: Values that a sketch of heavy values keeps; any value with more than about 1.4 / 4096 of
#: all rows is among them.
TRACKED = 4096


def heavy_candidates(rows: DataFrame, keys=SKEW_KEYS, tracked: int = TRACKED) -> DataFrame:
    """(key_name, key_value) of at most ``tracked`` values a key, all heavy ones among them.

    One pass and no shuffle of values: each task keeps a frequent-items sketch for each key,
    and the sketches are combined. NULL is a value.
    """

    coded = {k: f"coalesce(concat('=', CAST(`{k}` AS STRING)), '')" for k in keys}
    sketches = rows.agg(*[F.expr(f"approx_top_k_accumulate({c}, {tracked}) AS `{k}`") for k, c in coded.items()])
    named = [
        f"transform(approx_top_k_estimate(`{k}`, {tracked}), x -> named_struct('key_name', {sql_literal(k)}, 'item', x.item))" for k in keys
    ]
    items = F.explode(F.expr(f"concat({', '.join(named)})"))
    out = sketches.select(items.alias("c")).select("c.key_name", "c.item")
    return out.select("key_name", F.when(F.col("item") != "", F.substr("item", F.lit(2), F.length("item"))).alias("key_value"))


def key_skew(silver: DataFrame, keys=SKEW_KEYS, top: int = 3, tracked: int = TRACKED) -> DataFrame:
    """Top ``top`` values per key by share of events (a top-k report).

    Candidates come from sketches of bounded memory; a second pass counts them exactly. Each
    row gives one (key, value) pair per key, and pairs that are no candidate leave before the
    grouped count, so only candidates are shuffled and ranked (``tracked`` a key at most).
    """

    pairs = F.explode(
        F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("key_value")) for k in keys])
    )
    rows = silver.select(*keys)
    flat = rows.select(pairs.alias("_p")).select("_p.key_name", "_p.key_value")
    few = heavy_candidates(rows, keys, tracked).select(F.col("key_name").alias("_k"), F.col("key_value").alias("_v"))
    # at most keys x tracked rows: a proven bound for the broadcast
    candidate = (F.col("key_name") == F.col("_k")) & F.col("key_value").eqNullSafe(F.col("_v"))
    per_key = flat.join(F.broadcast(few), candidate, "left_semi").groupBy("key_name", "key_value").agg(F.count(F.lit(1)).alias("events"))
    total = flat.groupBy("key_name").agg(F.count(F.lit(1)).alias("total_events"))
    rank = F.row_number().over(Window.partitionBy("key_name").orderBy(F.col("events").desc(), F.col("key_value").asc_nulls_last()))
    best = per_key.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(total, "key_name").select(
        "key_name",
        "key_value",
        "events",
        (F.col("events") / F.col("total_events")).alias("share"),
        F.col("rank").cast("int").alias("rank"),
    )


def lag_seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


LAG_POINTS = (0.5, 0.95)


def lag_rows(silver: DataFrame) -> DataFrame:
    """window_start and lag_seconds (hand-off less event time) of each event."""

    lag = lag_seconds(F.col("source_ingestion_ts"), F.col("event_ts"))
    return silver.select(F.date_trunc("hour", "event_ts").alias("window_start"), lag.alias("lag_seconds"))


def ingestion_lag(silver: DataFrame) -> DataFrame:
    """Per event hour: events, mean, median, 95th percentile and maximum of the client's
    hand-off lag, exact. ``silver`` is read three times: pass a stored table."""

    rows = lag_rows(silver)
    plain = rows.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("events"), F.avg("lag_seconds").alias("avg_lag_seconds"), F.max("lag_seconds").alias("max_lag_seconds")
    )
    sketches = materialize(quantile_sketches(rows, ["window_start"], "lag_seconds"), "lag-sketches")
    points = exact_quantiles(rows, ["window_start"], "lag_seconds", list(LAG_POINTS), sketches)
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("exact"))).alias(f"p{round(100 * p)}_lag_seconds")
    wide = points.groupBy("window_start").agg(*[at(p) for p in LAG_POINTS])
    out = plain.join(wide, "window_start", "left")
    return out.select("window_start", "events", "avg_lag_seconds", "p50_lag_seconds", "p95_lag_seconds", "max_lag_seconds")


def lag_by_day(silver: DataFrame) -> DataFrame:
    """Per event day and probability: events, the exact lag, and whether the estimate of the
    day's sketch, merged from those of its hours, is within ``RANK_ERROR`` ranks of it.

    ``silver`` is read three times: pass a stored table.
    """

    rows = lag_rows(silver)
    hours = materialize(quantile_sketches(rows, ["window_start"], "lag_seconds"), "lag-hours")
    days = materialize(rolled_up(hours.withColumn("event_date", F.to_date("window_start")), ["event_date"]), "lag-days")
    daily = rows.withColumn("event_date", F.to_date("window_start"))
    exact = exact_quantiles(daily, ["event_date"], "lag_seconds", list(LAG_POINTS), days)
    guess = estimates(days, ["event_date"], list(LAG_POINTS))
    # the estimate's true rank: values below it, and up to it
    ranks = daily.join(guess, "event_date").groupBy("event_date", "probability").agg(
        F.avg((F.col("lag_seconds") < F.col("estimate")).cast("double")).alias("below"),
        F.avg((F.col("lag_seconds") <= F.col("estimate")).cast("double")).alias("upto"),
    )
    close = (F.col("below") - RANK_ERROR <= F.col("probability")) & (F.col("upto") + RANK_ERROR >= F.col("probability"))
    return exact.join(ranks, ["event_date", "probability"]).select(
        "event_date", "probability", F.col("values").alias("events"), F.col("exact").alias("lag_seconds"), close.alias("estimate_within_bound")
    )


def late_audit(classified: DataFrame, silver: DataFrame) -> DataFrame:
    """Valid Bronze events whose id never reached Silver (e.g. dropped as
    late by a stream's watermark): the correction set to replay."""

    valid = classified.where(F.col("is_valid"))
    return valid.join(silver.select("event_id"), "event_id", "left_anti")


def late_audit_stored(valid: DataFrame, silver: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The same from stored tables (Silver layout), with the id filter in front: ids that it does
    not know are missing for certain, the others are looked up in their days."""

    return not_stored(valid, silver, filters, buckets)


FRESHNESS_KEYS = ("window_start", "content_id", "country", "subscription_tier", "device_type")


def freshness(
    silver: DataFrame, update_log: DataFrame, within_seconds: int = 300, keys: tuple[str, ...] = FRESHNESS_KEYS
) -> DataFrame:
    """Per event day: events, how many their mart row showed within ``within_seconds`` of their
    hand-off, how many it never showed, the share and the longest delay.

    ``update_log`` is append-only: a row (keys, ``updated_at``) each time a mart row was
    written. An event is visible from the first update *at or after* its hand-off; an earlier
    one cannot hold it. Events are added up by mart row and hand-off time before the join, and
    a mart row's updates are one sorted list (as many as batches wrote that hour), so a busy
    mart row is neither a window nor a product. A NULL key is a key like any other.
    """

    handed = (
        silver.withColumn("window_start", F.date_trunc("hour", "event_ts"))
        .groupBy("event_date", *keys, F.col("source_ingestion_ts").alias("handed_at"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    updates = update_log.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.array_sort(F.collect_set("updated_at")).alias("updates")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = handed.join(updates, reduce(lambda a, b: a & b, same), "left")
    # get: NULL beyond the end, and no error
    shown = F.get(F.filter("updates", lambda u: u >= F.col("handed_at")), F.lit(0))
    joined = joined.select("event_date", "events", lag_seconds(shown, F.col("handed_at")).alias("delay"))
    in_time = F.sum(F.when(F.col("delay") <= within_seconds, F.col("events")).otherwise(0))
    return joined.groupBy("event_date").agg(
        F.sum("events").alias("events"),
        in_time.alias("within_target"),
        F.sum(F.when(F.col("delay").isNull(), F.col("events")).otherwise(0)).alias("never_visible"),
        (in_time / F.sum("events")).alias("share_within_target"),
        F.max("delay").alias("max_delay_seconds"),
    )
