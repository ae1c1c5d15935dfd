"""Not-modified revisits resolved to the responses they stand for (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Headers that a 304 response may bring up to date, and query parameters that name no page.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "^(utm_[^=]*|ref|sid|sessionid|fbclid|gclid)(=|$)"
#: Ranges of time that an URL's captures are cut into.
SLICES = 256


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without trailing slashes, and the
    sorted query without tracking parameters; scheme and fragment go."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    site = F.regexp_extract(bare, "^[^/?]*", 0)
    host = F.regexp_replace(F.regexp_replace(F.lower(site), ":(80|443)$", ""), r"^www\.", "")
    rest = F.substr(bare, F.length(site) + 1)
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve(captures: DataFrame, slices: int = SLICES) -> DataFrame:
    """Each revisit of ``captures`` with the latest earlier full response of its canonical URL.

    captures: capture_id, url, ts (bigint), kind (``response`` or ``revisit``), etag,
    last_modified, headers (map of lower-case names).  Returns capture_id, canonical, ts,
    resolved_id, status and headers:

    * ``resolved``: the validators agree (entity tags by weak comparison, else dates)
    * ``unchecked``: the revisit or the response has no validator to compare
    * ``mismatch``: they differ; nothing is merged
    * ``no_response``: there is no earlier response, or no URL

    Headers are the response's, overwritten by the revisit's PERMITTED ones, for resolved
    and unchecked revisits; else the revisit's own.  A response of the same time does not
    count as earlier; of several at one time the greatest capture_id counts.  Repeated
    revisits are resolved each; rows of another kind or without a time are ignored.

    Captures of one URL may be a third of all rows: time is cut into ``slices`` ranges,
    each (URL, range) is a window of its own, and the last response of each range is
    carried into the later ones through a table of one row per URL and range.
    """
    rows = captures.where(F.col("kind").isin("response", "revisit") & F.col("ts").isNotNull()).withColumn("canonical", canonical_url(F.col("url")))
    point = F.percentile_approx("ts", [x / slices for x in range(1, slices)], 10_000)
    points = sorted(set(rows.agg(point.alias("p")).first()["p"] or []))
    part = F.lit(0) if not points else F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p <= F.col("ts")))
    rows = rows.withColumn("part", part.cast("int"))
    base = F.struct("ts", F.col("capture_id").alias("id"), "etag", "last_modified", "headers")
    rows = rows.withColumn("full", F.when(F.col("kind") == "response", base))
    # maps cannot be compared: the order is that of time and id
    last = rows.where("full is not null and canonical is not null").groupBy("canonical", "part").agg(F.max_by("full", F.struct("ts", "capture_id")).alias("tail"))
    by_url = "partition by canonical order by part"
    parts = rows.where("kind = 'revisit'").select("canonical", "part").distinct().join(last, ["canonical", "part"], "full")
    carried = parts.withColumn("before", F.expr(f"last_value(tail, true) over ({by_url} rows between unbounded preceding and 1 preceding)")).drop("tail")
    # at equal times revisits stand before responses, so that only earlier ones are seen
    order = "partition by canonical, part order by ts, kind = 'response', capture_id rows between unbounded preceding and 1 preceding"
    seen = rows.withColumn("inner", F.expr(f"last_value(full, true) over ({order})")).where("kind = 'revisit'").drop("full")
    out = seen.join(carried, ["canonical", "part"], "left").withColumn("found", F.when(F.col("canonical").isNotNull(), F.coalesce("inner", "before")))
    tag = weak(F.col("etag")) == weak(F.col("found.etag"))
    date = F.col("last_modified") == F.col("found.last_modified")
    agree = F.coalesce(tag, date)  # an entity tag decides where both have one
    status = F.when(F.col("found").isNull(), "no_response").when(agree.isNull(), "unchecked").when(agree, "resolved").otherwise("mismatch")
    own = F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    fresh = F.map_filter(own, lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce(F.col("found.headers"), F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(fresh, k))
    out = out.withColumn("status", status)
    merged = F.when(F.col("status").isin("resolved", "unchecked"), F.map_concat(kept, fresh)).otherwise(own)
    used = F.when(F.col("status").isin("resolved", "unchecked"), F.col("found.id"))
    return out.select("capture_id", "canonical", "ts", used.alias("resolved_id"), "status", merged.alias("headers"))
