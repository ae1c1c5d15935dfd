"""Which of these events are stored already? Bitmaps of stored ids in front of an anti join.

A day's ids set bits in ``buckets`` bitmaps of 32,768 bits (a blocked Bloom filter: an id
falls into one bucket and sets ``PROBES`` bits of it). The filter is a small table (day,
bucket, bitmap) built by grouped aggregates; filters of several writes are combined by OR.
An id with a bit missing is new for certain and passes by. Only the others meet the stored
ids, and only those of the days they fall on, so a repeat-free batch reads no stored id.
The result is exact whatever the fill: a full filter costs time, never rows.

An event and its repeat carry the same event day (the day is part of what is repeated).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap (fixed by Spark's bitmap functions) and bits set by an id.
BITS, PROBES = 32768, 4
#: A bucket holds about this many ids at a false-positive rate near 2 %.
IDS_PER_BUCKET = 4000


def buckets_for(ids_per_day: int) -> int:
    return max(1, -(-int(ids_per_day) // IDS_PER_BUCKET))


def _bucket(id_: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), id_), F.lit(buckets)).cast("int")


def _probes(id_: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), id_), F.lit(BITS)) for i in range(PROBES)]


def id_filter(ids: DataFrame, buckets: int, id_col: str = "event_id", day: str = "event_date") -> DataFrame:
    """(day, bucket, bitmap) of the ids of a table."""

    bits = ids.select(
        F.col(day), _bucket(F.col(id_col), buckets).alias("bucket"), F.explode(F.array(*_probes(F.col(id_col)))).alias("bit")
    )
    return bits.groupBy(day, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def combined(filters: DataFrame, day: str = "event_date") -> DataFrame:
    """Filters of several writes as one (they must have the same number of buckets)."""

    return filters.groupBy(day, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _has(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))) > 0


def maybe_stored(rows: DataFrame, filters: DataFrame, buckets: int, id_col: str = "event_id", day: str = "event_date") -> DataFrame:
    """``rows`` with ``_maybe``: false only if the id is not among those of the filter."""

    table = filters.select(F.col(day).alias("_day"), F.col("bucket").alias("_bucket"), "bitmap")
    at = rows.withColumn("_at", _bucket(F.col(id_col), buckets))
    joined = at.join(table, F.col(day).eqNullSafe(F.col("_day")) & (F.col("_at") == F.col("_bucket")), "left")
    found = reduce(lambda a, b: a & b, [_has(F.col("bitmap"), p) for p in _probes(F.col(id_col))])
    return joined.withColumn("_maybe", F.coalesce(found, F.lit(False))).drop("_at", "_day", "_bucket", "bitmap")


def not_stored(
    rows: DataFrame, stored: DataFrame, filters: DataFrame, buckets: int, id_col: str = "event_id", day: str = "event_date"
) -> DataFrame:
    """The rows whose id is not stored. ``rows`` is read three times: pass a written table.

    The stored ids are read only between the first and last day that a doubtful row falls on
    (two values on the driver), which prunes a table partitioned by day.
    """

    marked = maybe_stored(rows, filters, buckets, id_col, day)
    doubtful = marked.where("_maybe").drop("_maybe")
    first, last = doubtful.agg(F.min(day), F.max(day)).first()
    new = marked.where("NOT _maybe").drop("_maybe")
    if first is None:
        return new
    near = stored.where(F.col(day).between(F.lit(first), F.lit(last))).select(F.col(id_col), F.col(day))
    return new.unionByName(doubtful.join(near, [id_col, day], "left_anti").select(*new.columns))
