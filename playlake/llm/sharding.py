"""Near-equal shards of whole groups by minimax contiguous partition (operator 4).

Groups (equal texts) are ordered by a 64-bit hash.  The smallest capacity for which a
greedy pass over the ordered group sizes needs no more than the wanted number of shards
is found by binary search, and the shards are cut where that pass cuts.

The pass needs prefix sums only near its cuts.  So group sizes are added up in ranges of
the hash (``FIRST_BITS``), the search runs on these sums, and only ranges in which a cut
may lie are split further, until those are single groups: the result is that of a pass
over all groups, while the driver sees some ten thousand sums for any corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import materialize

SHARDS = 24
FIRST_BITS, MORE_BITS = 14, 6
#: Rows that get their slots in one task, about.
CELL_ROWS = 50_000


@dataclass
class Ranges:
    """Ranges of the hash in order: first hash (as unsigned), bits of its prefix, bytes, groups."""

    low: np.ndarray
    bits: np.ndarray
    size: np.ndarray
    groups: np.ndarray


def cuts(size: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Greedy pass: index of the first item of each further shard; None if more shards are needed."""
    total = np.cumsum(size)
    out, used = [], 0
    while True:
        k = int(np.searchsorted(total, used + capacity, "right"))
        if k >= len(size):
            return out
        if k == (out[-1] if out else 0) or len(out) == shards - 1:
            return None
        out.append(k)
        used = int(total[k - 1])


def smallest_capacity(size: np.ndarray, shards: int) -> int:
    low, high = max(int(size.max()), -(-int(size.sum()) // shards)), int(size.sum())
    while low < high:
        mid = (low + high) // 2
        if cuts(size, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return low


def may_hold_a_cut(r: Ranges, shards: int, largest: int) -> np.ndarray:
    """Ranges of several groups in which a cut of the best partition may lie."""
    total = np.cumsum(r.size)
    high = smallest_capacity(r.size, shards)  # whole ranges: a partition that exists
    low = max(largest, -(-int(total[-1]) // shards))  # no partition can be better
    open_ = np.zeros(len(r.size), bool)
    at = 0
    for k in range(1, shards):
        # the k-th cut lies beyond what whole ranges reach with the low capacity ...
        i = int(np.searchsorted(total, at + low, "right"))
        at = int(total[i - 1]) if i else 0
        # ... and not beyond k times the high one
        j = int(np.searchsorted(total, k * high, "right"))
        open_[i : j + 1] = True
    return open_ & (r.groups > 1)


def split_points(groups: DataFrame, shards: int = SHARDS) -> list[int]:
    """Hashes (signed) at which shards 1, 2, ... begin; ``groups`` has ``key`` and ``size``."""
    bounds = groups.agg(F.max("size").alias("m"), F.count("*").alias("n")).first()
    if not bounds["n"]:
        return []

    def sums(part: DataFrame, bits: int) -> Ranges:
        cell = F.expr(f"shiftrightunsigned(key ^ (-9223372036854775807L - 1), {64 - bits})") if bits < 64 else F.expr("key ^ (-9223372036854775807L - 1)")
        rows = part.groupBy(cell.alias("c")).agg(F.sum("size").alias("s"), F.count("*").alias("n")).toArrow()
        c = rows.column("c").to_numpy().astype(np.int64).view(np.uint64)
        low = c << np.uint64(64 - bits) if bits < 64 else c
        order = np.argsort(low)
        pick = lambda x: rows.column(x).to_numpy().astype(np.int64)[order]
        return Ranges(low[order], np.full(len(low), bits), pick("s"), pick("n"))

    r = sums(groups, FIRST_BITS)
    while (todo := may_hold_a_cut(r, shards, int(bounds["m"]))).any():
        more = []
        for bits in np.unique(r.bits[todo]):
            wide = np.flatnonzero(todo & (r.bits == bits))
            low = groups.sparkSession.createDataFrame([(int(x),) for x in (r.low[wide] >> np.uint64(64 - int(bits))).astype(np.int64)], "c bigint")
            cell = F.expr(f"shiftrightunsigned(key ^ (-9223372036854775807L - 1), {64 - int(bits)})")
            part = groups.withColumn("c", cell).join(F.broadcast(low), "c").drop("c")  # ranges near cuts only
            more.append(sums(part, min(64, int(bits) + MORE_BITS)))
        parts = [Ranges(*(x[~todo] for x in (r.low, r.bits, r.size, r.groups))), *more]
        r = Ranges(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("low", "bits", "size", "groups")))
        order = np.argsort(r.low)
        r = Ranges(*(x[order] for x in (r.low, r.bits, r.size, r.groups)))
    best = cuts(r.size, smallest_capacity(r.size, shards), shards)
    return [int(x) for x in (r.low[best] ^ np.uint64(1 << 63)).view(np.int64)]


def shard(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS, overhead: int = 8) -> DataFrame:
    """id, size, text_crc32, shard and slot of each row.

    A row's size is its text's UTF-8 bytes plus ``overhead``; a null text counts as empty.
    Rows of equal texts share a shard.  slot numbers the rows of a shard from 0 without
    gaps; it follows a hash of the row, so a group of copies is numbered by many tasks.
    There may be fewer shards than wanted if there are fewer groups.  Null and repeated
    ids are rows like others; other columns are ignored.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"), (F.length(raw) + overhead).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("key")
    )
    rows = materialize(rows, "rows")
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "groups")
    points = split_points(groups, shards)
    number = sum(((F.col("key") >= p).cast("int") for p in points), F.lit(0))
    n = groups.agg(F.sum("n")).first()[0] or 0
    cells = max(1, -(-n // (CELL_ROWS * shards)))
    placed = rows.withColumn("shard", number).withColumn("cell", F.pmod(F.xxhash64("id", "key"), F.lit(cells)))
    count = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    base = count.select("shard", "cell", F.expr("sum(n) over (partition by shard order by cell) - n").alias("base"))
    rank = F.expr("row_number() over (partition by shard, cell order by id, key) - 1")
    return placed.withColumn("rank", rank).join(base, ["shard", "cell"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).cast("bigint").alias("slot")
    )
