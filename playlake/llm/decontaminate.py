"""Benchmark decontamination by n-gram windows (operator 7). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Distinct windows up to which the benchmark's table is broadcast: 48 bytes each, 50 MB in all.
MAX_BROADCAST_WINDOWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words: runs of ASCII letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATOR), "")


def windows(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """size, hash, window (its words) and item_ids of each distinct window of the benchmark.

    An item of fewer than n words, but not none, is one window.
    """
    w = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    flat = w.select("item", "w", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("i"))
    flat = flat.select("item", "size", F.slice("w", F.col("i"), F.col("size")).alias("window"))
    return flat.groupBy("size", F.xxhash64("window").alias("hash"), "window").agg(F.collect_set("item").alias("items"))


def find_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = WINDOW
) -> DataFrame:
    """``docs`` with ``__n_words``, ``__hit`` (sorted positions of hit words, from 0) and
    ``__items`` (sorted ids, as text, of the items of which a window occurs).

    One pass hashes the windows of each document and looks them up in the benchmark's
    hashes; only documents with a match are verified, word by word.  The benchmark's
    table is broadcast up to MAX_BROADCAST_WINDOWS windows and joined by shuffle beyond.
    Null texts have no words; rows that repeat have the same hits; null ids, clashing
    column names, an empty benchmark and empty tables are allowed.
    """
    bench = windows(items, item_id, item_text, n).cache()
    count, sizes = bench.agg(F.count("*"), F.collect_set("size")).first()
    key = F.xxhash64(F.col(id_col), F.col(text))
    # both columns are used twice, which keeps the split out of the functions below
    src = docs.select(key.alias("k"), words(F.col(text)).alias("w"))
    tested = bench.select("size", "hash").distinct()
    tested = F.broadcast(tested) if count <= MAX_BROADCAST_WINDOWS else tested
    hits = None
    for size in sorted(sizes):
        last = F.size("w") - size
        each = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("w", i + 1, F.lit(size)))))
        found = src.select("k", F.posexplode(each).alias("at", "hash")).join(tested.where(F.col("size") == size), "hash").select("k", "at", "size", "hash")
        hits = found if hits is None else hits.union(found)
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns], key.alias("__k"), words(F.col(text)).alias("__w"))
    if hits is None:
        none = out.select(*docs.columns, F.size("__w").alias("__n_words"))
        return none.withColumns({"__hit": F.array().cast("array<int>"), "__items": F.array().cast("array<string>")})
    per_doc = hits.distinct().join(bench.alias("b"), ["size", "hash"]).groupBy(F.col("k").alias("__k")).agg(F.collect_list(F.struct("at", "size", "window", "items")).alias("__found"))
    out = out.join(per_doc, "__k", "left")
    true = F.filter("__found", lambda x: F.slice("__w", x["at"] + 1, x["size"]) == x["window"])
    out = out.withColumn("__true", F.when(F.col("__found").isNotNull(), true))
    none = F.array().cast("array<int>")
    hit = F.array_distinct(F.flatten(F.transform("__true", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1))))
    named = F.array_distinct(F.flatten(F.transform("__true", lambda x: x["items"])))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size("__w").alias("__n_words"),
        F.coalesce(F.array_sort(hit), none).alias("__hit"),
        F.coalesce(F.array_sort(named), F.array().cast("array<string>")).alias("__items"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    mode: str = "spans",
    most: float = 0.5,
) -> DataFrame:
    """``docs`` without what the benchmark holds, and with the same columns.

    mode ``documents`` drops each document with a hit.  Mode ``spans`` drops documents
    of which more than the share ``most`` of the words is hit and cuts the hit words,
    with the separators between them, out of the others.
    """
    found = find_hits(docs, items, id_col, text, item_id, item_text, n)
    if mode == "documents":
        return found.where(F.size("__hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
    kept = found.where(F.size("__hit") <= F.lit(most) * F.col("__n_words"))
    # separators and words alternate: piece 2i is what stands before word i
    pattern = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    kept = kept.withColumn("__parts", F.when(F.size("__hit") > 0, F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))))
    lead = F.when(F.col("__parts")[0].rlike(f"^{SEPARATOR_ANY}"), 1).otherwise(0)
    kept = kept.withColumn("__lead", lead)
    word_of = lambda i: F.floor((i - F.col("__lead")) / 2).cast("int")
    is_word = lambda i: (i - F.col("__lead")) % 2 == 0
    # a separator goes if the words on both of its sides go
    gone = lambda i: F.when(is_word(i), F.array_contains("__hit", word_of(i))).otherwise(
        F.array_contains("__hit", word_of(i - 1)) & F.array_contains("__hit", word_of(i + 1))
    )
    rest = F.array_join(F.filter("__parts", lambda x, i: ~gone(i)), "")
    cut = F.when(F.size("__hit") > 0, rest).otherwise(F.col(text))
    return kept.select(*[(cut if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns])


SEPARATOR_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
