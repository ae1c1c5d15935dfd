"""Document fingerprints by winnowing (operator 5). DataFrame functions only.

A text is cut into tokens: pieces of up to PIECE letters and digits, or of up to PIECE
other visible characters, lower-cased.  The hashes of all k-grams of tokens are rolled
over in windows of w; of each window the least hash is chosen, the rightmost one if
several are least.  Any run of w + k - 1 tokens that two texts share gives them a common
fingerprint, and positions (of the k-gram, in tokens) are kept to locate it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K, WINDOW, PIECE = 5, 16, 8
#: A hash takes 32 bits and a position 31 of a long, so that the least long of a window
#: is its least hash at its rightmost position.
POSITIONS = (1 << 31) - 1


def tokens(text: Column, piece: int = PIECE) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(rf"([\p{{L}}\p{{M}}\p{{N}}]{{1,{piece}}}|[^\p{{L}}\p{{M}}\p{{N}}\s]{{1,{piece}}})"), F.lit(1))


def add_codes(df: DataFrame, text: str, out: str, k: int = K, w: int = WINDOW) -> DataFrame:
    """``df`` with ``out``: the chosen (hash, position) pairs in order of position, each
    as one long; empty without tokens.

    A text of fewer than k tokens has one k-gram of all of them; fewer than w k-grams are
    one window.  The helper columns are each used twice, which keeps Spark from moving
    them into the functions that run for every token.
    """
    df = df.withColumn("__t", tokens(F.coalesce(F.col(text), F.lit(""))))
    grams = F.greatest(F.lit(1), F.size("__t") - F.lit(k - 1))
    code = lambda h, i: F.shiftleft(F.pmod(h, F.lit(1 << 32)), 31) + (F.lit(POSITIONS) - i)
    rolled = F.transform(F.sequence(F.lit(0), grams - 1), lambda i: code(F.xxhash64(F.slice("__t", i + 1, F.lit(k))), i.cast("bigint")))
    df = df.withColumn("__h", F.when(F.size("__t") > 0, rolled).otherwise(F.array().cast("array<bigint>")))
    wide = F.transform(F.sequence(F.lit(1), F.size("__h") - F.lit(w - 1)), lambda i: F.array_min(F.slice("__h", i, F.lit(w))))
    least = F.when(F.size("__h") >= w, F.array_distinct(wide)).when(F.size("__h") > 0, F.array(F.array_min("__h"))).otherwise(F.col("__h"))
    return df.withColumn(out, least).drop("__t", "__h")


def hash_of(code: Column) -> Column:
    return F.shiftrightunsigned(code, 31)


def position_of(code: Column) -> Column:
    return (F.lit(POSITIONS) - F.pmod(code, F.lit(1 << 31))).cast("int")


def add_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = WINDOW) -> DataFrame:
    """``df`` with ``out``: array of (hash, position) in order of position."""
    pair = lambda x: F.struct(hash_of(x).alias("hash"), position_of(x).alias("position"))
    return add_codes(df, text, out, k, w).withColumn(out, F.transform(out, pair))


def hashes(codes: str) -> Column:
    return F.array_distinct(F.transform(codes, hash_of))


def text_form(codes: str) -> Column:
    """Hashes in order of position, eight hex digits each, with their positions."""
    return F.array_join(F.transform(codes, lambda x: F.concat(F.lower(F.lpad(F.hex(hash_of(x)), 8, "0")), F.lit("@"), position_of(x).cast("string"))), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two columns of distinct hashes; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def with_next(df: DataFrame, id_col: str, carry: list[str], tie: str | None = None, blocks: int = 512) -> DataFrame:
    """``df`` with ``__next``: the carried columns of the next row in descending order of id;
    after the last row comes the first.

    Ids are cut into ranges at quantiles that are ids themselves.  The rows at a cut also
    go to the range before it, so that each range finds its last row's successor within
    itself; the greatest id also goes to the end.  Rows of equal or null ids are in order
    of ``tie`` (the first carried column, if none is given), and null ids come last.
    """
    ids = df.select(F.col(id_col).alias("id"))
    if isinstance(ids.schema["id"].dataType, T.NumericType):
        cuts = F.percentile_approx("id", [x / blocks for x in range(1, blocks)], 10_000)
    else:  # ids of any other order: the quantiles of about 16 ids a block, taken by their hash
        every = max(1, ids.agg(F.approx_count_distinct("id")).first()[0] // (16 * blocks))
        some = F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64("id"), F.lit(every)) == 0, F.col("id"))))
        cuts = F.transform(F.sequence(F.lit(1), F.lit(blocks - 1)), lambda i: F.get(some, F.floor(i * F.size(some) / blocks).cast("int")))
    at = ids.agg(cuts.alias("p"), F.max("id").alias("top")).first()
    top = at["top"]
    points = sorted({x for x in (at["p"] or []) if x is not None and x != top}, reverse=True)
    # range number of an id: how many points are at least as great
    below = F.lit(0) if not points else F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p >= F.col(id_col)))
    block = F.when(F.col(id_col).isNull(), F.lit(len(points))).otherwise(below).cast("int")
    rows = df.withColumns({"__block": block, "__extra": F.lit(0)})
    first = rows.select(*[F.col(f"`{c}`") for c in carry], id_col, "__block")
    first = first.where(F.col(id_col).isin([*points]) if points else F.lit(False)).withColumns({"__block": F.col("__block") - 1, "__extra": F.lit(1)})
    again = df.select(*carry, id_col).where(F.col(id_col) == F.lit(top)).withColumns({"__block": F.lit(len(points)), "__extra": F.lit(2)})
    every = rows.unionByName(first, allowMissingColumns=True).unionByName(again, allowMissingColumns=True)
    order = ", ".join(["__extra = 2", f"`{id_col}` is null", f"`{id_col}` desc", f"`{tie or carry[0]}`"])
    value = ", ".join(f"`{c}`" for c in carry)
    found = every.withColumn("__next", F.expr(f"lead(struct({value})) over (partition by __block order by {order})"))
    out = found.where("__extra = 0").drop("__block", "__extra")
    # only null ids: no greatest id to come back to
    return out if top is not None else out.withColumn("__next", F.coalesce("__next", F.struct(*carry)))
