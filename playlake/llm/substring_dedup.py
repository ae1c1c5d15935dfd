"""Removal of paragraphs that repeat within and across documents (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm import near
from playlake.llm import words as W
from playlake.llm.common import drop_tables, hash_filter, join_hot, materialize, recording
from playlake.llm.passages import passages

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: A paragraph of fewer words has no whole n-gram and is never a repeat: headings and greetings stay.
MIN_WORDS = NGRAM
#: Characters of a word, as in ``words``.
WORD = r"0-9A-Za-z\x{80}-\x{10FFFF}"


def paragraphs(docs: DataFrame, id_col: str, text: str, min_words: int) -> DataFrame:
    """id, h (hash of the whole text), pos and text of each line of min_words words or more."""
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.split(text, "\n").alias("lines"))
    flat = src.select("id", "h", F.posexplode("lines").alias("pos", "text"))
    return flat.where(F.col("text").rlike(f"^(?:[^{WORD}]*+[{WORD}]++){{{min_words}}}"))


def repeats(units: DataFrame, ngram: int, threshold: float, recall: float, min_words: int) -> DataFrame:
    """id, h, pos, gone and kept (id whose unit stays) of each unit that belongs to a component of links.

    units: id, h, pos and text.  Of each component the unit of the least (id, h, pos) stays.
    """
    bands, rows = W.choose_bands(threshold, recall)
    sig = near.signatures(units, ["id", "h", "pos"], "text", ngram, bands, rows)
    sig = sig.where(F.col("n") >= max(1, min_words - ngram + 1))
    keys, distinct, prints = near.keyed(sig, ["id", "h", "pos"])
    classes = near.linked_groups(distinct, prints, units, ["id", "h", "pos"], "text", ngram, threshold, bands, rows)
    classes = materialize(classes.where("links > 0").select("key", "root"), "linked")
    maybe = hash_filter(classes.select(F.xxhash64("key").alias("x")), "x")
    found = join_hot(keys.where(maybe(F.xxhash64("key"))), classes, "key")
    found = materialize(found.select("id", "h", "pos", "root"), "classes")
    first = found.groupBy("root").agg(F.min(F.struct("id", "h", "pos")).alias("first"))
    return join_hot(found, first, "root").select("id", "h", "pos", (F.struct("id", "h", "pos") != F.col("first")).alias("gone"), F.col("first.id").alias("kept"))


def marked(docs: DataFrame, id_col: str, text: str, per_doc: DataFrame, cut: Column, added: list[str]) -> DataFrame:
    """The rows of ``docs`` with the columns ``added`` of their mark (``__id``, ``__h``), null if they
    have none, and the text ``cut`` for those that have one; rows without a mark take no part in the join."""
    per_doc = materialize(per_doc, "marks")
    maybe = hash_filter(per_doc.select(F.xxhash64("__id", "__h").alias("x")), "x")
    rows = docs.withColumn("__hash", F.xxhash64(text)).withColumn("__maybe", maybe(F.xxhash64(id_col, "__hash")))
    rest = rows.where("__maybe").join(per_doc, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")), "left")
    new = F.when(F.col("__id").isNotNull() | F.col("__h").isNotNull(), cut).otherwise(F.col(f"`{text}`"))
    rest = rest.select(*[(new if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns], *added)
    kinds = dict(per_doc.dtypes)
    other = rows.where("not __maybe").select(*[F.col(f"`{c}`") for c in docs.columns], *[F.lit(None).cast(kinds[c]).alias(c) for c in added])
    return other.unionAll(rest)


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    ngram: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The rows of ``docs`` with repeated paragraphs taken out, and what was found.

    Paragraphs are lines of at least ``min_words`` words.  Two are linked when the
    Jaccard similarity of their sets of word n-grams is at least ``threshold``
    (candidates by MinHash banding, bands tuned for ``recall`` at the threshold,
    verified exactly); links are followed to components.  Of each component the
    paragraph of the least (id, text hash, position) stays, all others go.

    What remains is then searched in the same way for passages inside lines or across
    them (``passages``): their edges are given by the windows of words that repeat.

    Added columns: ``__n_shared`` (paragraphs that belong to a component), ``__removed``
    (positions of the lines that went), ``__passages`` (what went of the rest: start and
    end in code points of the text without those lines), ``__kept_in`` (ids whose paragraph
    stays for each component the document takes part in).  All columns of ``docs`` stay,
    also ones whose names clash with the working columns.

    A null text stays null and an empty one empty.  Rows of equal id and text count as
    one document.  A document may end up with an empty text; it is not dropped here.
    """
    working: list[str] = []
    with recording(working):
        units = paragraphs(docs, id_col, text, min_words)
        found = repeats(units, ngram, threshold, recall, min_words)
        per_doc = found.groupBy(F.col("id").alias("__id"), F.col("h").alias("__h")).agg(
            F.countDistinct("pos").alias("__n_lines"),
            F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("pos")))).alias("__removed"),
            F.collect_set("kept").alias("__lines_in"),
        )
        lines = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("__removed", i))
        cut = F.when(F.size("__removed") > 0, F.array_join(lines, "\n")).otherwise(F.col(f"`{text}`"))
        rest = marked(docs, id_col, text, per_doc, cut, ["__n_lines", "__removed", "__lines_in"])
    rest = materialize(rest, "rest")
    drop_tables(docs.sparkSession, working)
    # the second search, on what the first one left
    runs = materialize(passages(rest, id_col, text), "passages")
    found = repeats(runs.drop("end"), ngram, threshold, recall, min_words)
    ends = runs.select(F.col("id").alias("__i"), F.col("h").alias("__g"), F.col("pos").alias("__p"), "end").distinct()
    found = found.join(ends, F.col("id").eqNullSafe(F.col("__i")) & (F.col("h") == F.col("__g")) & (F.col("pos") == F.col("__p")))
    per_doc = found.groupBy(F.col("id").alias("__id"), F.col("h").alias("__h")).agg(
        F.countDistinct("pos").alias("__n_runs"),
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.struct(F.col("pos").alias("start"), "end")))).alias("__passages"),
        F.collect_set("kept").alias("__runs_in"),
    )
    # runs are in order and may overlap: each keeps what stands between the furthest end so far and its start
    zero = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    source = F.col(f"`{text}`")

    def step(done: Column, x: Column) -> Column:
        between = F.when(x["start"] > done["at"], F.substr(source, done["at"] + 1, x["start"] - done["at"])).otherwise("")
        return F.struct(F.concat(done["kept"], between).alias("kept"), F.greatest(done["at"], x["end"]).alias("at"))

    cut = F.aggregate("__passages", zero, step, lambda done: F.concat(done["kept"], F.substr(source, done["at"] + 1)))
    out = marked(rest, id_col, text, per_doc, cut, ["__n_runs", "__passages", "__runs_in"])
    kinds = dict(out.dtypes)
    none = lambda c: F.coalesce(c, F.array().cast(kinds[c]))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        (F.coalesce("__n_lines", F.lit(0)) + F.coalesce("__n_runs", F.lit(0))).alias("__n_shared"),
        none("__removed").alias("__removed"),
        none("__passages").alias("__passages"),
        F.array_sort(F.array_union(none("__lines_in"), none("__runs_in"))).alias("__kept_in"),
    )
