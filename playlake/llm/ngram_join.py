"""N-gram Jaccard join of a corpus with itself (operator 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import near
from playlake.llm import words as W
from playlake.llm.common import hash_filter, join_hot, materialize

NGRAM, THRESHOLD, RECALL = 5, 0.8, 0.9999


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", ngram: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per document: its id, class_id, n_links, copies, the keys of both classes,
    text_hash and stays.

    Documents are linked when the Jaccard similarity of their sets of word n-grams is
    at least ``threshold``.  Bands and rows of the MinHash banding follow from the
    recall asked for at the threshold; links found are verified on the whole n-gram sets.

    * class_id: the least id of the group that links connect (of the document itself if it has none)
    * n_links: documents linked to it, copies included
    * copies: documents of the same word sequence, itself included
    * class_key, group_key: 128-bit keys of the word sequence and of the group
    * text_hash, stays: whether the document is its group's first by (id, hash of the text)

    Null texts count as empty.  Texts of the same words (or, without any word, of the
    same bytes) are copies.  A text of fewer than n words is one n-gram of all of them.
    Null ids are kept; a group of null ids only has a null class_id.  Repeated rows are
    copies of each other.  Other columns of ``docs`` are ignored, whatever their names.
    """
    bands, rows = W.choose_bands(threshold, recall)
    units = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    keys, distinct, prints = near.keyed(near.signatures(units, ["id", "h"], "text", ngram, bands, rows), ["id", "h"])
    classes = near.linked_groups(distinct, prints, units, ["id", "h"], "text", ngram, threshold, bands, rows)
    rows_ = join_hot(keys, classes, "key")
    rows_ = materialize(rows_.select("id", "h", "key", "copies", "links", "root"), "classes")
    first = rows_.groupBy("root").agg(F.min("id").alias("class_id"), F.min(F.struct("id", "h")).alias("first"))
    # a group of null ids and others: the nulls come first in the struct, class_id ignores them
    return join_hot(rows_, first, "root").select(
        F.col("id").alias(id_col),
        "class_id",
        F.col("links").alias("n_links"),
        "copies",
        F.hex("key").alias("class_key"),
        F.hex("root").alias("group_key"),
        F.col("h").alias("text_hash"),
        (F.struct("id", "h") == F.col("first")).alias("stays"),
    )


def keep_one(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the copies: of each group the row that ``stays``, once.

    ``joined`` is the result of ``ngram_join`` on ``docs``, written.  Rows that have no
    link pass by a filter and take no part in the join.
    """
    linked = joined.where("n_links > 0").select(F.xxhash64(id_col, "text_hash").alias("x"))
    maybe = hash_filter(linked, "x")
    rows = docs.withColumn("__hash", F.xxhash64(text))
    rows = rows.withColumn("__maybe", maybe(F.xxhash64(id_col, "__hash")))
    kept = joined.where("stays").select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__text"), F.col("group_key").alias("__group")).distinct()
    rest = rows.where("__maybe").join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text")))
    rest = rest.dropDuplicates(["__group"])
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return rows.where("not __maybe").select(*cols).unionAll(rest.select(*cols))
