"""A corpus pipeline of five stages over ``documents``; each takes what its predecessor kept.

Each stage is written as Parquet into the folder that all executors share and read again,
so a lost executor repeats one stage at most.  A stage's working tables are deleted when
the next stage begins: its result has been written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import decontaminate, ngram_join, packing, queries, substring_dedup, toxicity
from playlake.llm.common import drop_tables, materialize, recording


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_WORKING: list[str] = []  # tables of the stage that ran last


def stage(f: Stage) -> Stage:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _WORKING)
        with recording(_WORKING):
            return f(spark, docs, sf_dir)

    return run_stage


def like(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of ``docs``; n_chars follows the text, if there is one."""
    if "n_chars" not in docs.columns:
        return out.select(*docs.columns)
    counted = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", counted).select(*docs.columns)


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts as toxic go."""
    model = queries.toxicity_model(spark, sf_dir, docs)
    return toxicity.keep_clean(docs, model)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs, materialize(ngram_join.ngram_join(docs), "joined")).select(*docs.columns)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that repeat stay in one place only."""
    return like(docs, substring_dedup.substring_dedup(docs))


@stage
def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    return like(docs, decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark")))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in training windows."""
    return packing.pack_documents(docs, queries.vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontaminate", cut_benchmark),
    ("packing", pack),
]

#: Hash banding, a learned model and a tokenizer are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = materialize(step(spark, docs, sf_dir), f"stage-{name}")
    return docs
