"""Passages that repeat inside longer paragraphs, as units for ``near``.

A line that holds a copied passage between text of its own is not similar to another
such line.  So paragraphs are also cut where the copies begin and end: windows of
``WINDOW`` words are sampled by their content (the least hash of each ``SPAN``
neighbours, so that equal texts have equal samples wherever they stand), sampled
windows that occur more than once are joined to runs, and each run is a unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import drop_tables, hash_filter, join_hot, lean, materialize, recording, ship

#: Words of a window, and neighbouring windows of which the least is sampled (a power of two):
#: any run of WINDOW + SPAN - 1 words that repeats shares a sampled window.
WINDOW, SPAN = 32, 16


def sampled(h: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Indexes of the hashes that are the least of some ``span`` neighbours in their unit."""
    n = len(h)
    if n < span:
        return np.zeros(0, np.int64)
    whole = np.zeros(n, bool)  # a stretch of span hashes begins here
    for i, j in zip(at[:-1], at[1:]):
        whole[i : max(i, j - span + 1)] = True
    low, step = h.copy(), 1
    while step < span:
        low[: n - step] = np.minimum(low[: n - step], low[step:])
        step *= 2
    top, step = np.where(whole, low, np.uint64(0)), 1
    while step < span:
        top[step:] = np.maximum(top[step:], top[:-step].copy())
        step *= 2
    return np.flatnonzero((top == h) & (h > 0))


def window_rows(n: int, span: int) -> Callable:
    """Columns but the last (text), then word position and hash of each sampled window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for i, j in W.chunks(text):
                b = W.word_batch([t or b"" for t in text.slice(i, j - i).cast(pa.binary()).to_pylist()])
                h, at = W.rolled(b, n)
                pick = sampled(h, at, span)
                unit = np.searchsorted(at, pick, "right") - 1
                kept = [batch.column(k).slice(i, j - i).take(pa.array(unit)) for k in range(batch.num_columns - 1)]
                pos = (pick - at[unit]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(pos), pa.array(h[pick].view(np.int64))], names=[*batch.schema.names[:-1], "pos", "hash"])

    return run


def run_rows(n: int, span: int) -> Callable:
    """id, h, pos and end (code points) and text of each run; rows in: id, h, hits (pos, where), text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for i, j in W.chunks(text):
                raw = text.slice(i, j - i).cast(pa.binary()).to_pylist()
                b = W.word_batch(raw)
                # code points before each byte: all bytes but the continuing ones
                points = np.concatenate([[0], np.cumsum((b.raw & 0xC0) != 0x80)])
                hits = batch.column("hits").slice(i, j - i)
                pos, where = (x.to_numpy(zero_copy_only=False) for x in hits.flatten().flatten())
                row = np.repeat(np.arange(j - i), hits.value_lengths().to_numpy(zero_copy_only=False))
                order = np.lexsort((where, pos, row))
                row, pos, where = row[order], pos[order].astype(np.int64), where[order]
                # a run ends with its text, where the copies change, or before a gap
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (where[1:] != where[:-1]) | (pos[1:] > pos[:-1] + span)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(row))[: len(first)] - 1
                row = row[first]
                p, q = b.start[b.first[row] + pos[first]], b.end[b.first[row] + pos[last] + n - 1]
                whole = b.raw.tobytes()
                texts = [whole[x:y].decode("utf-8", "replace") for x, y in zip(p.tolist(), q.tolist())]
                base = points[b.at[row]]
                pos, end = (points[p] - base).astype(np.int32), (points[q] - base).astype(np.int32)
                at = pa.array(row + i, pa.int64())
                out = [batch.column("id").take(at), batch.column("h").take(at), pa.array(pos, pa.int32()), pa.array(end, pa.int32()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=["id", "h", "pos", "end", "text"])

    return run


def passages(docs: DataFrame, id_col: str, text: str, n: int = WINDOW, span: int = SPAN) -> DataFrame:
    """id, h (hash of the whole text), pos, end and text of each run of repeated windows.

    pos and end are code points, from 0.  A run joins neighbouring sampled windows that
    occur in the same texts, so that a passage has equal runs in all its copies; runs of a
    text may overlap.  Texts of fewer than n + span - 1 words have none, null texts too.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text")).where(F.length("text") >= 2 * n - 1)
    kind = src.schema["id"].dataType.simpleString()
    working: list[str] = []
    with recording(working):
        every = materialize(src.mapInArrow(lean(window_rows(n, span)), f"id {kind}, h bigint, pos int, hash bigint"), "sampled")
        often = materialize(every.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1"), "windows")
        maybe = hash_filter(often.select(F.xxhash64("hash").alias("x")), "x")
    found = materialize(every.where(maybe(F.xxhash64("hash"))), "found")
    drop_tables(docs.sparkSession, working)
    # 28 bits a row: the sum cannot overflow
    place = F.sum(F.xxhash64("id", "h").bitwiseAND(F.lit((1 << 28) - 1))).alias("where")
    often = found.groupBy("hash").agg(F.count("*").alias("times"), place).where("times > 1").drop("times")
    hits = join_hot(found, often, "hash").groupBy("id", "h").agg(F.collect_set(F.struct("pos", "where")).alias("hits"))
    hits = materialize(hits.select(F.col("id").alias("__id"), F.col("h").alias("__h"), "hits"), "hits")
    held = hash_filter(hits.select(F.xxhash64("__id", "__h").alias("x")), "x")
    whole = src.where(held(F.xxhash64("id", "h"))).join(hits, F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")))
    runs = whole.select("id", "h", "hits", "text").mapInArrow(lean(run_rows(n, span)), f"id {kind}, h bigint, pos int, end int, text string")
    return runs
