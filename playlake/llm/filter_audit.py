"""How filters interact: what each removes, alone and after others, in every order (operator 12).

All that any order of filters removes follows from the number of documents with each
failure mask.  One pass over the documents gives the masks, one aggregate the cells
(at most 2**k a part), and the rest works on cells: the subsets of filters are walked in
Gray-code order, so each step toggles one filter, a counter for each cell says how many
of the active filters it fails, and the running survivors change by the cells whose
counter leaves or reaches zero.  The 2**k states are stored; a step of an order is the
difference of two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import join_hot, materialize, ship

#: Filters at most: 2**8 states and 8! orders a part.
MAX_FILTERS = 8
#: Words of the rules below, and the marks that rule D looks for (fixed values).
WORD_GAP, MARKS = r"[ \x09-\x0D]+", r"[#$%&*|]"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2


def survivors(cells: np.ndarray, k: int) -> np.ndarray:
    """States (parts, 2**k, tallies): what is left of each tally under each set of filters.

    cells: (parts, 2**k, tallies), a cell for each mask of failed filters.
    """
    masks = np.arange(1 << k)
    failures = np.zeros(1 << k, np.int64)  # active filters that a cell fails
    left = cells.sum(1)
    states = np.empty_like(cells)
    active = 0
    states[:, 0] = left
    for step in range(1, 1 << k):
        toggled = step & -step  # the bit by which neighbouring Gray codes differ
        active ^= toggled
        hit = (masks & toggled) != 0
        before = failures > 0
        failures[hit] += 1 if active & toggled else -1
        after = failures > 0
        left = left - cells[:, after & ~before].sum(1) + cells[:, before & ~after].sum(1)
        states[:, active] = left
    return states


def order_rows(names: list[str], tallies: list[str]) -> Callable:
    """Rows of every order and step, for batches of one row a part (part, cells)."""
    k = len(names)
    orders = np.array(list(permutations(range(k))), np.int64)
    done = np.cumsum(1 << orders, axis=1)  # filters applied after each step
    prior = done - (1 << orders)
    labels = ["".join(names[i] for i in o) for o in orders]
    failing = np.array([[(m >> f) & 1 for m in range(1 << k)] for f in range(k)], bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a part has k * k! rows
                cells = np.zeros((1, 1 << k, 1 + len(tallies)), np.int64)
                for c in batch.column("cells")[at].as_py():
                    cells[0, c["mask"]] = [c["n"], *(c[t] for t in tallies)]
                states = survivors(cells, k)[0]
                removed = states[prior] - states[done]  # order, step, tally
                total = np.array([cells[0, f, 0].sum() for f in failing])
                alone = cells[0, 1 << np.arange(k), 0]
                shapley = np.bincount(orders.ravel(), removed[..., 0].ravel().astype(np.float64), k)
                f = orders.ravel()
                out = {
                    "part": pa.array([batch.column("part")[at].as_py()] * f.size, pa.string()),
                    "filter_order": pa.array(np.repeat(np.array(labels), k)),
                    "step": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))),
                    "kept": pa.array(states[done][..., 0].ravel()),
                    "removed": pa.array(removed[..., 0].ravel()),
                    "redundant": pa.array(total[f] - removed[..., 0].ravel()),
                    "unique_fails": pa.array(alone[f]),
                    **{f"{t}_lost": pa.array(removed[..., 1 + i].ravel()) for i, t in enumerate(tallies)},
                    "shapley": pa.array(np.rint(shapley).astype(np.int64)[f]),
                }
                yield pa.RecordBatch.from_pydict(out)

    return run


def audit(masked: DataFrame, names: list[str], tallies: list[str]) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, <tally>_lost, shapley.

    masked: part (null counts as empty), mask (bit i: fails filter i of ``names``), n (rows)
    and a long for each of ``tallies``; rows of equal part and mask are added up, map-side
    first, so a part or cell with a third of all rows is one row of each task.  An empty
    frame gives no rows; other columns are ignored.
    """
    if not 1 <= len(names) <= MAX_FILTERS or any(len(n) != 1 for n in names) or len(set(names)) < len(names):
        raise ValueError(f"1 to {MAX_FILTERS} different one-letter names are needed")
    ship(masked.sparkSession)
    part = F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part")
    cells = masked.groupBy(part, F.col("mask").cast("int").alias("mask")).agg(*[F.sum(c).cast("long").alias(c) for c in ("n", *tallies)])
    per_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *tallies)).alias("cells"))
    lost = "".join(f"{t}_lost bigint, " for t in tallies)
    kinds = f"part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, {lost}shapley bigint"
    return per_part.mapInArrow(order_rows(names, tallies), kinds)


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: the text fails A (few words), B (repeats words), C (capitals), D (marks)."""
    words = F.array_remove(F.split(text, WORD_GAP), "")

    def bits(w: Column) -> Column:
        capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
        return (
            F.when(F.size(w) < LEAST_WORDS, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT * F.size(w), 2).otherwise(0)
            + F.when(100 * capitals.cast("long") > MOST_CAPITALS * F.length(text).cast("long"), 4).otherwise(0)
            + F.when(text.rlike(MARKS), 8).otherwise(0)
        )

    return F.element_at(F.transform(F.array(words), bits), 1)  # the words are bound once


def document_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask, n, good and toxic of groups of documents that share them.

    Bits 0 to 3 are those of ``text_failures``; bit 4: the text equals that of a smaller id
    anywhere in the table.  Texts are compared by their SHA-256.  A null text is empty.  A
    null id neither has a smaller one nor is one.  Rows of one id and text are all counted,
    none is a copy of the other.  ``labels`` (doc_id, quality, toxic): a document counts as
    good or toxic if any of its label rows says 1.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("key"),
        text_failures(body).alias("low"),
    )
    rows = materialize(rows.groupBy("id", "part", "key", "low").agg(F.count("*").alias("n")), "audit")
    yes = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"is_{c}")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(yes("quality"), yes("toxic"))
    rows = join_hot(rows, marks, "id", "left")
    # the first of each text joins on text and id, so that copies do not meet in one task
    first = rows.where("id is not null").groupBy("key").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    rows = rows.join(first, ["key", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    return rows.select(
        "part",
        (F.col("low") + F.when(copy, 16).otherwise(0)).alias("mask"),
        "n",
        (F.col("n") * F.coalesce("is_quality", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
    )
