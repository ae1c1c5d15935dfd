"""Packing of token pieces into fixed windows (operator 8).

Documents become token ids with a separator id; each is cut into whole windows and one
rest.  The rests' length histogram decides the packing: shallow combinations of lengths
that fill a window exactly are columns of a non-negative least-squares problem, whose
rounded solution says how often each combination is used; what is left is packed
greedily (best fit, longest first) on the histogram.  Histogram and plan have at most
one bin per length, so they are small for any corpus; pieces take their places by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import lean, materialize, ship

WINDOW, END_ID = 2048, 1
#: Lengths that form combinations of three and four, and combinations in all.
FREQUENT, MAX_COLUMNS = 160, 6_000
#: Rows of one length that are numbered in one task.
RANKED_ROWS = 100_000


def piece_batches(path: str, window: int, end_id: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playlake.llm.common import KEPT  # the worker's own, not a pickled copy
        from playlake.llm.tokens import encoder

        KEPT[__name__] = encoder.cache_clear
        ids_of = encoder(path).encode
        for batch in batches:
            text = batch.column(1)
            for i, j in W.chunks(text):
                rows: list[tuple] = []
                for k, ids in enumerate(ids_of([t or "" for t in text.slice(i, j - i).to_pylist()])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(ids), window):
                        piece = ids[at : at + window]
                        rows.append((i + k, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece.tolist() if with_ids else None))
                doc, start, length, crc, total, got = zip(*rows)
                cols = [batch.column(0).take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols, names = [*cols, pa.array(got, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens (and ids) of each piece; null texts are empty, their one piece is the end id."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<bigint>" * with_ids
    return src.mapInArrow(lean(piece_batches(path, window, end_id, with_ids)), schema)


Pattern = tuple[tuple[int, int], ...]  # (length, times) of the pieces of a window


def combinations(hist: np.ndarray, window: int) -> list[Pattern]:
    """Combinations of two to four lengths that fill the window exactly and occur in the histogram.

    All pairs; threes and fours take all but their last length from the FREQUENT
    commonest lengths.  Rarer ones give way beyond MAX_COLUMNS: they only steer the
    solution, and every piece is packed whether or not a combination has it.
    """
    found: dict[tuple[int, ...], int] = {}
    for a in range(1, window // 2 + 1):
        if hist[a] and hist[window - a]:
            found[a, window - a] = int(min(hist[a], hist[window - a]))
    common = np.sort(np.argsort(-hist[1:window], kind="stable")[:FREQUENT] + 1)
    common = common[hist[common] > 0]
    pair = common[:, None] + common[None, :]
    for i, j in zip(*np.nonzero(np.triu(pair < window))):
        a, b = int(common[i]), int(common[j])
        c = window - a - b
        if hist[c]:
            found[tuple(sorted((a, b, c)))] = int(min(hist[a], hist[b], hist[c]))
    few = common[np.argsort(-hist[common], kind="stable")[:48]]
    for a in few:
        for b in few[few >= a]:
            for c in few[few >= b]:
                d = window - int(a) - int(b) - int(c)
                if d > 0 and hist[d]:
                    found[tuple(sorted((int(a), int(b), int(c), d)))] = int(min(hist[a], hist[b], hist[c], hist[d]))
    best = sorted(found, key=lambda k: (-found[k], k))[:MAX_COLUMNS]
    return [tuple(sorted((x, k.count(x)) for x in set(k))) for k in best]


def nnls(columns: list[Pattern], hist: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Repeat counts x >= 0 that bring the sum of the columns nearest to the histogram (coordinate descent)."""
    x = np.zeros(len(columns))
    rest = hist.astype(np.float64).tolist()
    norm = [sum(t * t for _, t in c) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for k, c in enumerate(columns):
            step = max(-x[k], sum(t * rest[n] for n, t in c) / norm[k])
            if step:
                x[k] += step
                moved = max(moved, abs(step))
                for n, t in c:
                    rest[n] -= t * step
        if moved < 0.01:
            break
    return x


def best_fit(hist: np.ndarray, window: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, on the histogram: equal windows are handled together."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    spaces = np.zeros(window + 1, bool)
    for n in range(window, 0, -1):
        left = int(hist[n])
        while left:
            fit = np.flatnonzero(spaces[n:])
            if not len(fit):
                each = window // n
                full, more = divmod(left, each)
                for times, count in ((each, full), (more, 1 if more else 0)):
                    if count:
                        open_.setdefault(window - n * times, []).append((((n, times),), count))
                        spaces[window - n * times] = True
                break
            s = int(fit[0]) + n
            pattern, count = open_[s].pop()
            each = min(s // n, -(-left // count)) if left >= count else 1
            used = min(count, left // each)
            if used < count:
                open_[s].append((pattern, count - used))
            spaces[s] = bool(open_[s])
            at = s - each * n
            open_.setdefault(at, []).append(((*pattern, (n, each)), used))
            spaces[at] = True
            left -= used * each
    return [x for k in sorted(open_) for x in open_[k]]


def plan(hist: np.ndarray, window: int = WINDOW) -> list[tuple[Pattern, int]]:
    """(combination, times used) such that every piece of the histogram has a place."""
    left = hist.copy()
    out: list[tuple[Pattern, int]] = []
    if left[window]:
        out.append((((window, 1),), int(left[window])))
        left[window] = 0
    columns = combinations(left, window)
    x = nnls(columns, left)
    for k in sorted(range(len(columns)), key=lambda k: (-x[k], k)):
        times = min([int(x[k] + 0.5), *(int(left[n]) // t for n, t in columns[k])])
        if times > 0:
            out.append((columns[k], times))
            for n, t in columns[k]:
                left[n] -= times * t
    return out + best_fit(left, window)


@dataclass
class Places:
    """Where the r-th piece of a length goes."""

    key: np.ndarray  # length << 40 | first rank, sorted
    times: np.ndarray  # pieces of this length in a window
    sequence: np.ndarray  # first window
    offset: np.ndarray


def places(packed: list[tuple[Pattern, int]]) -> Places:
    rows, used, base = [], {}, 0
    for pattern, count in packed:
        at = 0
        for n, t in pattern:
            r = used.get(n, 0)
            rows.append((n << 40 | r, t, base, at))
            used[n] = r + count * t
            at += n * t
        base += count
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Places(a[:, 0], a[:, 1], a[:, 2], a[:, 3])


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (rows of ``pieces``, written) with sequence_id and offset.

    A window holds its pieces back to back from offset 0.  Rows that repeat and null
    ids are pieces like others; an empty frame gives none.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per length
    hist = np.zeros(window + 1, np.int64)
    for n, c in counts.items():
        hist[n] = c
    where = places(plan(hist, window))
    cells = max(1, -(-int(hist.max()) // RANKED_ROWS))
    cell = F.pmod(F.xxhash64("id", "start"), F.lit(cells)).cast("int").alias("cell")
    rows = cut.select("*", cell)
    base = np.zeros((window + 1, cells), np.int64)
    for r in rows.groupBy("length", "cell").agg(F.count("*").alias("n")).collect():  # rows / RANKED_ROWS + lengths
        base[r["length"], r["cell"]] = r["n"]
    base = np.cumsum(base, 1) - base
    shared = cut.sparkSession.sparkContext.broadcast((where, base))
    numbered = rows.withColumn("r", F.expr("row_number() over (partition by length, cell order by id, start, ids_crc32) - 1"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first = shared.value
        for b in batches:
            n, c, r = (b.column(x).to_numpy().astype(np.int64) for x in ("length", "cell", "r"))
            r = r + first[n, c]
            k = np.searchsorted(at.key, (n << 40) | r, "right") - 1
            r = r - (at.key[k] & ((1 << 40) - 1))
            t = at.times[k]
            more = [pa.array(at.sequence[k] + r // t), pa.array(at.offset[k] + r % t * n)]
            keep = [x for x in b.schema.names if x not in ("cell", "r")]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in keep), *more], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return numbered.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their places, under the id column's name."""
    cut = materialize(pieces(docs, path, id_col, text, window, end_id), "pieces")
    return pack(cut, window).withColumnRenamed("id", id_col)
