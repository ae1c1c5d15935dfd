"""Near-duplicate units by MinHash banding, block-wise verification and components.

A *unit* is anything with a text: a document (``ngram_join``) or a paragraph
(``substring_dedup``).  The steps, all distributed:

1. ``signatures``: per unit its class key (128-bit hash of its word sequence), its
   band hashes and one byte of each MinHash value.
2. ``distinct`` units: one representative text per class key, with the number of copies.
3. ``candidates``: units that share a band bucket are compared by signature inside
   the bucket.  A bucket is cut into blocks, each pair of blocks is one group, and a
   group returns a spanning forest of its likely pairs.  A task's memory and the rows
   returned do not grow with the square of a bucket; the signatures that are dealt out
   and the comparisons do (a bucket of m different texts sends each m / 256 times).
4. ``verified``: the candidates' components bring the full texts together, again in
   pairs of blocks; exact Jaccard similarity of the whole n-gram sets decides, link
   counts are added up per unit, and a spanning forest of the links is returned.
5. the forests' components are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import connected_components, hash_filter, join_hot, lean, materialize, ship

#: Units of one block, and bytes of text of one block; a group is two blocks at most.
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20
#: Units of a group whose signatures are compared together with other groups', and whose texts are.
SMALL, FEW = 32, 8
#: Bytes of text of the groups that are verified together, if it is not one group.
TOGETHER = 1 << 20
#: Standard errors that a pair's estimated similarity may fall short of the threshold.
SLACK = 5.0


def signature_batches(ngram: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for i, j in W.chunks(text):
                part = text.slice(i, j - i)
                raw = part.cast(pa.binary()).to_pylist()
                b = W.word_batch(raw)
                h, at = W.grams(b, ngram)
                band, sig = W.minhash(h, at, bands, rows)
                kept = [batch.column(k).slice(i, j - i) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(unit_keys(b, raw), pa.binary()), pa.array(np.diff(at)), pa.array(np.diff(b.at) - 1), fixed(band), fixed(sig)],
                    names=[*batch.schema.names[:-1], "key", "n", "size", "bands", "sig"],
                )

    return run


def unit_keys(b: W.Batch, raw: list[bytes]) -> list[bytes]:
    """128-bit hash of each unit's words; of its bytes, if it has no word."""
    key = np.ascontiguousarray(np.stack([W.unit_hash(b.hash, b.first, s) for s in (0, 1)], 1)).tobytes()
    some = np.diff(b.first) > 0
    return [key[16 * i : 16 * i + 16] if some[i] else hashlib.blake2b(raw[i], digest_size=16).digest() for i in range(len(raw))]


def fixed(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def signatures(units: DataFrame, ids: list[str], text: str, ngram: int, bands: int, rows: int) -> DataFrame:
    """ids, key, n (number of n-grams), size (bytes of text), bands and sig of each unit; null texts count as empty."""
    ship(units.sparkSession)
    src = units.select(*ids, F.coalesce(text, F.lit("")).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(lean(signature_batches(ngram, bands, rows)), f"{kinds}, key binary, n bigint, size bigint, bands binary, sig binary")


def in_blocks(df: DataFrame, group: str, nb: Column) -> DataFrame:
    """Give each row its block and one copy for each pair of blocks that it belongs to."""
    df = df.withColumn("nb", nb).withColumn("blk", F.pmod(F.xxhash64("key"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col("nb") - 1).cast("int")))
    return df.withColumn("o", other).select(
        group, F.least("blk", "o").alias("bi"), F.greatest("blk", "o").alias("bj"), "blk", *[c for c in df.columns if c not in (group, "nb", "blk")]
    )


def by_group(df: DataFrame, group: str) -> DataFrame:
    return df.repartition(group, "bi", "bj").sortWithinPartitions(group, "bi", "bj", "key")


def starts(columns: list) -> np.ndarray:
    """Rows at which the values of some column change, and row 0."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        v = c.to_numpy(zero_copy_only=False) if isinstance(c, pa.Array) else c.to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def stretches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (equal first ``width`` columns) out of sorted batches, and the rows
    at which their groups begin with the number of rows at the end.  A table holds the groups that
    end in one batch."""
    rest: list[pa.RecordBatch] = []

    def table(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(parts)
        return t, np.append(starts(t.columns[:width]), t.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        first = starts(batch.columns[:width])
        if rest and all(rest[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in range(width)):
            first = first[1:]  # its first rows go on with the group before
        if len(first):
            last = int(first[-1])
            if rest or last:
                yield table([*rest, batch.slice(0, last)] if last else rest)
            rest = []
            batch = batch.slice(last)
        rest.append(batch)
    if rest:
        yield table(rest)


def small_pairs(at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows i < j within each group of at most ``most`` rows."""
    size = np.diff(at)
    left = np.repeat(at[1:], size) - np.arange(at[-1]) - 1  # rows after each one in its group
    left[np.repeat(size > most, size)] = 0
    i = np.repeat(np.arange(at[-1]), left)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(left) - left, left)
    return i, j


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) edges that connect the same nodes as the pairs (i, j) do."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    node = np.flatnonzero(root != np.arange(n))
    return node, root[node]


def likely_pairs(hashes: int, threshold: float) -> Callable:
    """Per group of a bucket: spanning forest of the pairs whose signatures agree in as
    many bytes as the threshold lets expect, less ``SLACK`` standard errors.

    Pairs of small groups are compared together, those of larger ones group by group."""
    least = hashes * threshold - SLACK * np.sqrt(hashes * threshold * (1 - threshold))

    def large(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        equal = np.zeros((len(sig), len(sig)), np.int16)
        for k in range(hashes):
            equal += sig[:, k][:, None] == sig[:, k][None, :]
        return np.nonzero(np.triu(equal >= least, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in stretches(batches, 3):
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(t.num_rows, hashes)
            i, j = small_pairs(at, SMALL)
            good = (sig[i] == sig[j]).sum(1) >= least
            pairs = [(i[good], j[good])]
            for g in np.flatnonzero(np.diff(at) > SMALL):
                i, j = large(sig[at[g] : at[g + 1]])
                pairs.append((i + at[g], j + at[g]))
            node, root = forest(*(np.concatenate(x) for x in zip(*pairs)), t.num_rows)
            if len(node):
                key = t.column("key")
                yield pa.RecordBatch.from_arrays([key.take(pa.array(x)).combine_chunks().cast(pa.binary()) for x in (node, root)], names=["a", "b"])

    return run


def candidates(units: DataFrame, bands: int, rows: int, threshold: float) -> DataFrame:
    """Edges (a, b) of keys that connect all units of a common bucket which may be similar."""
    # one long per band, and one for the key: a clash makes a candidate more, not a link
    cut = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(F.substring("bands", i * 8 + 1, F.lit(8)), i))
    units = units.withColumn("k", F.xxhash64("key"))
    flat = units.where("n > 0").select("k", F.explode(cut).alias("bucket"))
    # two longs a row, shuffled once: a window counts a bucket, and only those of shared buckets go on
    shared = materialize(flat.withColumn("m", F.count("*").over(Window.partitionBy("bucket"))).where("m > 1"), "shared")
    maybe = hash_filter(shared.select("k"), "k")
    members = shared.join(units.where(maybe("k")).select("k", "key", "sig"), "k")
    split = in_blocks(members, "bucket", F.ceil(F.col("m") / BLOCK_ROWS).cast("int"))
    return by_group(split.select("bucket", "bi", "bj", "key", "sig"), "bucket").mapInArrow(
        lean(likely_pairs(bands * rows, threshold)), "a binary, b binary"
    )


def jaccard(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact Jaccard similarity of all pairs of units' hash sets, in slices of distinct hashes."""
    n = len(at) - 1
    unit = np.repeat(np.arange(n), np.diff(at))
    value, col = np.unique(h, return_inverse=True)
    cell = np.unique(col.astype(np.int64) * n + unit)  # sets: repeated n-grams count once
    col, unit = cell // n, cell % n
    size = np.bincount(unit, minlength=n)
    common = np.zeros((n, n), np.float64)
    step = 8192
    edges = np.searchsorted(col, np.arange(0, len(value) + step, step))
    for k in range(len(edges) - 1):
        c, u = col[edges[k] : edges[k + 1]], unit[edges[k] : edges[k + 1]]
        own = np.unique(u)
        m = np.zeros((len(own), step), np.float32)
        m[np.searchsorted(own, u), c - k * step] = 1
        common[np.ix_(own, own)] += m @ m.T
    union = size[:, None] + size[None, :] - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def small_links(h: np.ndarray, at: np.ndarray, group: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of units i < j within small groups (rows ``group`` to the next) whose sets of hashes
    have the similarity: the groups' shared hashes are counted for all pairs in one go."""
    n = len(at) - 1
    unit = np.repeat(np.arange(n), np.diff(at))
    value, code = np.unique(h, return_inverse=True)
    of = np.searchsorted(group, unit, "right") - 1
    # sets, in the order group, hash, unit: within a group a hash's units stand together
    order = np.lexsort((unit, code, of))
    unit, code, of = unit[order], code[order], of[order]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (code[1:] != code[:-1])
    unit, code, of = unit[new], code[new], of[new]
    size = np.bincount(unit, minlength=n)
    new = np.ones(len(unit), bool)
    new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    i, j = small_pairs(np.append(np.flatnonzero(new), len(unit)), n)
    pair, common = np.unique(unit[i] * n + unit[j], return_counts=True)
    i, j = pair // n, pair % n
    good = common / (size[i] + size[j] - common) >= threshold - 1e-12
    return i[good], j[good]


def verified_links(ngram: int, threshold: float) -> Callable:
    """Per group of a candidate component: link counts of each unit and a spanning forest of the links.

    Rows in: comp, bi, bj, blk, key, copies, text.  Rows out: (a, b, 0) for a forest
    edge and (key, null, copies linked) for a count.  A pair of units within one block
    is judged where bi = bj, other pairs where their two blocks meet.  Groups of up to
    ``FEW`` units are judged together, a part of about ``TOGETHER`` bytes at a time.
    """

    def links(t: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        raw = t.column("text").cast(pa.binary()).to_pylist()
        key = t.column("key").to_pylist()
        own, h, ends = W.grams_of(raw, ngram, unit_keys)
        group = np.repeat(np.arange(len(at) - 1), np.diff(at))
        # ids may repeat with other texts: keep the text that has the key, once
        held: set = set()
        keep = []
        for i, k in enumerate(key):
            if own[i] == k and (group[i], k) not in held:
                held.add((group[i], k))
                keep.append(i)
        if len(keep) < len(key):
            h = np.concatenate([np.zeros(0, np.uint64), *(h[ends[i] : ends[i + 1]] for i in keep)])
            ends = np.concatenate([[0], np.cumsum(np.diff(ends)[keep])]).astype(np.int64)
            t, key, group = t.take(pa.array(keep, pa.int64())), [key[i] for i in keep], group[keep]
        n = len(key)
        blk, bi, bj, copies = (t.column(c).to_numpy() for c in ("blk", "bi", "bj", "copies"))
        at = np.append(np.flatnonzero(np.diff(group, prepend=-1)), n)
        size = np.diff(at)
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        few = np.repeat(size <= FEW, size)
        if few.any():
            own_ = np.flatnonzero(few)
            hs = h[np.repeat(few, np.diff(ends))]
            to = np.concatenate([[0], np.cumsum(np.diff(ends)[few])])
            i, j = small_links(hs, to, np.concatenate([[0], np.cumsum(size[size <= FEW])[:-1]]), threshold)
            pairs.append((own_[i], own_[j]))
        for g in np.flatnonzero(size > FEW):
            p, q = at[g], at[g + 1]
            i, j = np.nonzero(np.triu(jaccard(h[ends[p] : ends[q]], ends[p : q + 1] - ends[p]) >= threshold - 1e-12, 1))
            pairs.append((i + p, j + p))
        i, j = (np.concatenate(x) for x in zip(*pairs))
        ours = (bi[i] == bj[i]) | (blk[i] != blk[j])
        i, j = i[ours], j[ours]
        count = np.zeros(n, np.int64)
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        node, root = forest(i, j, n)
        some = np.flatnonzero(count)
        out = [
            pa.array([key[x] for x in node] + [key[x] for x in some], pa.binary()),
            pa.array([key[x] for x in root] + [None] * len(some), pa.binary()),
            pa.array([0] * len(node) + count[some].tolist(), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(out, names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in stretches(batches, 3):
            size = pc.binary_length(t.column("text")).to_numpy()
            ends = np.concatenate([[0], np.cumsum(size.astype(np.int64))])[at[1:]]
            g = 0
            while g < len(at) - 1:
                base = ends[g - 1] if g else 0
                to = max(g + 1, int(np.searchsorted(ends, base + TOGETHER, "right")))
                if at[to] - at[g] > 1:
                    yield links(t.slice(at[g], at[to] - at[g]), at[g : to + 1] - at[g])
                g = to

    return run


def keyed(sig: DataFrame, unit_ids: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From the signatures of all units: (ids, key) of every unit; (key, copies, n, size,
    rep) and (key, n, bands, sig) of every distinct one.

    Only a 64-bit hash of each key is shuffled to find the keys that may have copies.  The
    units of all others are written and read as they stand; those of these few are grouped
    by the whole key, so that two keys of one hash stay apart.
    """
    sig = materialize(sig, "signatures")
    hashed = F.xxhash64("key")
    twice = materialize(sig.groupBy(hashed.alias("x")).agg(F.count("*").alias("c")).where("c > 1").select("x"), "twice")
    copied = hash_filter(twice, "x")
    ids = F.struct(*unit_ids)
    more = sig.where(copied(hashed)).groupBy("key").agg(
        F.count("*").alias("copies"), F.max("n").alias("n"), F.max("size").alias("size"), F.min(ids).alias("rep"), F.min("bands").alias("bands"), F.min("sig").alias("sig")
    )
    more = materialize(more, "copied")
    once = sig.where(~copied(hashed))
    columns = ["key", "copies", "n", "size", "rep"]
    distinct = once.select("key", F.lit(1).cast("bigint").alias("copies"), "n", "size", ids.alias("rep")).unionAll(more.select(columns))
    prints = ["key", "n", "bands", "sig"]
    return sig.select(*unit_ids, "key"), materialize(distinct, "units"), once.select(prints).unionAll(more.select(prints))


def linked_groups(
    distinct: DataFrame, prints: DataFrame, units: DataFrame, unit_ids: list[str], text: str, ngram: int, threshold: float, bands: int, rows: int
) -> DataFrame:
    """(key, copies, links, root) of each distinct unit.

    distinct, prints: see ``keyed``; units: the units with their texts.
    links counts the other units whose n-gram sets have the similarity, copies
    included; root is the least key of the unit's group.
    """
    comp = materialize(connected_components(candidates(prints, bands, rows, threshold)), "components")
    near_one = hash_filter(comp.select(F.xxhash64("node").alias("x")), "x")
    some = distinct.where(near_one(F.xxhash64("key"))).select("key", "copies", "size", "rep")
    members = comp.join(some, F.col("node") == F.col("key"))
    total = members.groupBy("root").agg(F.count("*").alias("m"), F.sum("size").alias("b"))
    nb = F.ceil(F.greatest(F.col("m") / BLOCK_ROWS, F.col("b") / BLOCK_BYTES)).cast("int")
    placed = join_hot(members, total, "root").select("root", "key", "copies", "m", "b", *[F.col("rep")[c].alias(f"__{c}") for c in unit_ids])
    same = [F.col(f"u.{c}").eqNullSafe(F.col(f"p.__{c}")) for c in unit_ids]
    on = same[0]
    for x in same[1:]:
        on &= x
    texts = units.select(*unit_ids, F.coalesce(text, F.lit("")).alias("text"))
    placed = materialize(placed, "placed")
    maybe = hash_filter(placed.select(F.xxhash64(*[f"__{c}" for c in unit_ids]).alias("x")), "x")
    texts = placed.alias("p").join(texts.where(maybe(F.xxhash64(*unit_ids))).alias("u"), on)
    split = in_blocks(texts, "root", nb).select("root", "bi", "bj", "blk", "key", "copies", "text")
    found = by_group(split, "root").mapInArrow(lean(verified_links(ngram, threshold)), "a binary, b binary, links bigint")
    found = materialize(found, "links")
    links = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("linked"))
    links = materialize(links, "counts")
    final = connected_components(found.where("b is not null").select("a", "b"))
    # a unit without a link to another text takes no part in the joins
    linked = hash_filter(links.select(F.xxhash64("key").alias("x")), "x")
    units_ = distinct.select("key", "copies", "n", linked(F.xxhash64("key")).alias("__linked"))
    alone = units_.where("not __linked").select("key", "copies", "n", (F.col("copies") - 1).alias("links"), F.col("key").alias("root"))
    return alone.unionAll(
        units_.where("__linked")
        .join(links, "key", "left")
        .join(final.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "copies", "n", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "key").alias("root"))
    )
