"""Merkle manifest of a table, and proofs for all its rows (operator 13).

Rows are leaves; those of one group (a *tree*) stand in order, and every ``FAN`` neighbours
have a parent, up to the tree's root.  The roots of all trees are the leaves of one more
tree.  Work is cut into aligned blocks of FAN**LEVELS leaves, so that a task holds one block
whatever the table's size: a block derives its interior nodes, and the tops of blocks are
the leaves of the next round.

Proofs are octopus multiproofs: a block lists the coordinates (tree, level, index) of the
nodes that the proofs of all its leaves need and that it cannot derive, each once; one join
fetches them; the block derives the shared interior nodes and writes out its rows' proofs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm.common import join_hot, materialize, ship

#: Children of a node, and levels that a block spans (4,096 leaves).
FAN, LEVELS = 8, 4
NODE = "tree string, level int, idx bigint, node binary"
#: The tree of trees; the trees below are "" (null) and "=" with their name.
TOP = "/"


def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*columns: Column) -> Column:
    """SHA-256 (32 bytes) of the fields one after the other."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def tree_name(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def depth(n: int, fan: int = FAN) -> int:
    """Levels from n leaves to one node."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def parent(children: list[bytes]) -> bytes:
    return sha256(b"".join(c.hex().encode() for c in children)).digest()


def raised(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and their ancestors, level by level; the last run of a level may be short."""
    out = [nodes]
    for _ in range(levels):
        nodes = [parent(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        out.append(nodes)
    return out


def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``before``: rows that the earlier ones of this partition stand for."""
    total = 0
    for batch in batches:
        m = batch.column("m").to_numpy()
        before = total + np.cumsum(m) - m
        total += int(m.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"])


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, m, others) with ``at``, the place of the first of its m leaves in its tree, and ``size``, the tree's leaves.

    Rows are dealt in ranges of (tree, order), so a tree with most of the rows is spread
    over many tasks; only counts of each pair of range and tree are added up by a window.
    """
    ship(rows.sparkSession)
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("range", F.spark_partition_id())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    dealt = materialize(dealt.mapInArrow(running, f"{kinds}, before bigint"), "ranges")
    count = dealt.groupBy("tree", "range").agg(F.sum("m").alias("total"), F.min("before").alias("base"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("total").over(tree.orderBy("range")) - F.col("total")
    count = count.select(
        F.xxhash64("tree", "range").alias("cell"), F.col("tree").alias("__tree"), F.col("range").alias("__range"),
        (earlier - F.col("base")).alias("shift"), F.sum("total").over(tree).alias("size")
    )
    joined = dealt.withColumn("cell", F.xxhash64("tree", "range")).join(count, "cell")
    return joined.where("tree = __tree and range = __range").withColumn("at", F.col("before") + F.col("shift")).drop("cell", "shift", "__tree", "__range", "range", "before")


def in_block(rows: DataFrame, levels: int, at: str = "at", m: str | None = None) -> DataFrame:
    """One row for each block that the m leaves from ``at`` lie in: block, first (place in the block) and count."""
    block = FAN**levels
    last = F.col(at) + F.col(m) - 1 if m else F.col(at)
    number = lambda c: F.shiftright(c, 3 * levels)  # noqa: E731 (whole numbers: no rounding at any size)
    out = rows.withColumn("block", F.explode(F.sequence(number(F.col(at)), number(last))))
    begin = F.greatest(F.col(at), F.col("block") * block)
    end = F.least(last, F.col("block") * block + (block - 1))
    return out.withColumn("first", (begin - F.col("block") * block).cast("int")).withColumn("count", (end - begin + 1).cast("int"))


def leaves_of(t: pa.Table) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """A block's rows in order, the row of each leaf, and its digest."""
    t = t.sort_by("first")
    row = np.repeat(np.arange(t.num_rows), t.column("count").to_numpy())
    node = t.column("node").to_pylist()
    return t, row, [node[i] for i in row]


def block_nodes(base: int, span: int) -> Callable:
    """Ancestors of a block's leaves, which are nodes of level ``base``.

    Of the lowest blocks only the top is returned: no proof of another block needs more.
    """

    def run(t: pa.Table) -> pa.Table:
        size, block, tree = (t.column(c)[0].as_py() for c in ("size", "block", "tree"))
        levels = min(span, depth(size))
        up = raised(leaves_of(t)[2], levels)
        rows = [(tree, base + k, block * FAN ** (span - k) + i, d) for k in range(1 if base else levels, levels + 1) for i, d in enumerate(up[k])]
        kinds = {"tree": pa.string(), "level": pa.int32(), "idx": pa.int64(), "node": pa.binary()}
        return pa.table({c: pa.array([x[k] for x in rows], kind) for k, (c, kind) in enumerate(kinds.items())})

    return run


def tree_nodes(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Rounds of (tree, level, idx, node): first the blocks of leaves, then those of the blocks' tops, until trees have one node.

    leaves: tree, at, m, size and node, written.  The number of rounds grows with
    the logarithm of the largest tree to the base of a block; each is one grouping of bounded groups.
    """
    out, base = [], 0
    blocks = in_block(leaves, levels, m="m").select("tree", "block", "first", "count", "size", "node")
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        nodes = blocks.where("size > 1").groupBy("tree", "block").applyInArrow(block_nodes(base, levels), NODE)
        sizes = blocks.select("tree", F.col("size").alias("below")).distinct()
        nodes = materialize(nodes, "nodes")
        out.append(nodes)
        base += levels
        if most <= FAN**levels:
            break
        most = -(-most // FAN**levels)
        tops = nodes.where(F.col("level") == base).join(sizes, "tree").withColumn("size", F.shiftright(F.col("below") + (FAN**levels - 1), 3 * levels))
        blocks = in_block(tops.where("size > 1"), levels, "idx").select("tree", "block", "first", "count", "size", "node")
    return out


def missing(level: int, lo: int, hi: int, size: int, top: int) -> list[tuple[int, int]]:
    """(level, idx) of the nodes that proofs of the nodes lo to hi - 1 of a level need and that those cannot give.

    size: nodes of this level; top: level of the tree's root.  The least such set for the
    whole range: a node is in it once, whatever the number of proofs that use it.
    """
    out = []
    while level < top:
        a, b = lo // FAN * FAN, min(size, -(-hi // FAN) * FAN)
        out += [(level, i) for i in range(a, b) if not lo <= i < hi]
        lo, hi, size, level = a // FAN, -(-b // FAN), -(-size // FAN), level + 1
    return out


def wanted(levels: int) -> Callable:
    """tree, block, in_tree, level, idx of the nodes each block needs; rows in: tree, block, size, place and trees of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = FAN**levels
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                lo, hi = r["block"] * block, min(r["size"], (r["block"] + 1) * block)
                top, trees = depth(r["size"]), depth(r["trees"])
                own = [(r["tree"], *x) for x in missing(0, lo, hi, r["size"], top)]
                above = [(TOP, *x) for x in missing(0, r["place"], r["place"] + 1, r["trees"], trees)]
                rows += [(r["tree"], r["block"], *x) for x in [*own, *above, (TOP, trees, 0)]]
            names = ["tree", "block", "in_tree", "level", "idx"]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], names=names)

    return run


def beside(nodes: dict, tree: str, level: int, at: int, size: int) -> tuple[bytes, bytes]:
    """Siblings before and after a node, as hex text, from fetched ones."""
    a = at // FAN * FAN
    run = range(a, min(size, a + FAN))
    return hexed([nodes[tree, level, i] for i in run if i < at]), hexed([nodes[tree, level, i] for i in run if i > at])


def hexed(nodes: list[bytes]) -> bytes:
    return b"".join(n.hex().encode() for n in nodes)


def block_proofs(leaves: pa.Table, fetched: pa.Table, keep: list[str], levels: int) -> pa.Table:
    """A block's rows with leaf, subroot, root, proof_sha256 and folded_root (hex text)."""
    leaves, row, digests = leaves_of(leaves)
    block, size, place, trees = (leaves.column(c)[0].as_py() for c in ("block", "size", "place", "trees"))
    tree = leaves.column("tree")[0].as_py()
    nodes = {(x["in_tree"], x["level"], x["idx"]): x["node"] for x in fetched.to_pylist()}
    top, above = depth(size), depth(trees)
    own = min(levels, top)
    inner = raised(digests, own)
    # siblings above the block are those of all its leaves: in the tree, then in the tree of trees
    outer: list[tuple[bytes, bytes]] = []
    n, at = -(-size // FAN**own), block
    for k in range(own, top):
        outer.append(beside(nodes, tree, k, at, n))
        at, n = at // FAN, -(-n // FAN)
    node = inner[-1][0].hex().encode()
    for left, right in outer:
        node = sha256(left + node + right).hexdigest().encode()
    subroot, root = node.decode(), nodes[TOP, above, 0].hex()
    n, at = trees, place
    for k in range(above):
        outer.append(beside(nodes, TOP, k, at, n))
        at, n = at // FAN, -(-n // FAN)
    tail = b"".join(left + right for left, right in outer)
    runs = [[hexed(level[i : i + FAN]) for i in range(0, len(level), FAN)] for level in inner[:own]]
    given = [g if g is not None else d for g, d in zip(leaves.column("given").to_pylist(), leaves.column("node").to_pylist())]
    proofs, folded = [], []
    for i, r in enumerate(row):
        node, at, proof = given[r].hex().encode(), i, []
        for level in runs:
            run, cut = level[at // FAN], at % FAN * 64
            left, right = run[:cut], run[cut + 64 :]
            proof += [left, right]
            node, at = sha256(left + node + right).hexdigest().encode(), at // FAN
        for left, right in outer:
            node = sha256(left + node + right).hexdigest().encode()
        proofs.append(sha256(b"".join(proof) + tail).hexdigest())
        folded.append(node.decode())
    out = leaves.select(keep).take(pa.array(row))
    same = lambda v: pa.array([v] * len(row))
    new = {"leaf": pa.array([d.hex() for d in digests]), "subroot": same(subroot), "root": same(root), "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded)}
    return pa.table({**{c: out.column(c) for c in keep}, **new})


def proofs(leaves: DataFrame, keep: list[str], levels: int = LEVELS) -> DataFrame:
    """One row for each leaf: ``keep``, leaf, subroot, root, proof_sha256, folded_root, verified.

    leaves: tree (see ``tree_name``), node (digest of the row as in the manifest), given
    (digest of the row as it was handed over; null: the same) and the columns ``keep``, by
    whose values and then ``node`` the leaves of a tree are in order, nulls first.
    ``folded_root`` is computed from ``given`` and the manifest's siblings; ``verified``
    says whether it is the root.  ``keep`` may not hold one of the result's names.

    Repeated rows travel as one with a count and are written out block by block.  No rows,
    no result.  A tree of one leaf has that leaf as its root.  ``levels``: levels of a block,
    which bounds a task's memory and changes no result.
    """
    if set(keep) & {"leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"}:
        raise ValueError("a column to keep has the name of a result")
    spark = leaves.sparkSession
    ship(spark)
    own = [f"__k{i}" for i in range(len(keep))]
    rows = leaves.groupBy("tree", *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, own)], "node", "given").agg(F.count("*").alias("m"))
    rows = ranked(materialize(rows, "rows"), [*own, "node", "given"])
    rows = materialize(rows, "leaves")
    nodes = _all([spark.createDataFrame([], NODE), *tree_nodes(rows, levels)])
    # the root of each tree: its only leaf, or its highest node
    roots = rows.where("size = 1").select("tree", "node").union(nodes.groupBy("tree").agg(F.max_by("node", "level").alias("node")))
    roots = materialize(roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "node", F.lit(1).cast("long").alias("m")), "roots")
    top = materialize(ranked(roots, ["name"]), "top")
    top_nodes = _all([nodes, top.select("tree", F.lit(0).alias("level"), F.col("at").alias("idx"), "node"), *tree_nodes(top, levels)])
    place = top.select(F.col("name").alias("tree"), F.col("at").alias("place"), F.col("size").alias("trees"))
    blocks = in_block(rows, levels, m="m")
    each = join_hot(blocks.select("tree", "block", "size").distinct(), place, "tree")
    want = each.mapInArrow(wanted(levels), "tree string, block bigint, in_tree string, level int, idx bigint")
    want = want.withColumn("coord", F.concat_ws("/", "level", "idx", "in_tree"))
    found = join_hot(want, top_nodes.select(F.concat_ws("/", "level", "idx", "tree").alias("coord"), "node"), "coord")
    found = found.select("tree", "block", "in_tree", "level", "idx", "node")
    given = join_hot(blocks.select("tree", "block", "size", "first", "count", "node", "given", *own), place, "tree")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kinds = "".join(f"`{k}` {types[k]}, " for k in own)
    out = given.groupBy("tree", "block").cogroup(found.groupBy("tree", "block"))
    out = out.applyInArrow(_proofs(own, levels), f"{kinds}leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    kept = [F.col(k).alias(c) for c, k in zip(keep, own)]
    result = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    return out.select(*kept, *result, (F.col("folded_root") == F.col("root")).alias("verified"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p.select(*out.columns))
    return out


def _proofs(keep: list[str], levels: int) -> Callable:
    def run(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        return block_proofs(leaves, fetched, keep, levels)

    return run
