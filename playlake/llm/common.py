"""Shared folder, table cutting and connected components for the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share, from ``spark.checkpoint.dir``.

    Only a session in local mode may lack the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = jsc.get() if jsc.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="playlake-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for sessions that
    were started without it on the executors' Python path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="playlake-ship-")).resolve()
    with zipfile.ZipFile(folder / f"{root.name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for f in [root / "__init__.py", *sorted((root / "llm").glob("*.py"))]:
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(folder / f"{root.name}.zip"))
    _SHIPPED.add(sc.applicationId)
    # whole texts travel to the workers: fewer rows at a time than Spark's default
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


#: What a Python worker keeps from one task to the next: module of the operator that needs it ->
#: how to let go of it.
KEPT: dict[str, Callable[[], None]] = {}


def release_others(owner: str) -> None:
    """Let go of what this worker keeps for operators of other modules."""
    for other in [m for m in KEPT if m != owner]:
        KEPT.pop(other)()


def lean(run: Callable) -> Callable:
    """A function of Arrow batches that gives back the memory it has freed when it ends.

    Python workers serve one task after another, and what NumPy and Arrow have freed stays
    with the process, so that an executor's workers would keep the peak of every stage. What
    another operator keeps in the worker (``KEPT``) is given up when this one begins.
    """
    owner = run.__module__

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playlake.llm import common  # the worker's own module, not a pickled copy

        common.release_others(owner)
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return wrapped


_RECORDS: list[list[str]] = []


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Note the tables that ``materialize`` writes meanwhile."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.pop()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete noted tables; frames that read them must have been written by now."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    paths.clear()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back: its lineage
    ends there, so a lost executor costs a reread and no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _RECORDS:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a filter at most: 16 MB.
FILTER_BITS = 27


def hash_filter(hashes: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test whether a 64-bit hash may be in a column of them: true for all that are, and for
    few others.  It keeps rows that a join cannot match out of its shuffle.

    The filter is one bit array of at most 2**FILTER_BITS bits, whatever the number of
    hashes; beyond some ten million it lets more through, which costs time, not results.
    """
    spark = hashes.sparkSession
    ship(spark)
    n = hashes.count()
    bits = min(FILTER_BITS, max(16, int(16 * n).bit_length()))
    at = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = hashes.select(F.shiftright(at, 6).alias("w"), at.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    rows = rows.groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("m")).toArrow()  # 2**bits / 64 rows at most
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    shared = spark.sparkContext.broadcast(words.view(np.uint64))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        k = h.to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)
        word = shared.value[(k >> np.uint64(6)).astype(np.int64)]
        return pd.Series((word >> (k & np.uint64(63)) & np.uint64(1)) > 0)

    return maybe


def join_hot(rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows with an aggregate of one row a key, where a key may hold a third of the rows.

    An aggregate by the key is already dealt out by it, and Spark then joins without an
    exchange of its own, whose large partitions it could not split at run time.  The second
    join column, a function of the key, makes it deal out both sides for the join.
    """
    left = rows.withColumn("__deal", F.xxhash64(F.lit("join"), key))
    right = per_key.withColumn("__deal", F.xxhash64(F.lit("join"), key))
    return left.join(right, [key, "__deal"], how).drop("__deal")


def all_stars(edges: DataFrame) -> bool:
    """Whether each left node (a) has one right node (b) only, and no right node is a left one."""
    none = F.lit(None).cast(edges.schema["b"].dataType).alias("to")
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), none))
    node = edges.select(F.inline(ends)).groupBy("node")
    node = node.agg(F.min("to").alias("low"), F.max("to").alias("high"), F.count("to").alias("left"), F.count("*").alias("all"))
    return not node.where("low <> high or (left > 0 and left < all)").take(1)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node of its component.

    Alternates large-star and small-star steps until only stars are left: each keeps the
    components and moves edges towards the least neighbour, so the number of rounds grows
    with the logarithm of the largest component, not with its diameter.  Edges run from the
    greater node a to the lesser one b, so a node's least neighbour is the minimum over its
    rows as a.  All steps are grouped minima and joins; nothing is collected but whether a
    node is left that breaks the stars.  A round's table is deleted when the next is written.
    Loops and nulls are ignored; an empty frame gives an empty result.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    last: list[str] = []
    with recording(last):
        e = materialize(e.distinct(), "edges")
    while not all_stars(e):
        least = e.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
        large = e.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        written: list[str] = []
        with recording(written):
            e = materialize(small.union(low.select("a", F.col("m").alias("b"))), "edges")
        drop_tables(spark, last)
        last = written
    pairs = e.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.union(pairs.select(F.col("root").alias("node"), "root").distinct())
