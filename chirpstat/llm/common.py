"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.session import scratch_path, session_conf

#: Bound of the per-task memo tables (entries), so that a task's memory does
#: not grow with the number of distinct words it meets.
MEMO_ENTRIES = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark's own reader (any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs in the block: for rows that are packed blocks."""
    with session_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        yield


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text and doc: a number in the order of the documents.

    It is the id itself where ids are unique and not null. Otherwise rows with
    equal id and text have one number, other rows of one id are ordered by a
    hash of the text, and null ids come first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    if odd.isEmpty():
        return rows.withColumn("doc", F.col("doc_id"))
    named = rows.withColumn("t", F.xxhash64("text"))
    order = named.select("doc_id", "t").distinct().repartitionByRange("doc_id", "t").sortWithinPartitions("doc_id", "t")
    order = land(order.withColumn("doc", F.monotonically_increasing_id()), "document-order")
    joined = named.alias("r").join(order.alias("o"), F.expr("r.doc_id <=> o.doc_id AND r.t = o.t"))
    return joined.select("r.doc_id", "r.text", "o.doc")


def whole_groups(batches: Iterator[pd.DataFrame], key: str, least: int = 20_000) -> Iterator[pd.DataFrame]:
    """Frames of at least about `least` rows, cut between groups, from a partition sorted by `key`.

    A frame holds every row of its keys, so memory is bounded by `least` and by
    the largest group; callers keep groups bounded.
    """
    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        for lo in range(0, len(batch), least):
            held.append(batch.iloc[lo : lo + least])
            n += len(held[-1])
            if n < least:
                continue
            rows = pd.concat(held, ignore_index=True)
            keys = rows[key].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            held = [rows.iloc[cut:]]
            n = len(held[0])
            if cut:
                yield rows.iloc[:cut].reset_index(drop=True)
            else:  # one group so far: gather twice as much before looking again
                least *= 2
    if n:
        yield pd.concat(held, ignore_index=True)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node of each connected component of edges (a, b), by alternating stars.

    Every round lands its edges in the shared folder. Nodes with many edges
    only take part in minima and in joins that Spark may split.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, state = land(edges, name), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if tuple(now) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        state = tuple(now)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = land(large, name)
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = land(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), name)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; null ids have no remainder (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


class Lookup(dict):
    """key -> make(key), remembered; emptied when it holds `entries` keys."""

    def __init__(self, make: Callable, entries: int = MEMO_ENTRIES):
        super().__init__()
        self._make = make
        self._entries = entries

    def __missing__(self, key):
        value = self._make(key)
        if len(self) >= self._entries:
            self.clear()
        self[key] = value
        return value


def release_memory() -> None:
    """Give memory that is free, but kept by Arrow's or C's allocator, back to the system.

    A Python worker lives on after a task, and what it keeps counts for its executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def utf8_rows(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as a zero-padded matrix of code points, and their lengths (<= width)."""
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    arr = np.array(words, dtype=f"<U{width}")
    codes = arr.view("<u4").reshape(len(words), width) if len(words) else np.zeros((0, width), "<u4")
    return codes, np.minimum(lens, width)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a well mixed 64-bit hash of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
