"""Shared-folder helpers: where intermediate tables and stream checkpoints go.

On a cluster the shared folder is the one named by `spark.checkpoint.dir`;
it is read from the session, never invented. Only when it is unset (a local
test session) is a fresh folder created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, set up for tests when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if not configured:
        if not sc.master.startswith("local"):
            # A driver-local folder is invisible to executors: refuse, do not guess.
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder every executor can reach"
            )
        # Local sessions (tests, bench) only: one JVM, so a temp folder is shared.
        configured = tempfile.mkdtemp(prefix="chirpstat-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "chirpstat", f"{name}-{uuid.uuid4().hex[:12]}")


def _located(spark: SparkSession, path: str):
    """The path and its file system, on whatever file system the path names."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    hpath, fs = _located(spark, path)
    return fs.exists(hpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is missing)."""
    return sorted(list_changed(spark, path))


def list_changed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder (none if it is missing) and when each was last changed, in milliseconds."""
    hpath, fs = _located(spark, path)
    if not fs.exists(hpath):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(hpath)}


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder written by this library (recursively), on any file system."""
    hpath, fs = _located(spark, path)
    return fs.delete(hpath, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the new name must be free."""
    hpath, fs = _located(spark, path)
    target, _ = _located(spark, to)
    if fs.exists(target) or not fs.rename(hpath, target):
        raise OSError(f"cannot move {path} to {to}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet. Returns False if it does."""
    hpath, fs = _located(spark, path)
    if fs.exists(hpath):
        return False
    try:
        out = fs.create(hpath, False)
    except Exception:
        if fs.exists(hpath):  # someone else was faster
            return False
        raise
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small UTF-8 file."""
    hpath, fs = _located(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def land(df: DataFrame, spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    re-running the source) and turns row-shaped input into a columnar table,
    so later queries get column pruning and filter pushdown.
    """
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Write `df` and count in the same pass: `write` gets the frame to be written.

    The counts (aggregates such as `F.count`) are taken where the rows go into
    the files, in the last stage, whose tasks report once however often they are
    retried; the plan runs once. Always has `rows`.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]))
    return {n: seen.get.get(n) or 0 for n in ("rows", *counts)}


def land_counted(df: DataFrame, spark: SparkSession, name: str, path: str | None = None, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """`land`, with counts taken while the rows are written (see `observed_write`)."""
    path = path or scratch_path(spark, name)
    found = observed_write(df, lambda rows: rows.write.mode("overwrite").parquet(path), **counts)
    return spark.read.schema(df.schema).parquet(path), found


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist `df` for the actions inside the block, then release it.

    Meant for small results read by more than one action (an emptiness test
    and a write, a preview and a write). A lost executor only costs a
    recompute from lineage; large intermediate tables use `land` instead.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one runtime SQL setting for the block, then put the old value back."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
