"""Helpers shared by the training-data operators.

* :func:`cut` writes a frame as a table in the shared scratch folder
  (``spark.checkpoint.dir``) and reads it back, so a lost executor costs re-run tasks
  only; the shuffle files of the finished job are released at once.
* :func:`slots` places numbered buckets on shuffle partitions one to one.
* :func:`text_key` hashes a text; with the id it names a row.
* :func:`lean` lets a Python worker hand freed memory back while its task runs and when it ends.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import scratch, ship_package

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Bytes of input that one bucket of a packed shuffle stands for.
BUCKET_BYTES = 12 << 20
MAX_BUCKETS = 1 << 16  # buckets are cut from 16 hash bits

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def session(df: DataFrame) -> SparkSession:
    """The frame's session, with the package on its workers. Arrow batches are bounded by bytes
    (long texts; the default of 64 MB is held several times over), unless the session sets a bound itself."""
    spark = df.sparkSession
    ship_package(spark)
    if not spark.sparkContext.getConf().contains(_BATCH) and spark.conf.get(_BATCH) == "67108864b":
        spark.conf.set(_BATCH, str(_BATCH_BYTES))
    return spark


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    old = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, old)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a packed shuffle of ``df``: the session's shuffle partitions, or more
    where the optimizer's size estimate says that a bucket would grow beyond
    ``bucket_bytes`` of input. Any count gives the same result."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(MAX_BUCKETS, max(parts, min(size // bucket_bytes, 64 * parts))))


def give_back() -> None:
    """Hands memory that Arrow and the C allocator hold as free back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` (a mapInArrow function) whose worker keeps no freed memory: workers are reused by later
    tasks and stages, and what one of them holds as free counts against its executor."""
    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            for out in run(batches):
                yield out
                del out
                give_back()
        finally:
            give_back()
    return wrapped


def slots(spark: SparkSession, n: int) -> np.ndarray:
    """For each bucket 0..n-1 a long that Spark's hash partitioner sends to partition = bucket
    when there are n partitions (any other count still keeps a bucket together)."""
    found = np.full(n, -1, np.int64)
    lo, step = 0, max(1024, 24 * n)
    while (found < 0).any():
        ids = np.arange(lo, lo + step, dtype=np.int64)
        part = _murmur3(ids) % n
        first = np.unique(part, return_index=True)
        new = found[first[0]] < 0
        found[first[0][new]] = ids[first[1][new]]
        lo += step
    return found


def _murmur3(v: np.ndarray) -> np.ndarray:
    """Spark's hash() of a long (Murmur3 x86 32 bit, seed 42), non-negative modulo ready."""
    with np.errstate(over="ignore"):
        def rotl(x, r):
            return (x << np.uint32(r)) | (x >> np.uint32(32 - r))

        h = np.full(len(v), 42, np.uint32)
        u = v.astype(np.int64).view(np.uint64)
        for word in ((u & np.uint64(0xFFFFFFFF)).astype(np.uint32), (u >> np.uint64(32)).astype(np.uint32)):
            k = rotl(word * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
            h = rotl(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(8)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64)


def text_key(text: str = "text") -> Column:
    """64-bit hash of the text; with the id it names a row (equal rows share decisions)."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
