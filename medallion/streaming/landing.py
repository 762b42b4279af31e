"""Incremental landing (S9): every file in a source folder is ingested once.

The original copied each local file into ``/data/<stem>/<file>`` unless a
file of that name was already there. Here a *ledger* table in the checkpoint folder
holds the files that have been landed. A run lists the source, takes what the ledger lacks
(a left anti-join of the two tables), and lands it in batches, oldest first, each one in two
steps that survive a crash at any point:

1. the rows are written to ``<bronze>/_staged-<n>`` (hidden from readers; written anew if a run dies here);
2. the ledger rows of batch n are published by one rename, which is the commit, and the staged
   rows by another, to ``<bronze>/landed_batch=<n>``. A run that finds a committed batch whose rows
   are still staged finishes it first.

So no file is landed twice and none is lost, and nothing grows on the driver but the names of one batch's
files. Identity is the path, not the content: a file rewritten under a name already landed
is not read again, and a file is landed however old it is. An empty file holds nothing to land (Spark's
listing leaves it out). A run that fails raises (the original printed and went on).

:func:`land` reads any file format. :func:`land_ranges` copies files of any size as byte ranges: a file of
many ranges is read by as many tasks, and no row is larger than a range.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medallion import fs
from medallion.operators.metrics import observed
from medallion.session import scratch, ship_package
from medallion.streaming.sha256 import Sha256

# The schemas of the file formats whose layout does not depend on content.
FIXED_SCHEMAS = {
    "binaryFile": "path string, modificationTime timestamp, length bigint, content binary",
    "text": "value string",
}

BATCH = "landed_batch"
PROVENANCE = ("source_file", "stem", BATCH)  # the columns landing adds
BATCH_FILES = 10_000  # files of a batch unless the caller says otherwise: what the driver names at a time
RANGE_BYTES = 8 << 20
TASK_BYTES = 64 << 20  # what a task reads, of a file where the order matters, of ranges where it does not
LEDGER = "path string, length bigint, modified timestamp, n_rows bigint, batch int"


class ConcurrentLanding(RuntimeError):
    pass


@dataclass
class LandingRun:
    rows: int
    batches: int


def stem_of(path_col: str = "source_file") -> F.Column:
    """File name without directory and last extension."""
    name = F.element_at(F.split(F.col(path_col), "/"), -1)
    # the path is percent-encoded; a plus sign stands for itself
    name = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return F.regexp_replace(name, r"\.[^.]*$", "")


# --- the ledger -----------------------------------------------------------------------

def ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per landed file: path, length, modified, rows of its batch, batch."""
    path = f"{checkpoint.rstrip('/')}/ledger"
    if not fs.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def landing_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What each committed batch brought: batch, files, bytes, rows (A2 for the landing runs)."""
    return (ledger(spark, checkpoint).groupBy("batch")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("n_rows").alias("rows")))


def listing(spark: SparkSession, source_dir: str) -> DataFrame:
    """Path, length and time of the source's files: metadata only, no content is read."""
    return (spark.read.format("binaryFile").load(source_dir)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    return sorted(int(m.group(1)) for m in (re.search(r"(\d+)$", p) for p in fs.glob(spark, pattern)) if m)


def _publish(spark: SparkSession, bronze: str, n: int) -> None:
    if fs.exists(spark, f"{bronze}/_staged-{n}"):
        fs.rename(spark, f"{bronze}/_staged-{n}", f"{bronze}/{BATCH}={n}")


def _land(spark: SparkSession, source_dir: str, bronze: str, checkpoint: str, max_files: int | None,
          read: Callable[[DataFrame], DataFrame]) -> LandingRun:
    bronze, checkpoint = bronze.rstrip("/"), checkpoint.rstrip("/")
    if fs.exists(spark, f"{bronze}/_spark_metadata"):
        raise ValueError(f"{bronze} was written by a streaming sink, whose log hides other files; land into a new folder")
    done = _numbers(spark, f"{checkpoint}/ledger/batch=*")
    for n in _numbers(spark, f"{bronze}/_staged-*"):
        if n in done:
            _publish(spark, bronze, n)  # committed by a run that died before publishing
    n = done[-1] + 1 if done else 0
    pending = f"{checkpoint}/_pending"
    (listing(spark, source_dir).join(ledger(spark, checkpoint).select("path"), "path", "left_anti")
     .repartitionByRange("modified", "path").sortWithinPartitions("modified", "path")
     .write.mode("overwrite").parquet(pending))
    todo = spark.read.schema("path string, length bigint, modified timestamp").parquet(pending)
    size = max_files or BATCH_FILES
    rows = batches = 0
    last = None
    while True:
        rest = todo
        if last is not None:  # the first condition reaches the files' statistics
            rest = todo.filter(F.col("modified") >= F.lit(last["modified"])).filter(
                F.struct("modified", "path") > F.struct(F.lit(last["modified"]), F.lit(last["path"])))
        taken = f"{checkpoint}/_taken"
        rest.orderBy("modified", "path").limit(size).write.mode("overwrite").parquet(taken)
        batch = spark.read.schema(todo.schema).parquet(taken)
        last = batch.agg(F.max(F.struct("modified", "path")).alias("m")).first()["m"]
        if last is None:
            return LandingRun(rows, batches)
        out, seen = observed(read(batch), f"land-{n}", rows=F.count(F.lit(1)))
        out.write.mode("overwrite").parquet(f"{bronze}/_staged-{n}")
        landed = int(seen.get["rows"])
        entry = f"{checkpoint}/_entry-{n}"
        (batch.withColumn("n_rows", F.lit(landed).cast("long")).write.mode("overwrite").parquet(entry))
        fs.mkdirs(spark, f"{checkpoint}/ledger")
        if not fs.rename_new(spark, entry, f"{checkpoint}/ledger/batch={n}"):
            raise ConcurrentLanding(f"batch {n} of {checkpoint} was committed by another run")
        _publish(spark, bronze, n)
        rows, batches, n = rows + landed, batches + 1, n + 1


# --- files parsed on the way ------------------------------------------------------------

_GLOB = re.compile(r"([\\{}\[\]*?])")


def land(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint: str,
         fmt: str = "binaryFile", schema: StructType | str | None = None,
         options: dict[str, str] | None = None, max_files_per_trigger: int | None = None) -> LandingRun:
    """Land the files of ``source_dir`` not landed before; return what this run added.

    ``fmt`` is any file source: ``binaryFile`` copies bytes as they are,
    ``text``/``json``/``csv`` parse into rows on the way. The bronze table keeps
    the source path, stem and batch of every row.
    """
    declared = schema if schema is not None else FIXED_SCHEMAS.get(fmt)

    def read(batch: DataFrame) -> DataFrame:
        reader = spark.read.format(fmt)
        if declared is not None:
            reader = reader.schema(declared)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        names = [_GLOB.sub(r"\\\1", r["path"]) for r in batch.select("path").collect()]  # one batch's
        return (reader.load(names).withColumn("source_file", F.col("_metadata.file_path"))
                .withColumn("stem", stem_of("source_file")))

    return _land(spark, source_dir, bronze_path, checkpoint, max_files_per_trigger, read)


# --- files of any size as byte ranges ------------------------------------------------------

_RANGES = pa.schema([("source_file", pa.string()), ("offset", pa.int64()), ("n_bytes", pa.int64()),
                     ("file_bytes", pa.int64()), ("crc32", pa.int64()), ("content", pa.binary())])


def store_of(uri: str):
    """The file system of a URI and the path in it, in a worker."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _read_ranges(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, length, offset in zip(*(b.column(c).to_pylist() for c in ("path", "length", "offset"))):
                store, name = store_of(path)
                want = min(size, length - offset)
                with store.open_input_file(name) as f:
                    content = f.read_at(want, offset)
                if len(content) != want:
                    raise OSError(f"{path}: {len(content)} bytes at {offset}, {want} were listed; the file has changed")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t.type) for x, t in zip((path, offset, want, length, zlib.crc32(content), content), _RANGES)],
                    schema=_RANGES)
    return run


def land_ranges(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint: str,
                range_bytes: int = RANGE_BYTES, max_files_per_trigger: int | None = None) -> LandingRun:
    """Land files byte for byte as ranges of ``range_bytes``: source_file, stem, offset, n_bytes, file_bytes,
    crc32, content. Ranges, not files, are dealt to tasks, each task's one after the other, so that a reader
    of a part of a file finds it in a few bronze files.

    Workers open the source themselves: local, HDFS and object-store URIs that Arrow knows."""
    ship_package(spark)

    def read(batch: DataFrame) -> DataFrame:
        ranges = batch.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1,
                                                                     F.lit(range_bytes).cast("long"))).alias("offset"))
        n = batch.agg(F.sum(F.ceil(F.col("length") / F.lit(range_bytes)))).first()[0]
        wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * range_bytes // TASK_BYTES))
        content = ranges.repartitionByRange(wide, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(
            _read_ranges(range_bytes), "source_file string, offset bigint, n_bytes bigint, file_bytes bigint, "
                                       "crc32 bigint, content binary")
        return content.withColumn("stem", F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.[^.]*$", ""))

    return _land(spark, source_dir, bronze_path, checkpoint, max_files_per_trigger, read)


class Crc32:
    """CRC-32 of a concatenation from the parts' CRCs and lengths: a CRC is linear over GF(2), so
    appending zero bytes is a 32 x 32 bit matrix, and its powers of two are kept."""

    POLY = 0xEDB88320  # fixed value: the reflected polynomial of CRC-32

    def __init__(self):
        bit = [self.POLY] + [1 << i for i in range(31)]  # one zero bit appended, as images of the unit vectors
        byte = bit
        for _ in range(3):
            byte = self._square(byte)
        self.zeros = [byte]  # zeros[k]: 2^k zero bytes

    @staticmethod
    def _apply(m: list[int], v: int) -> int:
        out = 0
        for i in range(32):
            if v >> i & 1:
                out ^= m[i]
        return out

    def _square(self, m: list[int]) -> list[int]:
        return [self._apply(m, x) for x in m]

    def join(self, first: int, second: int, second_bytes: int) -> int:
        k = 0
        while second_bytes >> k:
            if k == len(self.zeros):
                self.zeros.append(self._square(self.zeros[-1]))
            if second_bytes >> k & 1:
                first = self._apply(self.zeros[k], first)
            k += 1
        return first ^ second


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    crc = Crc32()
    schema = pa.schema([("source_file", pa.string()), ("n_bytes", pa.int64()), ("n_ranges", pa.int64()),
                        ("crc32", pa.int64()), ("complete", pa.bool_())])
    for b in batches:
        out = []
        for name, parts, size in zip(*(b.column(c).to_pylist() for c in ("source_file", "parts", "file_bytes"))):
            at, total = 0, 0
            ok = True
            for p in parts:
                ok = ok and p["offset"] == at
                total = crc.join(total, p["crc32"], p["n_bytes"])
                at += p["n_bytes"]
            out.append((name, at, len(parts), total, ok and at == size))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def file_checksums(bronze: DataFrame) -> DataFrame:
    """Per landed file: n_bytes, n_ranges, the whole file's CRC-32 and whether every byte is there.

    Combined from the ranges' own checksums: the content is not read (nor shuffled)."""
    ship_package(bronze.sparkSession)
    parts = (bronze.groupBy("source_file")
             .agg(F.array_sort(F.collect_list(F.struct("offset", "n_bytes", "crc32"))).alias("parts"),
                  F.max("file_bytes").alias("file_bytes")))  # a small tuple per range
    return parts.mapInArrow(_whole, "source_file string, n_bytes bigint, n_ranges bigint, crc32 bigint, complete boolean")


_DIGESTS = pa.schema([("source_file", pa.string()), ("n_bytes", pa.int64()), ("sha256", pa.string()), ("crc32", pa.int64()),
                      ("state", pa.binary())])
CARRIED = -1  # the offset of a row that holds the state of what was read before


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(name: str, sha: Sha256, crc: int) -> pa.RecordBatch:
        values = (name, sha.n_bytes, sha.hexdigest(), crc, struct.pack(">I", crc) + sha.state())
        return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(values, _DIGESTS)], schema=_DIGESTS)

    last = None
    for b in batches:
        for name, offset, content in zip(b.column("source_file").to_pylist(), b.column("offset").to_pylist(), b.column("content")):
            if last is None or last[0] != name:
                if last is not None:
                    yield row(*last)
                last = [name, Sha256(), 0]
            part = content.as_buffer()
            if offset == CARRIED:
                last[1:] = Sha256(part.slice(4).to_pybytes()), struct.unpack(">I", part.slice(0, 4).to_pybytes())[0]
            else:
                last[1].update(part)
                last[2] = zlib.crc32(part, last[2])
    if last is not None:
        yield row(*last)


def reassembled_digests(bronze: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """Per landed file, read through in order: n_bytes, sha256, crc32.

    In rounds: each reads the next ``task_bytes`` (:data:`TASK_BYTES`) of every file that has more, a file's share in one task, which
    goes on from the state the last round's left. So no task reads a large file whole, and a digest still takes
    its bytes one after the other. Runs when called; what is returned reads the rounds' results."""
    spark, task_bytes = bronze.sparkSession, task_bytes or TASK_BYTES
    ship_package(spark)
    root = scratch(spark, "digests")
    chunk = F.floor(F.col("offset") / F.lit(task_bytes))
    bronze.groupBy("source_file").agg(F.max(chunk).alias("chunk")).write.parquet(f"{root}/ends")
    ends = spark.read.parquet(f"{root}/ends")  # a row per file: its last round
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = None
    for turn in bronze.groupBy(chunk.alias("chunk")).agg(F.sum("n_bytes").alias("size")).orderBy("chunk").collect():  # a row per round
        k = turn["chunk"]
        rows = (bronze.filter((F.col("offset") >= k * task_bytes) & (F.col("offset") < (k + 1) * task_bytes))
                .select("source_file", "offset", "content"))
        if before is not None:
            more = spark.read.parquet(before).join(ends.filter(F.col("chunk") >= k), "source_file", "left_semi")
            rows = rows.unionByName(more.select("source_file", F.lit(CARRIED).cast("long").alias("offset"), F.col("state").alias("content")))
        parts = 2 * turn["size"] // task_bytes  # of many files, a task gets the shares of a few
        dealt = rows.repartition(parts, "source_file") if parts > wide else rows.repartition("source_file")
        before = f"{root}/rounds/chunk={k}"
        (dealt.sortWithinPartitions("source_file", "offset")
         .mapInArrow(_digest, "source_file string, n_bytes bigint, sha256 string, crc32 bigint, state binary").write.parquet(before))
    if before is None:
        return spark.createDataFrame([], "source_file string, n_bytes bigint, sha256 string, crc32 bigint")
    return (spark.read.parquet(f"{root}/rounds").join(ends, ["source_file", "chunk"])
            .select("source_file", "n_bytes", "sha256", "crc32"))
