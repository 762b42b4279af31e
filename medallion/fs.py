"""Metadata-only file-system calls through the Hadoop FileSystem API.

These touch names, never data: existence checks, listings and renames. They
work on any Hadoop-compatible store (HDFS, object stores, local disk), so the
same code runs on a cluster and in local tests.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    statuses = fs.globStatus(p)
    if statuses is None:
        return []
    return sorted(str(s.getPath().toString()) for s in statuses)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str, overwrite: bool = False) -> None:
    jvm = spark.sparkContext._jvm
    fs, s = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    if overwrite and fs.exists(d):
        fs.delete(d, True)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder; nothing happens where there is none."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename_new(spark: SparkSession, src: str, dst: str) -> bool:
    """Renames a file unless ``dst`` exists (one atomic step on HDFS); says whether it did."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    _, p = _fs(spark, src)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri() if p.toUri().getScheme() else _fs(spark, src)[0].getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(a, b, options)
    except Exception as e:  # noqa: BLE001 - the JVM's class tells
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small UTF-8 file; None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def glob_times(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths that match, with the time of their last change in seconds."""
    fs, p = _fs(spark, pattern)
    return [(str(s.getPath().toString()), s.getModificationTime() / 1000) for s in fs.globStatus(p) or []]


def set_time(spark: SparkSession, path: str, seconds: int) -> None:
    """Sets a file's time of last change."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, seconds * 1000, -1)


def touch(spark: SparkSession, path: str, text: str = "") -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form (``file:/…``, ``hdfs://…``) used to compare paths."""
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString()).rstrip("/")


def total_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Sum of the sizes of ``paths`` (files or folders), from metadata only."""
    total = 0
    for path in paths:
        fs, p = _fs(spark, path)
        total += int(fs.getContentSummary(p).getLength())
    return total
