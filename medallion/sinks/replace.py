"""Crash-safe replacement of a table folder (K1).

Spark's own overwrite deletes the target first: a run that fails half-way leaves no table. Here the new rows
are written to a hidden folder beside the table; only when that is complete does a small commit file
``.<table>.commit`` appear, by one rename. From then on the new folder *is* the table: :func:`settle` moves the old one
away, the new one in its place, and removes the old and the commit file. Each of these steps can be repeated, so
whoever next writes or reads the table through this library finishes what a dead writer left.

* A run that fails or dies before the commit: the old table stands, untouched.
* Death after the commit: the next :func:`settle` completes it. Between its two renames a reader that does not call
  it finds no folder; it never finds a mixture.
* Two writers: commit files are created one at a time (rename without overwrite, atomic on HDFS; a lock
  inside one process). Each commit is settled before the next one, so the table is wholly the rows of the last.

The table stays a plain folder of Parquet files under its own name, readable by anything.
Folders of killed runs are removed by the next replacement once they are :data:`ABANDONED_S` old. A store without
atomic folder renames (an object store) keeps the first guarantee, not the second.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from medallion import fs

ABANDONED_S = 24 * 3600
TRIES = 100

_locks: dict[str, threading.RLock] = {}
_guard = threading.Lock()


def _lock(path: str) -> threading.RLock:
    with _guard:
        return _locks.setdefault(path, threading.RLock())


def _beside(path: str, suffix: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{suffix}"


def settle(spark: SparkSession, path: str) -> bool:
    """Completes a committed replacement of ``path`` that is not finished; says whether there was one."""
    path = path.rstrip("/")
    if not fs.exists(spark, _beside(path, "commit")):
        return False
    with _lock(path):
        text = fs.read_text(spark, _beside(path, "commit"))
        if text is None:  # another process was quicker
            return False
        state = json.loads(text)
        if fs.exists(spark, state["new"]):
            if fs.exists(spark, path):
                fs.rename(spark, path, state["old"])
            fs.rename(spark, state["new"], path)
        fs.delete(spark, _beside(path, "commit"))
        fs.delete(spark, state["old"])
    return True


def _sweep(spark: SparkSession, path: str) -> None:
    for kind in ("new", "old"):
        for left, changed in fs.glob_times(spark, _beside(path, f"{kind}-*")):
            if time.time() - changed > ABANDONED_S:
                fs.delete(spark, left)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write(folder)`` writes the new table into a folder that does not exist; then it replaces ``path``."""
    path = path.rstrip("/")
    run = uuid.uuid4().hex[:12]
    new = _beside(path, f"new-{run}")
    try:
        write(new)
    except BaseException:
        fs.delete(spark, new)
        raise
    draft = _beside(path, f"draft-{run}")
    fs.touch(spark, draft, json.dumps({"new": new, "old": _beside(path, f"old-{run}")}))
    with _lock(path):
        for _ in range(TRIES):
            settle(spark, path)
            if fs.rename_new(spark, draft, _beside(path, "commit")):
                break
            time.sleep(0.1)  # another process has just committed
        else:
            fs.delete(spark, new)
            fs.delete(spark, draft)
            raise TimeoutError(f"{path}: other writers' commits could not be settled")
        settle(spark, path)
    _sweep(spark, path)
