"""Sparse text features for the small models that are trained here (operators 6 and 7).

A model is fitted in one task on a bounded sample of rows, whose features are made on the executors;
what returns to the driver is the model alone (a bounded number of features). Scoring is a
vectorised pass over all texts: the words' 64-bit hashes are looked up in the model's
sorted feature hashes behind a bit filter, so unknown words cost one table read.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.words import U

MAX_FEATURES = 20_000
_BITS = 22


class Vocabulary:
    """Sorted feature hashes with a bit filter (made on the worker)."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(U))

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``h`` that are features, and the features' numbers."""
        if not hasattr(self, "_bits"):
            self._bits = np.zeros(1 << _BITS, bool)
            self._bits[(self.hashes >> U(64 - _BITS)).astype(np.int64)] = True
        maybe = np.flatnonzero(self._bits[(h >> U(64 - _BITS)).astype(np.int64)])
        at = np.searchsorted(self.hashes, h[maybe])
        ok = at < len(self.hashes)
        ok[ok] = self.hashes[at[ok]] == h[maybe][ok]
        return maybe[ok], at[ok]

    def __getstate__(self):
        return {"hashes": self.hashes}


def by_class(known: DataFrame, label: str, sample: int) -> tuple[DataFrame, float]:
    """At most ``sample`` rows of ``known`` (l_id, ``label``), the first ids by hash per class (0, above 0): half
    the bound each, or more where the other class has fewer; and by how much that moved the log odds."""
    above = F.col(label) > 0
    n = {k: 0 for k in (False, True)} | {r.k: r["count"] for r in known.groupBy(above.alias("k")).count().collect()}
    take = {k: min(n[k], max(sample // 2, sample - n[not k])) for k in n}
    rows = [known.filter(above == k).orderBy(F.md5(F.col("l_id").cast("string")), "l_id").limit(take[k]) for k in n]
    moved = np.log(take[True] / take[False]) - np.log(n[True] / n[False]) if all(take.values()) else 0.0
    return rows[0].unionByName(rows[1]), float(moved)


def counts_by_row(row: np.ndarray, feature: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs and their counts."""
    key, n = np.unique(row.astype(np.int64) * size + feature, return_counts=True)
    return key // size, key % size, n


def select_features(hashes: np.ndarray, rows: np.ndarray, y: np.ndarray, limit: int, min_rows: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The features most associated with y (0/1 per row; -1: unknown), by the score of a two-sample
    test of their row shares: (hashes, scores). One entry per (row, feature) is expected."""
    known = y[rows] >= 0
    u, inv = np.unique(hashes[known], return_inverse=True)
    pos = np.bincount(inv, weights=(y[rows[known]] == 1), minlength=len(u))
    all_ = np.bincount(inv, minlength=len(u))
    n1, n0 = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    p1, p0 = pos / n1, (all_ - pos) / n0
    p = all_ / (n1 + n0)
    z = (p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[all_ < min_rows] = 0
    order = np.lexsort((u, -np.abs(z)))[:limit]
    order = order[np.abs(z[order]) > 2]
    return u[order], z[order]


def adam(gradient, x0: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Plain full-batch Adam."""
    x, m, v = x0.copy(), np.zeros_like(x0), np.zeros_like(x0)
    for t in range(1, steps + 1):
        g = gradient(x)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def dump(model: dict) -> bytes:
    buf = io.BytesIO()
    np.savez_compressed(buf, **model)
    return buf.getvalue()


def load(blob: bytes) -> dict:
    with np.load(io.BytesIO(blob)) as z:
        return {k: z[k] for k in z.files}


def one_row(blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["model"])
