"""Words, lines and their hashes for whole Arrow batches of texts, vectorised.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are 64-bit
polynomial hashes over a random value per byte, finalised with the length, so a
prefix sum over a stretch of bytes yields the hash of every word in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 20
_SEG = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (in place on a fresh array)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(33))
        x *= U(0xFF51AFD7ED558CCD)
        x ^= x >> U(33)
        x *= U(0xC4CEB9FE1A85EC53)
        x ^= x >> U(33)
    return x


_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
BYTES = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
BYTES_LOWER = BYTES.copy()
BYTES_LOWER[65:91] = BYTES[97:123]
# Odd multipliers for word sequences; differences stay divisible by two only.
_MULT = (mix(np.arange(1, 4097, dtype=U)) & ~U(3)) | (U(1) + U(2) * (np.arange(4096, dtype=U) & U(1)))

_pow = np.ones(1, U)
_inv = np.ones(1, U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, _SEG + 1)
        for name, base in (("_pow", _BASE), ("_inv", _INV)):
            p = np.full(size, base, U)
            p[0] = 1
            with np.errstate(over="ignore"):
                np.multiply.accumulate(p, out=p)
            globals()[name] = p
    return _pow[:n], _inv[:n]


def hash_spans(table: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for ascending, non-overlapping spans."""
    out = np.empty(len(starts), U)
    i, n = 0, len(starts)
    with np.errstate(over="ignore"):
        while i < n:
            base = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, base + _SEG, side="right")))
            stop = int(ends[j - 1])
            p, inv = _powers(stop - base + 1)
            c = np.zeros(stop - base + 1, U)
            np.cumsum(table[data[base:stop]] * p[:-1], out=c[1:])
            s = starts[i:j] - base
            out[i:j] = (c[ends[i:j] - base] - c[s]) * inv[s]
            i = j
        return mix(out + (ends - starts).astype(U) * U(0xA24BAED4963EE407))


@dataclass
class Words:
    row0: int  # first row of the batch this chunk covers
    n: int  # rows covered
    data: np.ndarray  # bytes of these rows
    off: np.ndarray  # row offsets into data, n + 1
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row (within the chunk) of each word
    hash: np.ndarray | None

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)


def chunks(arr: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for stretches of rows of about ``max_bytes``; NULL is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    n = len(arr)
    if n == 0:
        return
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        j = min(j, n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes not in ``sep``; rows never share a run."""
    word = ~sep[data]
    if not len(word):
        z = np.zeros(0, np.int64)
        return z, z
    edge = np.zeros(len(word) + 1, bool)
    edge[off] = True  # a row begins (or the data end) here
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def rows_of(start: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, start, side="right") - 1


def words(arr: pa.Array, lower: bool = False, hashed: bool = True, max_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    for row0, data, off in chunks(arr, max_bytes):
        s, e = spans(data, off)
        h = hash_spans(BYTES_LOWER if lower else BYTES, data, s, e) if hashed else None
        yield Words(row0, len(off) - 1, data, off, s, e, rows_of(s, off), h)


_EDGE = np.zeros(256, bool)
_EDGE[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def bare_words(arr: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """Words lower-cased (A-Z) without ASCII punctuation at either end; bare punctuation is dropped."""
    for row0, data, off in chunks(arr, max_bytes):
        s, e = spans(data, off)
        live = np.flatnonzero(e > s)
        while len(live):
            live = live[_EDGE[data[e[live] - 1]]]
            e[live] -= 1
            live = live[e[live] > s[live]]
        live = np.flatnonzero(e > s)
        while len(live):
            live = live[_EDGE[data[s[live]]]]
            s[live] += 1
            live = live[e[live] > s[live]]
        keep = e > s
        s, e = s[keep], e[keep]
        yield Words(row0, len(off) - 1, data, off, s, e, rows_of(s, off), hash_spans(BYTES_LOWER, data, s, e))


def grams(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and the index of their first word (a run stays in its row)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        g = h[:n] * _MULT[0]
        for j in range(1, k):
            g += h[j:j + n] * _MULT[j % 4096]
    ok = np.flatnonzero(doc[:n] == doc[k - 1:])
    return mix(g[ok]), ok


def sum_by_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a value per byte over each row."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[off[1:]] - c[off[:-1]]
