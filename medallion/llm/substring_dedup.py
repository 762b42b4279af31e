"""Substring dedup (operator 5) by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. The window's minimiser is the smallest hash among
its runs of ``MINIMISER`` words, a function of the window's words alone. Consecutive windows with
the same minimiser (also where it recurs, as in a text of one word) travel as one packed string (a super-k-mer) to
the minimiser's bucket, so every occurrence of a window meets in one bucket while a word
travels about three times, not ``window`` times. A map task packs equal strings once, with the places
they come from; strings are compressed.

In a bucket, words become exact local numbers, windows are sorted by a rolling hash of these, and
neighbours of equal hash are compared word by word; a window whose words start at two places or more is marked.
Marked windows return as word ranges, which are joined to their documents; the words they cover are
removed, all at once.

Defined cases: a NULL text has no words and stays NULL, others become their kept words joined by one
space (an empty text if none is left); texts shorter than a window are kept whole; equal rows are
documents of their own, so all their windows repeat; NULL ids are allowed; extra columns pass through, and
``n_words`` and ``n_removed`` replace input columns of these names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StringType, StructType

from medallion.llm.common import bucket_count, cut, session, slots, text_key
from medallion.llm.words import SPACE, U, Words, grams, mix, words

WINDOW, MINIMISER = 35, 5
FLUSH_BYTES = 8 << 20  # text that a map task holds before it packs it
BUCKET_BYTES = 2 << 20  # input per bucket; a partition works through its buckets one by one
_PACK = "slot long, bucket int, blob binary"
_RANGES = "id long, tk long, a int, b int"


def _sliding_min(c: np.ndarray, w: int) -> np.ndarray:
    size, cur = 1, c
    while size * 2 <= w:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    n = len(c) - w + 1
    return np.minimum(cur[:n], cur[w - size:w - size + n])


def super_kmers(w: Words, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word + 1, minimiser hash) of every super-k-mer of a chunk."""
    n = len(w.hash) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, np.zeros(0, U)
    g = np.zeros(len(w.hash) - m + 1, U)
    h, at = grams(w.hash, w.doc, m)
    g[at] = h  # runs across rows stay 0 and are in no window of one row
    least = _sliding_min(g, window - m + 1)
    inside = w.doc[:n] == w.doc[window - 1:]
    head = inside.copy()
    head[1:] &= (least[1:] != least[:-1]) | ~inside[:-1] | (w.doc[1:n] != w.doc[:n - 1])
    first = np.flatnonzero(head)
    stop = np.append(first[1:], n)
    # the run ends where windows leave the row
    last_in = np.flatnonzero(inside)
    stop = last_in[np.searchsorted(last_in, stop) - 1] + 1 if len(first) else stop
    return first, stop + window - 1, mix(least[first] + U(1))  # mixed: least hashes crowd at the low end


def _pack_strings(strings: list[bytes], n_words: list[int], places: list[list[tuple]]) -> bytes:
    flat = [p for ps in places for p in ps]
    arrays = [np.array(n_words, np.int32), np.array([len(p) for p in places], np.int32),
              np.array([p[0] or 0 for p in flat], np.int64), np.array([p[0] is None for p in flat], np.int8),
              np.array([p[1] for p in flat], np.int64), np.array([p[2] for p in flat], np.int32)]
    head = np.array([len(strings), len(flat)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays) + b"\n".join(strings))


def _unpack_strings(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    s, p = np.frombuffer(raw, np.int64, 2)
    at, out = 16, []
    for n, kind in ((s, np.int32), (s, np.int32), (p, np.int64), (p, np.int8), (p, np.int64), (p, np.int32)):
        out.append(np.frombuffer(raw, kind, int(n), at))
        at += int(n) * np.dtype(kind).itemsize
    return (*out, raw[at:])


def _scatter(window: int, m: int, n_buckets: int, slot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[bytes, list]] = {}
        size = 0

        def flush():
            made, total = [], 0
            for b in sorted(held):
                strings = list(held[b])
                packed = list(held[b].values())
                blob = _pack_strings(strings, [v[0] for v in packed], [v[1:] for v in packed])
                made.append((b, blob))
                total += len(blob)
                if total > 8 << 20:
                    yield made
                    made, total = [], 0
            if made:
                yield made

        def batch_of(made):
            return pa.RecordBatch.from_arrays(
                [pa.array([int(slot[b]) for b, _ in made], pa.int64()), pa.array([b for b, _ in made], pa.int32()),
                 pa.array([x for _, x in made], pa.binary())], names=["slot", "bucket", "blob"])

        for batch in batches:
            ids, tks = batch.column("id").to_pylist(), batch.column("tk").to_pylist()
            for w in words(batch.column("text")):
                first, stop, mini = super_kmers(w, window, m)
                if len(first):
                    text = np.where(SPACE[w.data], np.uint8(32), w.data).tobytes()
                    base = np.searchsorted(w.doc, np.arange(w.n))
                    row = w.doc[first]
                    bucket = (((mini >> U(48)) * U(n_buckets)) >> U(16)).tolist()
                    for b, r, lo, hi, x, n in zip(bucket, (row + w.row0).tolist(), w.start[first].tolist(),
                                                  w.end[stop - 1].tolist(), (first - base[row]).tolist(),
                                                  (stop - first).tolist(), strict=True):
                        held.setdefault(b, {}).setdefault(text[lo:hi], [n]).append((ids[r], tks[r], x))
                size += len(w.data)
                if size >= FLUSH_BYTES:
                    for made in flush():
                        yield batch_of(made)
                    held, size = {}, 0
        for made in flush():
            yield batch_of(made)
    return run


class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


_POLY = 0x9E3779B97F4A7C15


def repeated_windows(word: np.ndarray, n_words: np.ndarray, copies: np.ndarray, window: int) -> np.ndarray:
    """Marks, per word place, the windows whose words start at two places or more.
    ``word``: word numbers of all strings; ``copies``: places each string came from."""
    total = len(word)
    marked = np.zeros(total, bool)
    ends = np.cumsum(n_words)
    begins = ends - n_words
    valid = np.ones(total, bool)
    for k in range(1, window):  # the last window - 1 words of a string begin no window
        valid[ends - k] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return marked
    with np.errstate(over="ignore"):
        part = mix(word.astype(U) + U(1))
        h = np.zeros(total - window + 1, U)  # sum of part[i + j] * base^j, by doubling
        size, pos = 1, 0
        need = window
        while need:
            if need & 1:
                n = total - window + 1
                h += part[pos:pos + n] * U(pow(_POLY, pos, 1 << 64))
                pos += size
            need >>= 1
            if need:
                longer = part[size:] * U(pow(_POLY, size, 1 << 64))
                longer += part[:-size]
                part, size = longer, size * 2
        del part
        h = h[at]
    string = np.searchsorted(begins, at, side="right") - 1
    order = np.argsort(h, kind="stable")
    hs = h[order]
    same = hs[1:] == hs[:-1]
    # equal hashes are compared word by word with the place before them
    left, right = at[order[:-1][same]], at[order[1:][same]]
    equal = np.ones(len(left), bool)
    for j in range(window):
        equal &= word[left + j] == word[right + j]
    if not equal.all():
        return _exact(word, at, copies[string], window, order, hs)
    many = np.zeros(len(at), bool)
    pairs = np.flatnonzero(same)
    many[order[pairs]] = True
    many[order[pairs + 1]] = True
    many |= copies[string] > 1
    marked[at[many]] = True
    return marked


def _exact(word, at, copies, window, order, hs) -> np.ndarray:
    """The same marks where different windows share a hash: groups of equal hash by their words."""
    marked = np.zeros(len(word), bool)
    marked[at[copies > 1]] = True
    for group in np.split(order, np.flatnonzero(hs[1:] != hs[:-1]) + 1):
        if len(group) > 1:
            by: dict[bytes, list] = {}
            for g in group:
                by.setdefault(word[at[g]:at[g] + window].tobytes(), []).append(at[g])
            for places in by.values():
                if len(places) > 1:
                    marked[places] = True
    return marked


def _count(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
                found.setdefault(b, []).append(blob.as_py())
        while found:
            _, blobs = found.popitem()
            numbers = _Numbers()
            word, cols = [], []
            while blobs:
                *arrays, text = _unpack_strings(blobs.pop())
                w = text.split()
                word.append(np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)))
                cols.append(arrays)
            del numbers
            n_words, copies, ids, null, tks, start = (np.concatenate(c) for c in zip(*cols, strict=True))
            del cols
            word = np.concatenate(word)
            mark = repeated_windows(word, n_words.astype(np.int64), copies, window)
            if not mark.any():
                continue
            begins = np.cumsum(n_words) - n_words
            string = np.repeat(np.arange(len(n_words)), n_words)
            edge = mark.copy()
            edge[1:] &= ~mark[:-1] | (string[1:] != string[:-1])
            last = mark.copy()
            last[:-1] &= ~mark[1:] | (string[1:] != string[:-1])
            a, b = np.flatnonzero(edge), np.flatnonzero(last)
            s = string[a]
            a, b = a - begins[s], b - begins[s] + window
            # every place of the string loses the range
            reps = copies[s].astype(np.int64)
            first = np.cumsum(copies) - copies
            at = np.repeat(first[s], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            a, b = np.repeat(a, reps) + start[at], np.repeat(b, reps) + start[at]
            for lo in range(0, len(at), 50_000):
                x = slice(lo, lo + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at[x]], mask=null[at[x]].astype(bool)), pa.array(tks[at[x]]),
                     pa.array(a[x].astype(np.int32)), pa.array(b[x].astype(np.int32))], names=["id", "tk", "a", "b"])
    return run


def repeated_ranges(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, tk, a, b): word ranges that repeated windows cover, by document id and text key."""
    spark = session(docs)
    parts = bucket_count(docs)
    n = max(parts, bucket_count(docs, BUCKET_BYTES))
    slot = slots(spark, parts)[np.arange(n) % parts]
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"), F.col(text_col).alias("text"))
    return (src.mapInArrow(_scatter(window, min(minimiser, window), n, slot), _PACK).repartition(parts, "slot")
            .mapInArrow(_count(window), _RANGES))


_KEPT = StructType().add("text", StringType()).add("n_words", LongType()).add("n_removed", LongType())


@arrow_udf(_KEPT)
def _remove(text: pa.Array, ranges: pa.Array) -> pa.Array:
    out, n_words, n_removed = [], [], []
    for t, rs in zip(text.cast(pa.binary()).to_pylist(), ranges.to_pylist(), strict=True):
        w = (t or b"").split()
        n_words.append(len(w))
        if rs:
            keep = np.ones(len(w), bool)
            for r in rs:
                keep[r["a"]:r["b"]] = False
            kept = [w[i] for i in np.flatnonzero(keep)]
        else:
            kept = w
        n_removed.append(len(w) - len(kept))
        out.append(None if t is None else b" ".join(kept))
    return pa.StructArray.from_arrays([pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
                                       pa.array(n_removed, pa.int64())], names=["text", "n_words", "n_removed"])


def substring_dedup(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` with the kept words as text, plus ``n_words`` (before) and ``n_removed``."""
    found = cut(repeated_ranges(docs, window, minimiser, id_col, text_col), "ranges")
    found = (found.groupBy(F.col("id").alias("__ss_id"), F.col("tk").alias("__ss_tk"))
             .agg(F.collect_set(F.struct("a", "b")).alias("__ss_r")))
    joined = docs.join(found, docs[id_col].cast("long").eqNullSafe(F.col("__ss_id"))
                       & (text_key(text_col) == F.col("__ss_tk")), "left")
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    joined = joined.select(*(docs[c] for c in names), _remove(F.col(text_col), F.col("__ss_r")).alias("__ss_k"))
    return joined.select(*(F.col("__ss_k.text").alias(c) if c == text_col else F.col(c) for c in names),
                         F.col("__ss_k.n_words").alias("n_words"), F.col("__ss_k.n_removed").alias("n_removed"))
