"""Benchmark decontamination (operator 9) by greedy string tiling.

Words are lower-cased and lose punctuation at their ends. Every run of ``min_match`` words of a
benchmark item is a seed; documents are scanned once, their rolling word-run hashes
looked up among the seeds (a bit filter first, then a sorted array). For each document and item
that share a seed, the seed hits form diagonals; consecutive hits on a diagonal are maximal
matches, and the longest unmarked match is marked again and again until none of
``min_match`` words is left (greedy string tiling with running Karp-Rabin hashes). Tiles
may come in any order, so reordered passages count. The share of the item's words that
tiles cover is its coverage; an item with coverage of at least ``threshold`` is found in the document.

The benchmark is the query set: it is cut into blocks of at most ``BLOCK_BYTES`` of text, each
block is sent to the workers, and every document is held against every block, so its size has
no limit and the documents are never shuffled.

Defined cases: items of fewer than ``min_match`` words, NULL items and NULL or empty texts match
nothing; equal rows are searched each; NULL ids are carried through; an empty table on either
side gives no match; extra columns pass through :func:`tile_matches`, whose result column
(``matches``) replaces one of that name.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from medallion.llm.common import session
from medallion.llm.words import bare_words, grams

MIN_MATCH, THRESHOLD = 5, 0.6
BLOCK_BYTES = 8 << 20
_MATCH = pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tile_words", pa.int64()),
                    ("item_words", pa.int64()), ("n_tiles", pa.int64()), ("longest", pa.int64())])
_FILTER_BITS = 22


class Seeds:
    """The word hashes of a block of items, and their seeds in hash order."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.ids = [i for i, _ in items]
        arr = pc.utf8_lower(pa.array([t for _, t in items], pa.string()))
        self.words: list[np.ndarray] = []
        seeds, owner, pos = [], [], []
        for w in bare_words(arr):
            for r in range(w.n):
                a, b = np.searchsorted(w.doc, [r, r + 1])
                self.words.append(w.hash[a:b])
            g, at = grams(w.hash, w.doc, min_match)
            first = np.searchsorted(w.doc, np.arange(w.n))
            seeds.append(g)
            owner.append(w.doc[at] + w.row0)
            pos.append(at - first[w.doc[at]])
        cat = (lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t))
        seed, owner_, pos_ = cat(seeds, np.uint64), cat(owner, np.int64), cat(pos, np.int64)
        order = np.argsort(seed, kind="stable")
        self.seed, self.owner, self.pos = seed[order], owner_[order], pos_[order]
        self.unique, self.first = np.unique(self.seed, return_index=True)
        self.stop = np.append(self.first[1:], len(self.seed)).astype(np.int64)

    def bits(self) -> np.ndarray:
        """Bit filter over the seeds (made on the worker, not sent)."""
        if not hasattr(self, "_bits"):
            self._bits = np.zeros(1 << _FILTER_BITS, bool)
            self._bits[(self.unique >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return self._bits

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_bits"}

    def hits(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``g`` that hold a seed, and the seed's number."""
        maybe = np.flatnonzero(self.bits()[(g >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = np.searchsorted(self.unique, g[maybe])
        ok = at < len(self.unique)
        ok[ok] = self.unique[at[ok]] == g[maybe][ok]
        return maybe[ok], at[ok]


def tile(i: np.ndarray, j: np.ndarray, m: int, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seed hits: item positions ``i``, document positions ``j`` of equal runs of
    ``min_match`` words; ``m`` words in the item. Tiles as (length, item position, document position),
    longest first, ties by item then document position."""
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    cut = np.flatnonzero((np.diff(j - i) != 0) | (np.diff(i) != 1)) + 1
    begin = np.concatenate(([0], cut))
    length = np.diff(np.append(begin, len(i))) + min_match - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(length, i[begin], j[begin], strict=True)]
    heapq.heapify(heap)
    item_used = np.zeros(m, bool)
    doc_used: set[int] = set()
    tiles = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [not item_used[a + k] and (b + k) not in doc_used for k in range(n)]
        if all(free):
            tiles.append((n, a, b))
            item_used[a:a + n] = True
            doc_used.update(range(b, b + n))
            if item_used.all():
                break
            continue
        k = 0
        while k < n:  # what is left of this match goes back, if long enough
            if not free[k]:
                k += 1
                continue
            e = k
            while e < n and free[e]:
                e += 1
            if e - k >= min_match:
                heapq.heappush(heap, (k - e, a + k, b + k))
            k = e
    return tiles


def _search(texts: pa.Array, seeds: Seeds, min_match: int, threshold: float) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    if not len(seeds.unique):
        return out
    for w in bare_words(pc.utf8_lower(texts)):
        g, at = grams(w.hash, w.doc, min_match)
        hit, which = seeds.hits(g)
        if not len(hit):
            continue
        pos = at[hit]
        doc = w.doc[pos]
        first = np.searchsorted(w.doc, np.arange(w.n))
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(doc)), strict=True):
            d = int(doc[lo])
            j = pos[lo:hi] - first[d]
            k = which[lo:hi]
            reps = seeds.stop[k] - seeds.first[k]
            # every (document position, seed place) of this document
            slot = np.repeat(seeds.first[k] - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
            item, i, jj = seeds.owner[slot], seeds.pos[slot], np.repeat(j, reps)
            order = np.argsort(item, kind="stable")
            item, i, jj = item[order], i[order], jj[order]
            b = np.flatnonzero(np.diff(item)) + 1
            for x, y in zip(np.append(0, b), np.append(b, len(item)), strict=True):
                n = int(item[x])
                m = len(seeds.words[n])
                covered = np.zeros(m + 1, np.int64)
                u = np.unique(i[x:y])
                covered[u] += 1
                np.subtract.at(covered, u + min_match, 1)
                if (np.cumsum(covered)[:-1] > 0).sum() < threshold * m:
                    continue  # even all seeds together cover too little
                tiles = tile(i[x:y], jj[x:y], m, min_match)
                words = sum(t[0] for t in tiles)
                if words >= threshold * m:
                    out[w.row0 + d].append({"item_id": seeds.ids[n], "coverage": words / m, "tile_words": words,
                                            "item_words": m, "n_tiles": len(tiles), "longest": tiles[0][0]})
    return out


def _udf(held, min_match: int, threshold: float):
    @arrow_udf(from_arrow_type(pa.list_(_MATCH)))
    def found(text: pa.Array) -> pa.Array:
        return pa.array(_search(text, held.value, min_match, threshold), pa.list_(_MATCH))
    return found


def tile_matches(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                 block_bytes: int = BLOCK_BYTES, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``docs`` with ``matches``: the benchmark items found in each text."""
    spark = session(docs)
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).filter("t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // max(1, block_bytes // 2)))  # half: hashes are not dealt out evenly
    parts = []
    for k in range(blocks):
        block = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast(Seeds(sorted(((r.i, r.t) for r in block.collect()),
                                                         key=lambda x: (x[0] is not None, x[0] or 0, x[1])), min_match))
        parts.append(_udf(held, min_match, threshold)(F.col(text_col)))
    matches = F.concat(*parts) if len(parts) > 1 else parts[0]
    return docs.select(*(docs[c] for c in docs.columns if c != "matches"), matches.alias("matches"))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document and benchmark item found in it."""
    m = tile_matches(docs.select(F.col(id_col).alias("doc_id"), F.col(options.get("text_col", "text")).alias("text")),
                     benchmark, **{k: v for k, v in options.items() if k != "text_col"})
    return m.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
