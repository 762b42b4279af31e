"""Phrase collocations by top-order marginalisation (operator 12).

A phrase is 2 to 5 words that stand in one piece of a text (pieces end at ``[.,;:!?]`` and line breaks).

1. *Words.* Counted per language, with a map-side combine; their sums are ``n``.
2. *Windows.* At each word starts one window: that word and the up to four that follow in its piece, as
   lead columns w0..w4, padded with 0. Only these longest windows are counted, once. A window is
   cut short (padded) at a word under the least count, or where the next word pair is under it: no
   phrase across such a place can reach the least count.
3. *Marginals.* ``ROLLUP(w0..w4)`` over the counted windows sums every shorter prefix: the row at
   depth k whose k-th column is no padding is f(phrase of k words), since each occurrence of a
   phrase is the beginning of exactly one window. No n-gram is exploded by itself.
4. *Scores.* Each candidate's cuts are joined to the marginals; products are taken as decimals of 38
   digits, which they never exceed (a, n under 10^17).
5. *Containment, rank.* A longer candidate's parts carry its count; the best per language is
   ranked within hashed buckets first, so no task sorts all candidates of a language.

Words are counted as (language, 64-bit hash, text), and the frequent ones get dense numbers. These numbers and
the frequent pairs go to the workers as sorted arrays of 8 bytes an entry while they
have at most :data:`MOST_SHARED` entries (64 MB; the counts are checked before anything is collected, and the
driver reads them packed, a piece at a time). Beyond that the windows aren't cut at rare pairs, or carry the
hashes themselves and aren't cut at rare words either: the result is the same and the shuffle larger. Two words
found under one 63-bit hash are told by the count step, which then starts again with other hashes.

Defined cases: NULL text has no words, NULL lang is ``und``, repeated rows count each; texts of
any length are used whole (in stretches of whole texts); ties in score go to the larger
count, then the phrase in byte order; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from medallion.llm import words as wd
from medallion.llm.common import cut, lean, session

LONGEST = 5
MOST_SHARED = 1 << 23
RANK_BUCKETS = 64
HELD = 1 << 20  # counted keys a worker holds before it hands them on
PIECE = 1 << 20  # shared entries the driver reads at once, about

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_SEP = _BREAK.copy()
_SEP[[0x20, 9]] = True
_LANG = np.uint64(0x9FB21C651E98DF25)


def _table(seed: int) -> np.ndarray:
    return wd.mix(wd.BYTES_LOWER + np.uint64(seed) * _LANG) if seed else wd.BYTES_LOWER


def _lang_hashes(langs: list[str], seed: int) -> np.ndarray:
    """64-bit hash per language name, by the same polynomial as words."""
    names = [x.encode("utf-8", "surrogatepass") for x in langs]
    data = np.frombuffer(b"".join(names), np.uint8)
    ends = np.cumsum([len(x) for x in names]).astype(np.int64)
    starts = ends - np.array([len(x) for x in names], np.int64)
    return wd.hash_spans(wd.mix(wd.BYTES + np.uint64(seed + 1) * _LANG), data, starts, ends)


def _stretches(batch: pa.RecordBatch, seed: int) -> Iterator[tuple]:
    """(bytes, starts, ends, piece, key, row of the batch) of the words of some whole texts. ``key`` is a positive hash of
    language and word; words of one piece share a number in ``piece``."""
    langs = batch.column("lang").to_pylist()
    number = {x: i for i, x in enumerate(dict.fromkeys(langs))}
    by_lang = _lang_hashes(list(number), seed)[[number[x] for x in langs]] if langs else np.zeros(0, np.uint64)
    table = _table(seed)
    for row0, data, off in wd.chunks(batch.column("text")):
        s, e = wd.spans(data, off, _SEP)
        if not len(s):
            continue
        row = wd.rows_of(s, off)
        breaks = np.cumsum(_BREAK[data])
        piece = breaks[s] + row  # a break or a new row raises it
        with np.errstate(over="ignore"):
            key = wd.mix(wd.hash_spans(table, data, s, e) ^ (by_lang[row0 + row] * np.uint64(0x9E3779B97F4A7C15)))
        yield data, s, e, piece, np.maximum((key >> np.uint64(1)).view(np.int64), 1), row0 + row


_WORDS = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("word", pa.string()), ("n", pa.int64())])


def _count_words(seed: int):
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").to_pylist()
            for data, s, e, _, key, row in _stretches(b, seed):
                keys, first, n = np.unique(key, return_index=True, return_counts=True)
                text = lower[data].tobytes()
                found = [text[i:j].decode("utf-8", "surrogatepass") for i, j in zip(s[first].tolist(), e[first].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[r] for r in row[first].tolist()], pa.string()), pa.array(keys),
                     pa.array(found, pa.string()), pa.array(n.astype(np.int64))], schema=_WORDS)
    return lean(run)


def _numbers(key: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """Number from 1 of each word, 0 for a rare one; the hash itself where none are shared."""
    if known is None:
        return key
    if not len(known):
        return np.zeros(len(key), np.int64)
    at = np.searchsorted(known, key)
    at[at == len(known)] = 0
    return np.where(known[at] == key, at + 1, 0)


def _pairs(number: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair (first number, second number) as one long, and whether both are frequent and in one piece."""
    ok = (piece[1:] == piece[:-1]) & (number[1:] > 0) & (number[:-1] > 0)
    return (number[:-1] << 32) | number[1:], ok


def _count_pairs(seed: int, known):
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], schema=schema)

        for b in batches:
            for _, _, _, piece, key, _ in _stretches(b, seed):
                pair, ok = _pairs(_numbers(key, known.value), piece)
                held.append(pair[ok])
                if sum(map(len, held)) > HELD:
                    yield counted()
        if held:
            yield counted()
    return lean(run)


_WINDOWS = pa.schema([*((f"w{i}", pa.int64()) for i in range(LONGEST)), ("n", pa.int64())])


def _windows(seed: int, known, pairs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value if known else None
        frequent = pairs.value if pairs else None
        for b in batches:
            for _, _, _, piece, key, _ in _stretches(b, seed):
                number = _numbers(key, numbers)
                if numbers is None:
                    goes = piece[1:] == piece[:-1]
                else:
                    pair, goes = _pairs(number, piece)
                    if frequent is not None:
                        at = np.flatnonzero(goes)
                        goes = np.zeros(len(pair), bool)
                        if len(frequent):
                            spot = np.searchsorted(frequent, pair[at])
                            spot[spot == len(frequent)] = 0
                            goes[at] = frequent[spot] == pair[at]
                goes = np.append(goes, np.zeros(LONGEST, bool))  # goes[i]: the window runs on from word i to the next
                alone = number[(number > 0) & ~goes[:len(number)]]
                one, n = np.unique(alone, return_counts=True)
                zero = np.zeros(len(one), np.int64)
                cols = [one, *([zero] * (LONGEST - 1)), n.astype(np.int64)]
                start = np.flatnonzero(goes[:len(number)])
                lead, run_on = [number[start]], np.ones(len(start), bool)
                padded = np.append(number, np.zeros(LONGEST, np.int64))
                for i in range(1, LONGEST):
                    run_on = run_on & goes[start + i - 1]
                    lead.append(np.where(run_on, padded[start + i], 0))
                lead.append(np.ones(len(start), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x, y])) for x, y in zip(cols, lead)], schema=_WINDOWS)
    return lean(run)


_PACKED = pa.schema([("packed", pa.binary())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The one column of longs as the bytes of each batch."""
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(0).to_numpy().astype(np.int64).tobytes()], pa.binary())], schema=_PACKED)


def _shared(df: DataFrame, column: str, size: int):
    """A sorted column of a table of ``size`` rows for the workers; None beyond :data:`MOST_SHARED`. The driver holds
    the array, 8 bytes an entry, and one piece of the packed column at a time, never rows."""
    if size > MOST_SHARED:
        return None
    got, at = np.empty(size, np.int64), 0
    if size:
        packed = cut(df.select(column).mapInArrow(lean(_packed), "packed binary"), "phrase-packed")
        for row in packed.coalesce(-(-size // PIECE)).toLocalIterator():
            part = np.frombuffer(row.packed, np.int64)
            got[at:at + len(part)] = part
            at += len(part)
    if at != size:
        raise RuntimeError(f"{at} of {size} entries of {column} were read")
    got.sort()
    return df.sparkSession.sparkContext.broadcast(got)


def _vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """Counts per (lang, key, word), and the seed of hashes under which no two words share one."""
    for seed in range(64):
        counts = (texts.mapInArrow(_count_words(seed), "lang string, key bigint, word string, n bigint")
                  .groupBy("lang", "key", "word").agg(F.sum("n").alias("n")))
        counts = cut(counts, "phrase-words")
        twice = (counts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
        if twice.isEmpty():
            return counts, seed
    raise RuntimeError("no collision-free hash of the words was found")


def phrase_counts(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases, words, totals)``: f(phrase) >= ``least`` for phrases of 1 to 5 words as arrays of word
    numbers; the words of these numbers, with lang; n per lang."""
    counts, seed = _vocabulary(texts)
    totals = counts.groupBy("lang").agg(F.sum("n").cast("long").alias("n_words"))
    frequent = counts.filter(F.col("n") >= least)
    size = frequent.count()
    known = _shared(frequent, "key", size)
    if known is not None:
        number = frequent.mapInArrow(_numbered(known), "lang string, word string, number bigint")
        pair_counts = cut(texts.mapInArrow(_count_pairs(seed, known), "pair bigint, n bigint").groupBy("pair")
                          .agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-pairs") if size else None
        pairs = _shared(pair_counts, "pair", pair_counts.count()) if pair_counts is not None else None
    else:
        number = frequent.select("lang", "word", F.col("key").alias("number"))
        pairs = None
    lead = [f"w{i}" for i in range(LONGEST)]
    schema = ", ".join(f"{c} bigint" for c in (*lead, "n"))
    windows = texts.mapInArrow(_windows(seed, known, pairs), schema).groupBy(*lead).agg(F.sum("n").alias("n"))
    # depth: how many of w0..w4 the ROLLUP row still has; grouping_id has a bit per summed-out column
    depth = F.lit(LONGEST) - F.bit_count(F.grouping_id())
    rolled = (windows.rollup(*lead).agg(F.sum("n").alias("a"), depth.alias("depth"))
              .filter((F.col("a") >= least) & (F.col("depth") > 0)))
    key = F.slice(F.array(*lead), 1, F.col("depth"))
    phrases = (rolled.select(key.alias("phrase"), F.col("a").cast("long").alias("a"))
               .filter(~F.array_contains("phrase", F.lit(0).cast("long"))))
    return cut(phrases, "phrases"), number, totals


def _numbered(known):
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("number", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("key").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("word"),
                                              pa.array(_numbers(key, known.value).astype(np.int64))], schema=schema)
    return run


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` collocations per language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has text and lang. ``least`` is the least count of a phrase. Candidates whose words lie in a longer
    candidate at least as frequent are left out; of a candidate's cuts the one with the lowest score counts."""
    session(docs)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    phrases, number, totals = phrase_counts(texts, least)
    long = F.size("phrase")
    candidates = phrases.filter(long >= 2)
    cuts = candidates.select("phrase", "a", F.explode(F.sequence(F.lit(1), long - 1)).alias("k"))
    cuts = cuts.select("phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("left"),
                       F.slice("phrase", F.col("k") + 1, long - F.col("k")).alias("right"))
    cuts = (cuts.join(phrases.select(F.col("phrase").alias("left"), F.col("a").alias("l")), "left")
            .join(phrases.select(F.col("phrase").alias("right"), F.col("a").alias("r")), "right"))
    # the longer candidates' parts, each with the largest count of a candidate around it
    inner = (candidates.filter(long >= 3)
             .select("a", "phrase", F.explode(F.sequence(F.lit(2), long - 1)).alias("m"))
             .select("a", F.col("phrase").alias("whole"), "m",
                     F.explode(F.sequence(F.lit(1), long - F.col("m") + 1)).alias("i"))
             .select(F.slice("whole", F.col("i"), F.col("m")).alias("phrase"), "a")
             .groupBy("phrase").agg(F.max("a").alias("around")))
    first = number.select(F.col("number").alias("__first"), F.col("lang"))
    scored = (cuts.withColumn("__first", F.col("phrase")[0]).join(first, "__first").join(totals, "lang")
              .withColumn("__above", _wide("a") * _wide("n_words") * F.lit(1000).cast("decimal(4,0)"))
              .withColumn("__below", _wide("l") * _wide("r"))
              .withColumn("score", F.expr("__above div __below"))
              .groupBy("lang", "phrase", "a", F.col("n_words").alias("n"))
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    scored = scored.join(inner, "phrase", "left").filter(F.col("around").isNull() | (F.col("around") < F.col("a")))
    scored = cut(scored.select("lang", "phrase", "a", "n", "best.score", "best.l", "best.r"), "phrase-scores")
    spelt = (scored.select("phrase", F.posexplode("phrase").alias("i", "number"))
             .join(number.select("number", "word"), "number")
             .groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))),
                                                             lambda x: x["word"]), " ").alias("text")))
    named = scored.join(spelt, "phrase").select("lang", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS))
    near = (named.withColumn("__b", bucket)
            .withColumn("__r", F.row_number().over(W.partitionBy("lang", "__b").orderBy(*order)))
            .filter(F.col("__r") <= top))
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
