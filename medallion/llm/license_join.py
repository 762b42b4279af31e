"""License scans by an exact set-similarity join (operator 11).

*Words* are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. *Templates* are notices,
each with a label. *Text blocks* are windows of ``2 * m`` words that start at every m-th word of a whole text, m being the
longest template's number of words (32 at least): any stretch of m words lies whole in a block, whatever
lines it is broken into. A block holds a template when it has at least ``threshold`` percent of the template's
distinct words (containment).

*Join.* Sets are ordered by one order of the tokens for all: the number of blocks they occur in,
over the whole corpus, the rarest first. A template of t tokens needs an overlap of
``need = ceil(threshold * t)``, so a match has a common token

* among the template's first ``t - need + 1`` tokens and the block's first ``b - need + 1`` (prefix filter),
* where ``b >= need`` (length filter),
* where the common tokens before it and what is left from it on, on the shorter side, reach ``need``
  (positional filter).

Blocks' prefix tokens are exploded and joined to the templates' prefix tokens; what passes is verified on the
whole sets. No match is lost, so the result is that of comparing all blocks with all templates. Tokens in no template never
count towards an overlap, so a block's set is cut to the templates' words first, which makes the length filter sharper.

The templates' words are known before the run (at most :data:`MOST_WORDS`), so the table of their order and the
index of their prefixes have a fixed bound; nothing else is broadcast or collected.

*Base phrases* are found word by word, apart from the join; each word read as a template word is compared by bytes.

Defined cases: NULL and empty texts have no words, no labels and a score of 0; equal rows get equal results;
rows with NULL ids count like others; a text of any length is used whole (one text is held by one task); a template of equal containment in several
blocks counts once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm import words as wd
from medallion.llm.common import cut, lean, session, text_key

MOST_WORDS = 20_000
LEAST_STEP = 32

_SEP = np.ones(256, bool)
_SEP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

# Phrases whose places are counted, with their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices of public licenses, as usually printed.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def split_words(text: str) -> list[str]:
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    s, e = wd.spans(data, np.array([0, len(data)]), _SEP)
    return [text.encode("utf-8")[i:j].lower().decode("utf-8") for i, j in zip(s.tolist(), e.tolist())]


@dataclass(frozen=True)
class Catalogue:
    """Base phrases and templates as numbers into one list of words."""

    words: tuple[str, ...]
    phrases: tuple[tuple[tuple[int, ...], str], ...]
    templates: tuple[tuple[str, tuple[int, ...], int], ...]  # label, distinct word numbers, overlap needed
    step: int

    @classmethod
    def of(cls, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]], threshold: int) -> Catalogue:
        split = [(split_words(t), label) for t, label in phrases]
        sets = [(label, split_words(t)) for label, t in templates]
        number: dict[str, int] = {}
        for w in [w for ws, _ in split for w in ws] + [w for _, ws in sets for w in ws]:
            number.setdefault(w, len(number))
        if len(number) > MOST_WORDS:
            raise ValueError(f"the templates have {len(number)} distinct words, more than {MOST_WORDS}")
        found = []
        for label, ws in sets:
            ids = tuple(dict.fromkeys(number[w] for w in ws))
            if ids:
                found.append((label, ids, max(1, -(-threshold * len(ids) // 100))))
        step = max([LEAST_STEP] + [len(ws) for _, ws in sets])
        return cls(tuple(number), tuple((tuple(number[w] for w in ws), label) for ws, label in split if ws),
                   tuple(found), step)

    @property
    def least(self) -> int:
        """The smallest overlap that any template asks for."""
        return min((need for _, _, need in self.templates), default=1 << 30)


_FIELDS = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_bits bigint, blocks array<array<int>>"


def _scan(cat: Catalogue, id_type: pa.DataType):
    """Per text: number of words, places of the base phrases, and the blocks' template words."""
    spelt = [w.encode("utf-8") for w in cat.words]
    data0 = np.frombuffer(b"".join(spelt), np.uint8)
    ends0 = np.cumsum([len(w) for w in spelt]).astype(np.int64)
    hashes = wd.hash_spans(wd.BYTES_LOWER, data0, ends0 - np.array([len(w) for w in spelt], np.int64), ends0)
    order = np.argsort(hashes)
    sorted_hashes = hashes[order]
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32

    def numbers(w: tuple) -> np.ndarray:
        """Number of each template word of the stretch, -1 for others; compared by bytes."""
        data, s, e = w
        h = wd.hash_spans(wd.BYTES_LOWER, data, s, e)
        at = np.searchsorted(sorted_hashes, h)
        at[at == len(sorted_hashes)] = 0
        out = np.where(sorted_hashes[at] == h, order[at], -1)
        hit = np.flatnonzero(out >= 0)
        for k in np.unique(out[hit]).tolist():
            mine = hit[out[hit] == k]
            word = np.frombuffer(spelt[k], np.uint8)
            same = (e[mine] - s[mine]) == len(word)
            ok = mine[same]
            same[same] = (lower[data[s[ok][:, None] + np.arange(len(word))]] == word).all(axis=1)
            out[mine[~same]] = -1
        return out

    schema = pa.schema([("doc_id", id_type), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                        ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_bits", pa.int64()),
                        ("blocks", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for row0, data, off in wd.chunks(b.column("text")):
                n = len(off) - 1
                s, e = wd.spans(data, off, _SEP)
                doc = wd.rows_of(s, off)
                n_words = np.bincount(doc, minlength=n)
                begin = np.concatenate([[0], np.cumsum(n_words)])  # first word of each text
                num = numbers((data, s, e)) if len(s) else np.zeros(0, np.int64)
                n_base, bits = np.zeros(n, np.int64), np.zeros(n, np.int64)
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
                for p, (phrase, _) in enumerate(cat.phrases):
                    at = np.flatnonzero(num == phrase[0])
                    at = at[at + len(phrase) <= len(num)]
                    at = at[doc[at] == doc[at + len(phrase) - 1]]
                    for i, w in enumerate(phrase[1:], 1):
                        at = at[num[at + i] == w]
                    n_base += np.bincount(doc[at], minlength=n)
                    bits[np.unique(doc[at])] |= 1 << p
                    np.minimum.at(first, doc[at], at - begin[doc[at]])
                    np.maximum.at(last, doc[at], at - begin[doc[at]])
                # a word lies in the block that starts at or before it and in the one before that
                hit = np.flatnonzero(num >= 0)
                place = (hit - begin[doc[hit]]) // cat.step
                d, blk, tok = np.tile(doc[hit], 2), np.concatenate([place, place - 1]), np.tile(num[hit], 2)
                ok = blk >= 0
                d, blk, tok = d[ok], blk[ok], tok[ok]
                srt = np.lexsort((tok, blk, d))
                d, blk, tok = d[srt], blk[srt], tok[srt]
                new = np.ones(len(d), bool)
                new[1:] = (d[1:] != d[:-1]) | (blk[1:] != blk[:-1])
                uniq = new.copy()
                uniq[1:] |= tok[1:] != tok[:-1]
                d, tok, new = d[uniq], tok[uniq], new[uniq]
                starts = np.flatnonzero(new)
                size = np.diff(np.append(starts, len(d)))
                keep = size >= cat.least  # the length filter, for the template that asks least
                inner = np.concatenate([[0], np.cumsum(size[keep])])
                toks = tok[np.repeat(keep, size)]
                outer = np.concatenate([[0], np.cumsum(np.bincount(d[starts[keep]], minlength=n))])
                blocks = pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pa.ListArray.from_arrays(
                    pa.array(inner, pa.int32()), pa.array(toks, pa.int32())))
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(row0, n), b.column("text_key").slice(row0, n), pa.array(n_words.astype(np.int64)),
                     pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none), pa.array(bits), blocks],
                    schema=schema)
                done = row0 + n
            assert done == b.num_rows
    return lean(run)


def _matches(rows: DataFrame, cat: Catalogue) -> DataFrame:
    """(doc_id, text_key, label, score) of every block that holds a template."""
    spark = rows.sparkSession
    blocks = rows.select("doc_id", "text_key", F.explode("blocks").alias("tokens"))
    counted = {r[0]: r[1] for r in blocks.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)))
               .collect()}  # at most one row per template word
    by_rarity = sorted(range(len(cat.words)), key=lambda t: (counted.get(t, 0), t))
    rank = {t: r for r, t in enumerate(by_rarity)}
    ranks = F.array(*[F.lit(rank[t]) for t in range(len(cat.words))])
    index, whole = [], []
    for k, (label, tokens, need) in enumerate(cat.templates):
        ordered = sorted(rank[t] for t in tokens)
        whole.append((k, label, need, ordered))
        index += [(ordered[j], k, j, len(ordered), need) for j in range(len(ordered) - need + 1)]
    prefixes = spark.createDataFrame(index, "rank int, template int, j int, t int, need int")
    templates = spark.createDataFrame(whole, "template int, label string, need int, tokens array<int>")
    ordered = blocks.select("doc_id", "text_key", F.array_sort(F.transform("tokens", lambda x: F.get(ranks, x))).alias("block"))
    b = F.size("block")
    probe = ordered.select("doc_id", "text_key", "block", b.alias("b"),
                           F.posexplode(F.slice("block", F.lit(1), b - cat.least + 1)).alias("i", "rank"))
    found = (probe.join(F.broadcast(prefixes), "rank")  # at most one row per template word and template
             .filter((F.col("b") >= F.col("need")) & (F.col("i") <= F.col("b") - F.col("need")))
             .join(F.broadcast(templates.drop("need")), "template"))
    before = F.size(F.array_intersect(F.slice("block", F.lit(1), F.col("i")), F.slice("tokens", F.lit(1), F.col("j"))))
    found = found.filter(before + F.least(F.col("b") - F.col("i"), F.col("t") - F.col("j")) >= F.col("need"))
    overlap = F.size(F.array_intersect("block", "tokens"))
    return (found.withColumn("overlap", overlap).filter(F.col("overlap") >= F.col("need"))
            .select("doc_id", "text_key", "label", (F.col("overlap") / F.size("tokens")).alias("score")))


def license_scan(docs: DataFrame, phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
                 templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: int = 80) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest containment of a template in a block that reaches ``threshold`` percent, else 0."""
    from pyspark.sql.pandas.types import to_arrow_type

    session(docs)
    cat = Catalogue.of(phrases, templates, threshold)
    rows = docs.select("doc_id", text_key().alias("text_key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    scanned = cut(rows.mapInArrow(_scan(cat, to_arrow_type(kind)), f"doc_id {kind.simpleString()}, text_key bigint, {_FIELDS}"),
                  "license-blocks")
    held = (_matches(scanned, cat).groupBy("doc_id", "text_key")
            .agg(F.collect_set("label").alias("labels"), F.max("score").alias("score"))
            .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__tk"), "labels", "score"))
    base = F.filter(F.array(*[F.when(F.col("base_bits").bitwiseAND(1 << p) != 0, F.lit(label))
                              for p, (_, label) in enumerate(cat.phrases)]), lambda x: x.isNotNull())
    joined = scanned.withColumn("base", base).join(
        held, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__tk")), "left")
    every = F.array_union("base", F.coalesce("labels", F.array().cast("array<string>")))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                         F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
                         F.array_join(F.array_sort(every), ",").alias("labels"),
                         F.coalesce("score", F.lit(0.0)).alias("score"))
