"""Toxicity (operator 7): cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(t_k - w x) with ascending thresholds t and one weight vector for all
of them. Features are words (A-Z lower-cased, punctuation stripped at the ends) and their first 4, 5 and 6
bytes, so inflected forms share weight, chosen by their association with the labels; a
feature's value is log(1 + count), so a long text does not thin out what it contains. The expected severity is the sum over k of P(grade > k).

Fitting uses at most ``sample`` labelled documents (a documented bound: per class the first by a hash of
the id, up to half the bound or more where the other class has fewer; thresholds are corrected for the classes' shares), in one task; scoring covers every document. Labels may be grades; 0/1 labels are first
refined: toxic documents are graded 1 to ``grades`` - 1 by how many of the associated words they hold
(equal shares of the toxic sample).

Defined cases: NULL and empty texts get the severity of a text without features; labels that are
NULL or belong to no document are ignored; with no labels, or of one kind only, severity is that kind's
grade throughout; an id labelled twice takes its highest grade; equal rows get equal scores; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut, session
from medallion.llm.sparse import MAX_FEATURES, Vocabulary, adam, by_class, dump, load, one_row, select_features, sigmoid
from medallion.llm.words import BYTES_LOWER, U, Words, bare_words, hash_spans

SAMPLE, GRADES = 8_000, 4
_FEATS = "grade int, f binary, c binary"


PREFIXES = (4, 5, 6)


def _features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of every word and of the beginnings of longer words."""
    rows, hashes = [w.doc], [w.hash]
    for n in PREFIXES:
        longer = w.end - w.start > n
        s = w.start[longer]
        rows.append(w.doc[longer])
        hashes.append(hash_spans(BYTES_LOWER, w.data, s, s + n) ^ U(n))
    return np.concatenate(rows), np.concatenate(hashes)


def _row_features(arr: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, feature hashes, counts) of every text."""
    for w in bare_words(arr):
        row, h = _features(w)
        order = np.argsort(row, kind="stable")
        row, h = row[order], h[order]
        cuts = np.searchsorted(row, np.arange(w.n + 1))
        for r in range(w.n):
            u, n = np.unique(h[cuts[r]:cuts[r + 1]], return_counts=True)
            yield w.row0 + r, u, n


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f, c = [b""] * batch.num_rows, [b""] * batch.num_rows
        for r, u, n in _row_features(batch.column("text")):
            f[r], c[r] = u.tobytes(), n.astype(np.int32).tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(f, pa.binary()), pa.array(c, pa.binary())],
                                         names=["grade", "f", "c"])


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, x: np.ndarray, y: np.ndarray, size: int, grades: int,
                steps: int = 300, rate: float = 0.05, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds). Thresholds are the first plus positive steps, so they stay in order."""
    n, k = len(y), grades - 1
    share = np.array([np.mean(y <= g) for g in range(k)]).clip(1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    gap = np.maximum(np.diff(start), 0.05)

    def split(p):
        steps_ = np.exp(np.clip(p[size + 1:], -20, 20))
        return p[:size], p[size] + np.concatenate(([0.0], np.cumsum(steps_))), steps_

    def gradient(p):
        w, t, steps_ = split(p)
        score = np.bincount(rows, weights=x * w[cols], minlength=n)
        edges = np.concatenate((np.full((n, 1), -60.0), t[None, :] - score[:, None], np.full((n, 1), 60.0)), 1)
        s = sigmoid(edges)
        s[:, 0], s[:, -1] = 0.0, 1.0
        i = np.arange(n)
        prob = np.maximum(s[i, y + 1] - s[i, y], 1e-12)
        d_hi, d_lo = s[i, y + 1] * (1 - s[i, y + 1]) / prob, s[i, y] * (1 - s[i, y]) / prob
        g_score = (d_hi - d_lo) / n  # of the negative log-likelihood
        g_t = np.zeros((n, k + 2))
        g_t[i, y + 1] -= d_hi
        g_t[i, y] += d_lo
        g_t = g_t[:, 1:-1].sum(0) / n
        tail = np.cumsum(g_t[::-1])[::-1]
        g_w = np.bincount(cols, weights=x * g_score[rows], minlength=size) + l2 * w / n * 100
        return np.concatenate((g_w, [tail[0]], tail[1:] * steps_))

    p0 = np.concatenate((np.zeros(size), [start[0]], np.log(gap)))
    w, t, _ = split(adam(gradient, p0, steps, rate))
    return w, t


def _fit(grades: int, binary: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, f, c = [], [], []
        for batch in batches:
            y += batch.column("grade").to_pylist()
            f += [np.frombuffer(v.as_buffer(), U) for v in batch.column("f")]
            c += [np.frombuffer(v.as_buffer(), np.int32) for v in batch.column("c")]
        if not y:
            yield one_row(dump({"hashes": np.zeros(0, U), "w": np.zeros(0), "t": np.full(max(1, grades - 1), 60.0)}))
            return
        y = np.array(y)
        # rows arrive in any order: sort them, so that reruns agree
        order = sorted(range(len(y)), key=lambda i: (y[i], len(f[i]), f[i].tobytes()))
        y, f, c = y[order], [f[i] for i in order], [c[i] for i in order]
        rows = np.repeat(np.arange(len(y)), [len(v) for v in f])
        hashes, counts = np.concatenate(f), np.concatenate(c)
        chosen, z = select_features(hashes, rows, (y > 0).astype(int), MAX_FEATURES)
        vocab = Vocabulary(chosen)
        at, cols = vocab.lookup(hashes)
        rows, x = rows[at], np.log1p(counts[at])
        top = grades
        if binary:  # grade the toxic rows by the associated words they hold
            score = np.zeros(len(vocab.hashes))
            score[np.searchsorted(vocab.hashes, chosen)] = np.maximum(z, 0)
            load_ = np.bincount(rows, weights=x * score[cols], minlength=len(y))
            bad = np.flatnonzero(y > 0)
            ranked = bad[np.argsort(load_[bad], kind="stable")]
            y = y.copy()
            y[ranked] = 1 + np.arange(len(ranked)) * (grades - 1) // max(1, len(ranked))
        else:
            top = int(y.max()) + 1
        if top < 2 or len(np.unique(y)) < 2:
            t = np.where(np.arange(max(1, top - 1)) < y.max(), -60.0, 60.0)
            yield one_row(dump({"hashes": np.zeros(0, U), "w": np.zeros(0), "t": t}))
            return
        w, t = fit_ordinal(rows, cols, x, y, len(vocab.hashes), top)
        yield one_row(dump({"hashes": vocab.hashes, "w": w, "t": t}))
    return run


def severity_scores(arr: pa.Array, vocab: Vocabulary, w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(expected severity, P(grade > 0)) of every text."""
    score = np.zeros(len(arr))
    if len(vocab.hashes):
        for part in bare_words(arr):
            row, h = _features(part)
            at, col = vocab.lookup(h)
            key, n = np.unique(row[at] * len(vocab.hashes) + col, return_counts=True)
            score[part.row0:part.row0 + part.n] = np.bincount(
                key // len(vocab.hashes), weights=np.log1p(n) * w[key % len(vocab.hashes)], minlength=part.n)
    above = 1 - sigmoid(t[None, :] - score[:, None])
    return above.sum(1), above[:, 0]


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample: int, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """(grade, text) of at most ``sample`` labelled documents, the first ids by hash per class, and how much that moved
    the log odds. The ids are few enough to be sent to the documents, which are scanned once and not shuffled."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("l_id")).agg(F.max(label_col).cast("int").alias("grade")))
    ids, moved = by_class(known, "grade", sample)
    texts = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    return texts.join(F.broadcast(ids), F.col("d_id") == F.col("l_id")).select("grade", "text"), moved


def severity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", grades: int = GRADES, binary: bool = True,
             sample: int = SAMPLE, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, expected_severity, p_toxic, toxic) for every document."""
    spark = session(docs)
    rows, moved = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    rows = rows.mapInArrow(_featurise, _FEATS)
    model = cut(rows.repartition(1).mapInArrow(_fit(grades, binary), "model binary"), "ordinal").first()
    held = spark.sparkContext.broadcast(bytes(model.model) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(held.value)
        vocab = Vocabulary(m["hashes"])
        for batch in batches:
            e, p = severity_scores(batch.column("text"), vocab, m["w"], m["t"] + moved)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(e), pa.array(p), pa.array(p >= threshold)],
                                             names=["doc_id", "expected_severity", "p_toxic", "toxic"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, expected_severity double, p_toxic double, toxic boolean"))
