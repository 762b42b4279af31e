"""Quality rules (operator 4): base rules and robust multivariate outliers.

Per document, base counts (words, characters in words, symbols, repeated lines, words in
repeated 3-word windows) and five transformed, length-free statistics are computed in one
vectorised pass. For every (language, source) group the minimum covariance determinant
location and scatter of the statistics is estimated over all its documents by concentration
steps: squared Mahalanobis distances under the current estimate, the 75 % smallest
(found from an exact histogram of distances), their mean and covariance, again until the
steps are done; then the usual consistency factor and one reweighting step. Documents whose
squared distance exceeds the cutoff are rejected.

Statistics are stored as fixed-point integers and all sums are integer sums, so estimates do not depend
on task order. A step is one aggregate per group and distance bin, combined map-side: a hot group
costs no more than its bins. Scatter matrices get a floor per statistic (``MIN_SCALE``), so a statistic
that is constant in the group's core does not reject every deviation.

Every document gets a verdict. A group of ``min_rows`` documents (a small multiple of the number of
statistics) or more is estimated on its own. A smaller one of n documents is estimated too, and its location
and scatter are drawn towards its language's: n / min_rows its own, the rest the language's, which
is drawn towards the whole corpus in the same way where the language is small as well. The shrinking
is part of every step, so the core is chosen under the shrunk estimate. Languages and the corpus are estimated
over all their documents, in the same passes, where some group needs them. A corpus of fewer than
``min_rows`` documents is estimated as it is.

Defined cases: a NULL, empty or word-free text has zero counts and fails the base rule; NULL
languages and sources are groups of their own; NULL ids are allowed; equal rows get equal
verdicts; an empty table gives an empty table. :func:`quality_rules` keeps all columns and replaces
input columns named like its results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type

from medallion.llm.common import cut, give_back, session
from medallion.llm.words import BYTES, grams, hash_spans, mix, rows_of, spans, sum_by_row, words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = ("s0", "s1", "s2", "s3", "s4")
P = len(STATS)
SCALE = 1 << 10  # fixed-point statistics
# Smallest standard deviation of each statistic that a group is credited with: word length (log),
# symbol rate, share of repeated lines, share of repeated words, share of capitals.
MIN_SCALE = (0.08, 0.45, 0.3, 0.3, 0.25)
CORE = 0.75  # share of a group's rows in the determinant's subset
STEPS = 5
TAIL = 1e-5  # share of normal documents beyond the cutoff
MIN_ROWS = 5 * P  # rows from which a group's own estimate stands alone
MIN_WORDS = 50
RESULTS = (*COUNTS, "base_failed", "distance", "kept")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_STRUCT = pa.struct([(c, pa.int64()) for c in COUNTS + STATS])


def _repeats(w) -> np.ndarray:
    """Words per row in 3-word windows found twice or more in the row."""
    g, at = grams(w.hash, w.doc, 3)
    cover = np.zeros(len(w.hash) + 1, np.int64)
    if len(g):
        with np.errstate(over="ignore"):
            key = mix(g ^ (w.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(g), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        np.add.at(cover, hit, 1)
        np.subtract.at(cover, hit + 3, 1)
    covered = np.cumsum(cover)[:-1] > 0
    return np.bincount(w.doc[covered], minlength=w.n)


def _dup_lines(w) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word that equal an earlier line, lines with a word) per row."""
    if not len(w.start):
        z = np.zeros(w.n, np.int64)
        return z, z
    s, e = spans(w.data, w.off, _NEWLINE)  # non-empty lines
    first = np.searchsorted(w.start, s)
    has = (first < len(w.start)) & (w.start[np.minimum(first, len(w.start) - 1)] < e)
    s, e = s[has], e[has]
    row = rows_of(s, w.off)
    with np.errstate(over="ignore"):
        key = hash_spans(BYTES, w.data, s, e) ^ (row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, one = np.unique(key, return_index=True)
    n = np.bincount(row, minlength=w.n)
    return n - np.bincount(row[one], minlength=w.n), n


def text_counts(arr: pa.Array) -> dict[str, np.ndarray]:
    """Base counts and fixed-point statistics of every text of an Arrow array."""
    out = {c: np.zeros(len(arr), np.int64) for c in COUNTS + STATS}
    for w in words(arr):
        at = slice(w.row0, w.row0 + w.n)
        lead = (w.data & 0xC0) != 0x80
        white = np.ones(len(w.data), bool)
        edge = np.zeros(len(w.data) + 1, np.int8)
        edge[w.start] += 1
        edge[w.end] -= 1
        white = np.cumsum(edge[:-1], dtype=np.int8) == 0
        n = w.counts()
        chars = sum_by_row(lead & ~white, w.off)
        symbols = sum_by_row(_SYMBOL[w.data], w.off)
        upper = sum_by_row(_UPPER[w.data], w.off)
        dups, lines = _dup_lines(w)
        rep = _repeats(w)
        for c, v in zip(COUNTS, (n, chars, symbols, dups, rep), strict=True):
            out[c][at] = v
        size, letters = np.maximum(n, 1), np.maximum(chars, 1)
        for c, v in zip(STATS, (np.log(letters / size), np.log1p(200 * symbols / letters),
                                np.log1p(8 * dups / np.maximum(lines, 1)), np.log1p(8 * rep / size),
                                np.log1p(8 * upper / letters)), strict=True):
            out[c][at] = np.rint(v * SCALE)
    return out


@arrow_udf(from_arrow_type(_STRUCT))
def _counts(text: pa.Array) -> pa.Array:
    c = text_counts(text)
    give_back()
    return pa.StructArray.from_arrays([pa.array(c[f.name]) for f in _STRUCT], fields=list(_STRUCT))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)


# --- chi-square quantiles (for the consistency factor and the cutoffs) ---

def _chi2_cdf(x: float, p: float) -> float:
    a, x = p / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi2_quantile(q: float, p: float) -> float:
    lo, hi = 0.0, 10.0 * p + 400
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, p) < q else (lo, mid)
    return (lo + hi) / 2


CUTOFF = chi2_quantile(1 - TAIL, P)
_REWEIGHT = chi2_quantile(0.975, P)
_FACTOR_CORE = CORE / _chi2_cdf(chi2_quantile(CORE, P), P + 2)
_FACTOR_REWEIGHT = 0.975 / _chi2_cdf(_REWEIGHT, P + 2)

# --- estimates per group ---

_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_MEAN = ["m" + str(i) for i in range(P)]
_RAW = [*_MEAN, *(f"c{i}{j}" for i, j in _PAIRS)]
_MODEL = [*_MEAN, *(f"p{i}{j}" for i, j in _PAIRS)]
_KEYS = ("level", "grp_lang", "grp_source")  # level 0: language and source, 1: language, 2: corpus
_KEYS_DDL = "level int, grp_lang string, grp_source string, n long, "
_RAW_DDL = _KEYS_DDL + ", ".join(f"{c} double" for c in _RAW)
_MODEL_DDL = _KEYS_DDL + ", ".join(f"{c} double" for c in _MODEL)
_BINS = 8  # distance bins per doubling


def _raw_row(pdf: pd.DataFrame, n: int, mean: np.ndarray, cov: np.ndarray) -> pd.DataFrame:
    first = pdf.iloc[0]
    return pd.DataFrame([[*(first[k] for k in _KEYS), n, *map(float, mean), *(float(cov[i, j]) for i, j in _PAIRS)]],
                        columns=[*_KEYS, "n", *_RAW])


def _inverse(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Scatter to inverse scatter (off-diagonal terms doubled, as the distance sums each pair once)."""
    for pdf in pdfs:
        cov = np.zeros((len(pdf), P, P))
        for i, j in _PAIRS:
            cov[:, i, j] = cov[:, j, i] = pdf[f"c{i}{j}"]
        inv = np.linalg.inv(cov + np.diag(np.square(MIN_SCALE)))
        out = pdf[[*_KEYS, "n", *_MEAN]].copy()
        for i, j in _PAIRS:
            out[f"p{i}{j}"] = inv[:, i, j] * (1 if i == j else 2)
        yield out


def _start(pdf: pd.DataFrame) -> pd.DataFrame:
    """First estimate of a group from its histogram per statistic: medians and absolute deviations."""
    mean, sd, n = np.zeros(P), np.zeros(P), 0
    for i in range(P):
        h = pdf[pdf.stat == i].sort_values("bin")
        v, c = h["bin"].to_numpy(float) / 32, h["n"].to_numpy()
        n = int(c.sum())
        mean[i] = v[np.searchsorted(np.cumsum(c), (n + 1) / 2)]
        d = np.abs(v - mean[i])
        o = np.argsort(d, kind="stable")
        sd[i] = 1.4826 * d[o][np.searchsorted(np.cumsum(c[o]), (n + 1) / 2)]
    return _raw_row(pdf, n, mean, np.diag(sd ** 2))


def _refit(reweight: bool):
    limit_bin = math.floor(math.log2(_REWEIGHT) * _BINS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy()
        last = (pdf["bin"].to_numpy() <= limit_bin) if reweight else np.cumsum(n) - n < math.ceil(CORE * n.sum())
        if not last.any():
            last[0] = True
        k = float(n[last].sum())
        core = pdf[last]
        mean = np.array([core["t" + str(i)].sum() / k for i in range(P)])
        cov = np.zeros((P, P))
        for i, j in _PAIRS:
            cov[i, j] = cov[j, i] = core[f"t{i}{j}"].sum() / k - mean[i] * mean[j]
        share = k / n.sum()
        factor = _FACTOR_REWEIGHT if reweight else (share / _chi2_cdf(chi2_quantile(min(share, 1 - 1e-9), P), P + 2))
        return _raw_row(pdf, int(n.sum()), mean / SCALE, factor * cov / SCALE ** 2)
    return run


def _shrunk(raw: DataFrame, min_rows: int) -> DataFrame:
    """The groups' models: estimates of fewer than ``min_rows`` rows drawn towards the level above."""
    lang = raw.filter("level = 1").select(F.col("grp_lang").alias("l_lang"), F.struct("n", *_RAW).alias("l"))
    whole = raw.filter("level = 2").select(F.struct(*_RAW).alias("w"))
    df = (raw.join(F.broadcast(lang), (F.col("level") == 0) & F.col("grp_lang").eqNullSafe(F.col("l_lang")), "left")
          .join(F.broadcast(whole), F.col("level") < 2, "left"))

    def towards(own: Column, n: Column, above: Column) -> Column:
        share = F.least(F.lit(1.0), n / F.lit(float(min_rows)))
        return F.when(above.isNull() | (share == 1.0), own).otherwise(share * own + (1 - share) * above)

    def value(c: str) -> Column:
        above = F.when(F.col("level") == 0, towards(F.col("l." + c), F.col("l.n"), F.col("w." + c))).otherwise(F.col("w." + c))
        return towards(F.col(c), F.col("n"), above).alias(c)

    return df.select(*_KEYS, "n", *(value(c) for c in _RAW)).mapInPandas(_inverse, _MODEL_DDL)


def _same_group(a: DataFrame, b: DataFrame) -> Column:
    c = F.lit(True)
    for k in _KEYS:
        c = c & a[k].eqNullSafe(b["g_" + k])
    return c


def _with_model(df: DataFrame, model: DataFrame) -> DataFrame:
    """``df`` with the squared distance of its statistics under its group's model."""
    m = model.drop("n").withColumnsRenamed({k: "g_" + k for k in _KEYS})
    d = [F.col(s) / SCALE - F.col(f"m{i}") for i, s in enumerate(STATS)]
    total = sum((F.col(f"p{i}{j}") * d[i] * d[j] for i, j in _PAIRS), F.lit(0.0))
    return df.join(m, _same_group(df, m)).withColumn("d2", total).drop(*_MODEL, *("g_" + k for k in _KEYS))


def groups_of(stats: DataFrame, min_rows: int) -> DataFrame:
    """(lang, source, levels) of every group of ``stats``: the levels at which its rows are estimated. A
    language is, where one of its groups is small; the corpus, where such a language is small."""
    n = cut(stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "groups")
    langs = n.groupBy(F.col("lang").alias("q_lang")).agg(F.sum("n").alias("q_n"), F.min("n").alias("least"))
    langs = langs.withColumn("pooled", F.col("least") < min_rows)
    whole = not langs.filter(F.col("pooled") & (F.col("q_n") < min_rows)).isEmpty()
    up = [2] if whole else []
    levels = F.when(F.col("pooled"), F.lit([0, 1, *up])).otherwise(F.lit([0, *up]))
    return (n.join(langs, F.col("lang").eqNullSafe(F.col("q_lang")))
            .select("lang", "source", levels.cast("array<int>").alias("levels")))


def fit_outlier_model(stats: DataFrame, min_rows: int, steps: int = STEPS) -> DataFrame:
    """One row per group: location and inverse scatter. ``stats``: lang, source, s0.."""
    groups = cut(groups_of(stats, min_rows), "groups").withColumnsRenamed({"lang": "h_lang", "source": "h_source"})
    level = F.col("level")
    stats = (stats.join(groups, stats["lang"].eqNullSafe(groups["h_lang"]) & stats["source"].eqNullSafe(groups["h_source"]))
             .select("lang", "source", *STATS, F.explode("levels").alias("level"))
             .select("level", F.when(level < 2, F.col("lang")).alias("grp_lang"),
                     F.when(level < 1, F.col("source")).alias("grp_source"), *STATS))
    hist = (stats.select(*_KEYS, F.posexplode(F.array(*[F.floor(F.col(s) * 32 / SCALE) for s in STATS])).alias("stat", "bin"))
            .groupBy(*_KEYS, "stat", "bin").agg(F.count(F.lit(1)).alias("n")))
    raw = cut(hist.groupBy(*_KEYS).applyInPandas(_start, _RAW_DDL), "mcd")
    sums = ([F.count(F.lit(1)).alias("n")] + [F.sum(s).alias("t" + str(i)) for i, s in enumerate(STATS)]
            + [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"t{i}{j}") for i, j in _PAIRS])
    for k in range(steps + 1):
        bins = (_with_model(stats, cut(_shrunk(raw, min_rows), "mcd"))
                .withColumn("bin", F.floor(F.log2(F.greatest("d2", F.lit(1e-6))) * _BINS))
                .groupBy(*_KEYS, "bin").agg(*sums))
        raw = cut(bins.groupBy(*_KEYS).applyInPandas(_refit(k == steps), _RAW_DDL), "mcd")
    return cut(_shrunk(raw, min_rows).filter("level = 0"), "mcd")


def _stats(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                        _counts(F.col(text_col)).alias("c"))
            .select("doc_id", "lang", "source", "c.*"))


def _verdict(df: DataFrame) -> DataFrame:
    """Adds base_failed, distance and kept to rows with counts and d2."""
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (df.withColumn("base_failed", failed).withColumn("distance", F.sqrt(F.greatest("d2", F.lit(0.0))))
            .withColumn("kept", ~failed & (F.col("d2") <= CUTOFF)))


def quality_table(docs: DataFrame, min_rows: int = MIN_ROWS, steps: int = STEPS, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts and verdict per document, without the texts: doc_id, lang, source, the base counts,
    base_failed, distance, kept."""
    session(docs)
    stats = cut(_stats(docs, id_col, text_col, lang_col, source_col), "quality")
    model = fit_outlier_model(stats.select("lang", "source", *STATS), min_rows, steps)
    rows = stats.select("*", F.lit(0).alias("level"), F.col("lang").alias("grp_lang"), F.col("source").alias("grp_source"))
    return _verdict(_with_model(rows, model)).select("doc_id", "lang", "source", *RESULTS)


def quality_rules(docs: DataFrame, min_rows: int = MIN_ROWS, steps: int = STEPS, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` with the base counts, base_failed, distance and kept. The texts are not shuffled: counts
    are taken again beside each text and scored against the groups' models."""
    session(docs)
    rows = cut(_stats(docs, id_col, text_col, lang_col, source_col).select("lang", "source", *STATS), "quality")
    model = fit_outlier_model(rows, min_rows, steps)
    named = model.select(F.struct(F.col("grp_lang").alias("lang"), F.col("grp_source").alias("source"), *_MODEL).alias("__q_m"))
    names = [c for c in docs.columns if c not in RESULTS]
    df = docs.withColumn("__q_c", _counts(F.col(text_col)))
    df = df.join(named, df[lang_col].eqNullSafe(F.col("__q_m.lang")) & df[source_col].eqNullSafe(F.col("__q_m.source")), "left")
    c, m = (lambda n: F.col("__q_c." + n)), (lambda n: F.col("__q_m." + n))
    d = [c(s) / SCALE - m(f"m{i}") for i, s in enumerate(STATS)]
    d2 = sum((m(f"p{i}{j}") * d[i] * d[j] for i, j in _PAIRS), F.lit(0.0))
    failed = base_failed(c("n_words"), c("n_repeat_words"))
    kept = ~failed & (d2 <= CUTOFF)
    return df.select(*names, *(c(n).alias(n) for n in COUNTS), failed.alias("base_failed"),
                     F.sqrt(F.greatest(d2, F.lit(0.0))).alias("distance"), kept.alias("kept"))
