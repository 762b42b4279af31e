"""Quality classifier (operator 6) by co-training two views.

The content view sees words and word shapes (last character, capitals, length); the metadata view
sees language, source, their combination, size and line layout. Each is a logistic
regression. In every round both are fitted, and each hands the unlabelled documents of the whole corpus it
is surest about to the other as pseudo-labels, in the classes' labelled proportions. Both are
then calibrated on labelled documents kept out of fitting, and a logistic combination of the calibrated
views scores every document.

Fitting uses at most ``sample`` labelled documents (per class the first by a hash of the id, up to half the bound or more where the other class
has fewer; the scores are corrected for the classes' shares; a documented bound).
Unlabelled documents are not sampled: their features that the labelled documents make useful are packed once (the
labelled ids, 8 bytes each, go to the packing tasks; beyond :data:`MOST_IDS` of them the packed rows are joined
to them instead, texts are never shuffled), all of them are scored on the executors in every round, and each view hands over ``hand_over`` of their number: the
highest and lowest scores, cut at an exact histogram of scores (steps of 0.001; within the last step by a
hash of the row). Which documents were handed over follows from the earlier models and cuts, so nothing
is joined back. Pseudo-labelled documents are fitted in parts of about ``pool`` rows, each with the labelled
ones and with its pseudo-labels standing for all parts'; the parts' weights are averaged, on the executors, in a tree. One part
is the plain fit; with several the average approximates it, and weights of metadata values rare among the
pseudo-labels come out smaller. Metadata values share :data:`SLOTS` weights by hash, which bounds the model whatever the
number of sources.

A quarter of each class's labelled rows is kept out of fitting for the calibration; a class of under four rows is used
for both.

Defined cases: NULL and empty texts have no content features, NULL metadata is a value of its own; labels that are
NULL or belong to no document are ignored, an id labelled twice takes its lowest grade; without
labels of both kinds every score is the labelled share of good documents (1 without labels); equal
rows get equal scores; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut, session
from medallion.llm.sparse import Vocabulary, adam, by_class, dump, load, one_row, select_features, sigmoid
from medallion.llm.words import BYTES_LOWER, U, hash_spans, mix, sum_by_row, words

SAMPLE, POOL, ROUNDS = 6_000, 6_000, 3  # POOL: pseudo-labelled rows of one fitting task
HAND_OVER = 0.08  # share of the unlabelled documents that a view hands over in a round
MOST_IDS = 1 << 23  # labelled ids that are sent to the tasks (64 MB)
SLOTS = 1 << 16  # weights of the metadata view
FAN_IN = 64  # models that one task averages
SURE, STEP = 2, 1000  # least logit of a pseudo-label; steps of the scores' histogram per unit
FEATURES = 20_000
_ROW = "y int, f binary, v binary, m binary"
_PACKED = "tie long, c binary, x binary, m binary"
_CHOSEN = "part long, y0 int, y1 int, " + _PACKED
_META = 5  # metadata values of a document

_PUNCT = np.zeros(256, np.int64)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = [b for b in range(33, 127) if not chr(b).isalnum()]


def _content(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row, feature hash, value) per chunk: sqrt of each feature's share of the words."""
    for w in words(arr, hashed=False):
        h = hash_spans(BYTES_LOWER, w.data, w.start, w.end)
        size = w.end - w.start
        up = np.concatenate(([0], np.cumsum((w.data >= 65) & (w.data <= 90))))
        caps = (up[w.end] - up[w.start] >= 2) * 1
        last = _PUNCT[w.data[w.end - 1]] if len(w.end) else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            shape = mix((last + 256 * caps + 512 * np.minimum(size, 15)).astype(U) + U(0x51ED270B))
            edge = mix((last + 256 * caps).astype(U) + U(0x7F4A7C15))
        row = np.concatenate((w.doc, w.doc, w.doc))
        hashes = np.concatenate((h, shape, edge))
        order = np.lexsort((hashes, row))
        row, hashes = row[order], hashes[order]
        head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))) if len(row) else np.zeros(0, np.int64)
        n = np.diff(np.append(head, len(row)))
        total = np.maximum(w.counts(), 1)
        yield w.row0, w.n, row[head], hashes[head], np.sqrt(n / total[row[head]])


def _metadata(batch: pa.RecordBatch) -> np.ndarray:
    """(rows, 5) slots of language, source, both, size and line layout."""
    from medallion.llm.words import chunks

    n = batch.num_rows

    def code(name: str) -> np.ndarray:
        arr = batch.column(name).fill_null("\x00")
        out = np.zeros(n, U)
        for row0, data, off in chunks(arr):
            k = len(off) - 1
            out[row0:row0 + k] = hash_spans(BYTES_LOWER, data, off[:-1], off[1:])
        return out

    lang, source = code("lang"), code("source")
    size = np.zeros(n, np.int64)
    lines = np.zeros(n, np.int64)
    for row0, data, off in chunks(batch.column("text")):
        size[row0:row0 + len(off) - 1] = np.diff(off)
        lines[row0:row0 + len(off) - 1] = sum_by_row(data == 10, off)
    given = batch.column("n_chars").to_numpy(zero_copy_only=False)
    given = np.nan_to_num(np.asarray(given, np.float64), nan=-1)
    bucket = np.rint(2 * np.log2(np.maximum(given, 0) + 1)).astype(np.int64) - (given < 0)
    layout = np.rint(2 * np.log2(size / (lines + 1) + 1)).astype(np.int64)
    with np.errstate(over="ignore"):
        h = np.stack((mix(lang + U(1)), mix(source + U(2)), mix(lang * U(3) + mix(source + U(3))),
                      mix(bucket.astype(np.int64).view(U) + U(4 << 32)), mix(layout.view(U) + U(5 << 32))), 1)
    return (h % U(SLOTS)).astype(np.uint16)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f, v = [b""] * batch.num_rows, [b""] * batch.num_rows
        for row0, n, row, h, x in _content(batch.column("text")):
            cuts = np.searchsorted(row, np.arange(n + 1))
            for r in range(n):
                f[row0 + r] = h[cuts[r]:cuts[r + 1]].tobytes()
                v[row0 + r] = x[cuts[r]:cuts[r + 1]].astype(np.float32).tobytes()
        m = [r.tobytes() for r in _metadata(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(f, pa.binary()), pa.array(v, pa.binary()),
                                          pa.array(m, pa.binary())], names=["y", "f", "v", "m"])


def fit_logistic(rows, cols, x, y, weight, size: int, steps: int = 150, rate: float = 0.1, l2: float = 1.0) -> np.ndarray:
    """Weights and, last, the intercept; ``weight`` 0 leaves a row out."""
    total = max(1.0, weight.sum())

    def gradient(p):
        s = np.bincount(rows, weights=x * p[cols], minlength=len(y)) + p[-1]
        e = (sigmoid(s) - y) * weight / total
        return np.append(np.bincount(cols, weights=x * e[rows], minlength=size) + l2 * p[:-1] / total, e.sum())

    return adam(gradient, np.zeros(size + 1), steps, rate)


def _platt(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(slope, offset) of the calibrated logit, by Newton steps with a weak prior."""
    p = np.array([1.0, 0.0])
    X = np.stack((score, np.ones_like(score)), 1)
    for _ in range(30):
        q = sigmoid(X @ p)
        h = (X * (q * (1 - q))[:, None]).T @ X + np.diag([1e-2, 1e-2])
        p -= np.linalg.solve(h, X.T @ (q - y) + 1e-2 * (p - [1.0, 0.0]))
    return p


def _combine(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    X = np.stack((a, b, np.ones_like(a)), 1)
    p0 = np.array([1.0, 0.0, 0.0])
    p = p0.copy()
    for _ in range(30):
        q = sigmoid(X @ p)
        h = (X * (q * (1 - q))[:, None]).T @ X + np.eye(3) * 1e-1
        p -= np.linalg.solve(h, X.T @ (q - y) + 1e-1 * (p - p0))
    return p


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The labelled sample in a fixed order, its content features cut to the selected ones: one row."""
    y, f, v, m = [], [], [], []
    for batch in batches:
        y += batch.column("y").to_pylist()
        f += [np.frombuffer(b.as_buffer(), U) for b in batch.column("f")]
        v += [np.frombuffer(b.as_buffer(), np.float32) for b in batch.column("v")]
        m += [np.frombuffer(b.as_buffer(), np.uint16) for b in batch.column("m")]
    order = sorted(range(len(y)), key=lambda i: (y[i], len(f[i]), f[i].tobytes(), m[i].tobytes()))
    y = np.array([y[i] for i in order], np.int64)
    f, v, m = [f[i] for i in order], [v[i] for i in order], [m[i] for i in order]
    none = np.zeros(0, U)
    rank = np.arange(len(y)) - np.searchsorted(y, y)  # within the class
    few = np.bincount(y, minlength=2)[y] < 4 if len(y) else np.zeros(0, bool)
    hold, train = (rank % 4 == 3) | few, (rank % 4 != 3) | few
    rows = np.repeat(np.arange(len(y)), [len(x) for x in f])
    h, x = np.concatenate([none, *f]), np.concatenate([np.zeros(0, np.float32), *v])
    vocab = Vocabulary(select_features(h, rows, np.where(train, y, -1), FEATURES)[0] if _both(y) else none)
    at, cols = vocab.lookup(h)
    yield one_row(dump({"y": y, "hold": hold, "train": train, "t": vocab.hashes, "rows": rows[at], "cols": cols, "x": x[at],
                        "m": np.stack(m) if m else np.zeros((0, _META), np.uint16)}))


def _both(y: np.ndarray) -> bool:
    return 0 < (y == 1).sum() < len(y)


def _pack(held, ids):
    """Documents' selected content features, metadata and a hash that orders equal scores; rows of labelled
    ``ids`` (sorted) are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(load(held.value)["t"])
        for batch in batches:
            if ids is not None and len(ids.value):
                at = np.searchsorted(ids.value, doc := batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
                found = ids.value[np.minimum(at, len(ids.value) - 1)] == doc
                batch = batch.filter(pa.array(~found | batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)))
            c, v = [b""] * batch.num_rows, [b""] * batch.num_rows
            for row0, n, row, h, x in _content(batch.column("text")):
                at, cols = vocab.lookup(h)
                cuts = np.searchsorted(row[at], np.arange(n + 1))
                cols, x = cols.astype(np.uint16), x[at].astype(np.float32)
                for r in range(n):
                    c[row0 + r], v[row0 + r] = cols[cuts[r]:cuts[r + 1]].tobytes(), x[cuts[r]:cuts[r + 1]].tobytes()
            m = [r.tobytes() for r in _metadata(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(c, pa.binary()), pa.array(v, pa.binary()),
                                              pa.array(m, pa.binary())], names=["doc_id", "tie", "c", "x", "m"])
    return run


def _free(src: DataFrame, known: DataFrame, blob: bytes) -> DataFrame:
    """The packed rows of all documents without a label."""
    sc = src.sparkSession.sparkContext
    held = sc.broadcast(blob)
    rows = src.withColumn("tie", F.expr("xxhash64(doc_id, text, lang, source) & 9223372036854775807"))
    if known.count() <= MOST_IDS:
        ids = sc.broadcast(np.sort(known.select("l_id").toPandas()["l_id"].to_numpy(np.int64)))
        return rows.mapInArrow(_pack(held, ids), "doc_id long, " + _PACKED).drop("doc_id")
    packed = rows.mapInArrow(_pack(held, None), "doc_id long, " + _PACKED)
    return packed.join(known.select("l_id"), F.col("doc_id") == F.col("l_id"), "left_anti").drop("doc_id")


def _unpack(c, x, m) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature number, value, metadata slots) of packed rows."""
    cols = [np.frombuffer(b.as_buffer(), np.uint16) for b in c]
    rows = np.repeat(np.arange(len(cols)), [len(k) for k in cols])
    x = np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(b.as_buffer(), np.float32) for b in x)])
    meta = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(b.as_buffer(), np.uint16) for b in m)]).reshape(-1, _META)
    return rows, np.concatenate([np.zeros(0, np.uint16), *cols]).astype(np.int64), x, meta


def _meta_score(meta: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w[:-1][meta].sum(axis=1) + w[-1]


def _handed(batch: pa.RecordBatch, models: list[dict], limits: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(scores of both views under the last model in steps, pseudo-labels given to each view or -1). ``limits``:
    per round and view, (step, tie) of the last good and of the last bad document handed over."""
    rows, cols, x, meta = _unpack(batch.column("c"), batch.column("x"), batch.column("m"))
    n, tie = batch.num_rows, batch.column("tie").to_numpy() & 0xFFFF
    given = [np.full(n, -1), np.full(n, -1)]
    q = [np.zeros(n, np.int64)] * 2
    for r, w in enumerate(models):
        s = (np.bincount(rows, weights=x * w["wt"][cols], minlength=n) + w["wt"][-1], _meta_score(meta, w["wm"]))
        q = [np.rint(v * STEP).astype(np.int64) for v in s]
        if r < len(limits):
            free = [g < 0 for g in given]
            for i in (0, 1):
                (hi, hi_tie), (lo, lo_tie) = limits[r][i]
                given[1 - i][free[1 - i] & ((q[i] > hi) | ((q[i] == hi) & (tie < hi_tie)))] = 1
                given[1 - i][free[1 - i] & ((q[i] < lo) | ((q[i] == lo) & (tie < lo_tie)))] = 0
    return q, given


def _scores(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, given = _handed(batch, *held.value)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("tie").to_numpy() & 0xFFFF), pa.array(q[0]), pa.array(q[1]),
                                              pa.array(given[1] < 0), pa.array(given[0] < 0)], names=["tie", "q0", "q1", "f0", "f1"])
    return run


def _chosen(held, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, (y0, y1) = _handed(batch, *held.value)
            part = (batch.column("tie").to_numpy() >> 16) % parts
            out = pa.RecordBatch.from_arrays([pa.array(part), pa.array(y0.astype(np.int32)), pa.array(y1.astype(np.int32)), *batch.columns],
                                             names=["part", "y0", "y1", *batch.schema.names])
            yield out.filter(pa.array((y0 >= 0) | (y1 >= 0)))
    return run


def _limits(scored: DataFrame, n_good: int, n_bad: int) -> list:
    """Per view, where the ``n_good`` highest and the ``n_bad`` lowest scores of documents still free end."""
    each = F.array(*[F.struct(F.lit(i).alias("v"), F.col(f"q{i}").alias("q"), F.col(f"f{i}").alias("f"), "tie") for i in (0, 1)])
    rows = scored.select(F.explode(each).alias("e")).select("e.*").filter(F.col("f") & (F.abs("q") > SURE * STEP)).drop("f")
    bins = {(r.v, r.q): r["count"] for r in rows.groupBy("v", "q").count().collect()}
    found, last = {}, {}
    for i in (0, 1):
        for sign, n in ((1, n_good), (-1, n_bad)):
            found[i, sign] = (sign * SURE * STEP, 0)  # all of them, unless there are more
            for q in sorted((q for v, q in bins if v == i and q * sign > 0), key=abs, reverse=True):
                if bins[i, q] > n:
                    last[i, q] = n
                    found[i, sign] = (q, 0)
                    break
                n -= bins[i, q]
    if last:
        at = F.struct("v", "q").isin(*[F.struct(F.lit(v).alias("v"), F.lit(q).cast("long").alias("q")) for v, q in last])
        ties = sorted((r.v, r.q, r.tie, r["count"]) for r in rows.filter(at).groupBy("v", "q", "tie").count().collect())
        for v, q, tie, n in ties:
            last[v, q] -= n
            if last[v, q] >= 0:
                found[v, 1 if q > 0 else -1] = (q, tie + 1)
    return [(found[i, 1], found[i, -1]) for i in (0, 1)]


def _fit_part(held, parts: int):
    """Both views' weights, fitted on the labelled sample and one part of the pseudo-labelled documents."""
    def run(table: pa.Table) -> pa.Table:
        lab = load(held.value)
        named = table
        table = table.filter(pa.compute.is_valid(table["c"])).sort_by([("tie", "ascending"), ("c", "ascending"), ("m", "ascending")])
        n, y, train = len(lab["y"]), lab["y"].astype(float), lab["train"].astype(float)
        rows, cols, x, meta = _unpack(*(table[k].combine_chunks() for k in ("c", "x", "m")))
        given = [table[k].to_numpy() for k in ("y0", "y1")]
        # a pseudo-label counts half; a part's stand for those of all parts
        weight = [np.append(train, (g >= 0) * 0.5 * parts) for g in given]
        own = [np.append(y, np.maximum(g, 0)) for g in given]
        wt = fit_logistic(np.append(lab["rows"], rows + n), np.append(lab["cols"], cols), np.append(lab["x"], x), own[0], weight[0], len(lab["t"]))
        meta = np.concatenate((lab["m"], meta)).astype(np.int64)
        used, col = np.unique(meta, return_inverse=True)
        at = np.repeat(np.arange(len(meta)), _META)
        fit = fit_logistic(at, col.reshape(-1), np.ones(len(at)), own[1], weight[1], len(used))
        wm = np.zeros(SLOTS + 1)
        wm[used], wm[-1] = fit[:-1], fit[-1]
        part = named["part"][0].as_py()
        return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([1], pa.int64()),
                         "model": pa.array([dump({"wt": wt, "wm": wm})], pa.binary())})
    return run


def _add_models(table: pa.Table) -> pa.Table:
    """The sum of some models (in the parts' order, so that reruns agree)."""
    table = table.sort_by("part")
    models = [load(b.as_buffer().to_pybytes()) for b in table["model"]]
    total = {k: sum(m[k] for m in models) for k in ("wt", "wm")}
    return pa.table({"part": table["part"][:1], "n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
                     "model": pa.array([dump(total)], pa.binary())})


def _mean_model(parts: DataFrame, n: int) -> dict:
    """The average of the ``n`` parts' weights, summed in a tree: no task holds more than ``FAN_IN`` models."""
    while n > 1:
        group = F.floor(F.col("part") / FAN_IN).alias("grp")
        parts = cut(parts.select(group, "part", "n", "model").groupBy("grp").applyInArrow(_in_group, _MODEL), "model-sum")
        n = -(-n // FAN_IN)
    row = parts.first()
    return {k: v / row["n"] for k, v in load(bytes(row["model"])).items()}


def _in_group(key: tuple, table: pa.Table) -> pa.Table:
    out = _add_models(table)
    return out.set_column(0, "part", pa.array([key[0].as_py()], pa.int64()))


_MODEL = "part long, n long, model binary"


def co_train(lab: bytes, packed: DataFrame, rounds: int, hand_over: float, pool: int, moved: float = 0.0) -> tuple[dict, list]:
    """``lab``: the prepared labelled sample; ``packed``: every unlabelled document. The last model, and per round
    the limits of what each view handed over. ``moved``: by how much the sample's log odds differ from the labels'."""
    spark = packed.sparkSession
    held, y = spark.sparkContext.broadcast(lab), load(lab)
    good = y["y"][y["train"]].mean()
    good = good / (good + (1 - good) * np.exp(moved))
    models, limits, size = [], [], packed.count()
    n = int(hand_over * size)
    n_good = int(round(n * good))
    for r in range(rounds + 1):
        parts = max(1, -(-2 * n * r // pool))  # both views hand over n a round at most
        state = spark.sparkContext.broadcast((models, limits))
        rows = spark.range(parts).select(F.col("id").alias("part"), *(F.lit(-1).alias(k) for k in ("y0", "y1")), F.lit(0).cast("long").alias("tie"),
                                         *(F.lit(None).cast("binary").alias(k) for k in ("c", "x", "m")))
        if r and n:
            rows = rows.unionByName(packed.mapInArrow(_chosen(state, parts), _CHOSEN))
        fitted = cut(rows.groupBy("part").applyInArrow(_fit_part(held, parts), _MODEL), "cotraining")
        models = [*models, _mean_model(fitted, parts)]
        if r < rounds and n:
            state = spark.sparkContext.broadcast((models, limits))
            scored = cut(packed.mapInArrow(_scores(state), "tie long, q0 long, q1 long, f0 boolean, f1 boolean"), "scores")
            limits = [*limits, _limits(scored, n_good, n - n_good)]
    return models[-1], limits


def _calibrated(lab: dict, model: dict, moved: float) -> dict:
    """The whole classifier: the views' weights, their calibration and combination on the rows held out, put back
    to the labels' log odds."""
    y, hold = lab["y"], lab["hold"]
    st = np.bincount(lab["rows"], weights=lab["x"] * model["wt"][lab["cols"]], minlength=len(y)) + model["wt"][-1]
    sm = _meta_score(lab["m"], model["wm"])
    pt, pm = _platt(st[hold], y[hold]), _platt(sm[hold], y[hold])
    c = _combine(pt[0] * st[hold] + pt[1], pm[0] * sm[hold] + pm[1], y[hold])
    shift = np.array([0.0, moved])
    c = c - [0.0, 0.0, moved * (1 - c[0] - c[1])]  # the views are put back below
    pt, pm = pt - shift, pm - shift
    return {"t": lab["t"], "wt": model["wt"], "wm": model["wm"], "pt": pt, "pm": pm, "c": c}


def _constant(y: np.ndarray, moved: float) -> dict:
    share = float((y == 1).sum() / len(y)) if len(y) else 1.0
    none = np.zeros(0, U)
    return {"t": none, "wt": np.zeros(1), "wm": np.zeros(SLOTS + 1), "pt": np.zeros(2), "pm": np.zeros(2),
            "c": np.array([0.0, 0.0, np.log(max(share, 1e-9) / max(1 - share, 1e-9)) - moved])}


def _score(batch: pa.RecordBatch, m: dict, text: Vocabulary):
    st = np.full(batch.num_rows, m["wt"][-1])
    if len(text.hashes):
        for row0, n, row, h, x in _content(batch.column("text")):
            at, col = text.lookup(h)
            st[row0:row0 + n] += np.bincount(row[at], weights=x[at] * m["wt"][col], minlength=n)
    sm = _meta_score(_metadata(batch), m["wm"])
    lt, lm = m["pt"][0] * st + m["pt"][1], m["pm"][0] * sm + m["pm"][1]
    return sigmoid(lt), sigmoid(lm), sigmoid(m["c"][0] * lt + m["c"][1] * lm + m["c"][2])


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, pool: int = POOL,
                   rounds: int = ROUNDS, hand_over: float = HAND_OVER, threshold: float = 0.5, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                   chars_col: str = "n_chars") -> DataFrame:
    """(doc_id, content_score, metadata_score, score, kept) for every document."""
    spark = session(docs)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                      F.col(source_col).alias("source"), F.col(chars_col).cast("double").alias("n_chars"))
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("l_id")).agg((F.min(label_col) > 0).cast("int").alias("y")))
    chosen, moved = by_class(known, "y", sample)
    rows = (src.join(F.broadcast(cut(chosen, "sample")), F.col("doc_id") == F.col("l_id"))
            .select("y", "text", "lang", "source", "n_chars"))
    blob = bytes(cut(rows.mapInArrow(_featurise, _ROW).repartition(1).mapInArrow(_prepare, "model binary"), "labelled").first().model)
    lab = load(blob)
    if not _both(lab["y"]):
        model = _constant(lab["y"], moved)
    else:
        packed = cut(_free(src, known, blob), "packed")
        model = _calibrated(lab, co_train(blob, packed, rounds, hand_over, pool, moved)[0], moved)
    held = spark.sparkContext.broadcast(dump(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(held.value)
        text = Vocabulary(m["t"])
        for batch in batches:
            a, b, s = _score(batch, m, text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a), pa.array(b), pa.array(s),
                                              pa.array(s >= threshold)],
                                             names=["doc_id", "content_score", "metadata_score", "score", "kept"])

    return src.mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double, kept boolean")
