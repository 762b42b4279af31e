"""The whole pipeline in plain Python, stage by stage, against ``run()`` on a small corpus."""

import hashlib
import importlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from medallion.llm import mixing, quality
from medallion.llm.common import cut
from medallion.sinks.writers import write_parquet

WS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def prose(seed, n, vocab=3000):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        w = f"{x % vocab}".translate(str.maketrans("0123456789", "abcdefghij"))
        out.append(f"{w}é" if x % 5 == 0 else f"{w}v")
    return out


BENCH = [(1, " ".join(prose(901, 40))), (2, " ".join(prose(902, 25))), (3, None), (4, "too short")]


def corpus():
    docs = {}

    def put(i, text, lang="en", source="a"):
        docs[i] = (i, text, lang, source, len(text or ""))

    for k in range(70):
        ws = prose(k, 75)
        put(k, "\n".join([" ".join(ws[:30]), " ".join(ws[30:55]), " ".join(ws[55:])]).capitalize(), "en" if k % 3 else "de", f"s{k % 4}")
    for k in range(12):  # a line of twelve documents
        put(100 + k, "\n".join([" ".join(prose(200 + k, 40)), "  All Rights reserved here ", " ".join(prose(300 + k, 40))]), "en", "s1")
    for k, at in enumerate((0, 5, 9)):  # near copies
        ws = prose(7, 75)
        ws[at * 7] = "changed"
        put(140 + k, " ".join(ws), "en", "s2")
    put(150, docs[3][1], "en", "s9")
    put(151, docs[3][1].upper(), "en", "s9")
    item = prose(901, 40)
    put(160, " ".join(prose(401, 40) + item + prose(402, 20)), "en", "s1")
    put(161, " ".join(item[20:] + prose(403, 50) + item[:20]), "de", None)
    put(162, " ".join(prose(404, 60) + item[:18]), "en", "s1")  # too little of it
    put(163, ", ".join(w.upper() for w in prose(902, 25)) + ". " + " ".join(prose(405, 45)), None, "s1")
    for k in range(6):
        put(170 + k, " ".join(w + "***" for w in prose(500 + k, 80)), "en", f"s{k % 4}")
    put(180, "same words again " * 60)
    put(181, None, None, None)
    put(182, "", "en", None)
    put(183, "few words only")
    put(184, " ".join(prose(600, 6000)), "en", "s3")
    return list(docs.values())


# --- the stages ------------------------------------------------------------------------------

def stats(t):
    """Base counts and the fixed-point statistics."""
    w, t = words(t), t or ""
    lines = [x for x in t.split("\n") if words(x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    rep = len({i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)})
    chars, sym, dup = sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines))
    upper = sum("A" <= c <= "Z" for c in t)
    n, m = max(len(w), 1), max(chars, 1)
    s = (math.log(m / n), math.log1p(200 * sym / m), math.log1p(8 * dup / max(len(lines), 1)), math.log1p(8 * rep / n), math.log1p(8 * upper / m))
    return len(w), rep, np.array([round(v * quality.SCALE) for v in s])


def median(v):
    return sorted(v)[math.ceil((len(v) + 1) / 2) - 1]


def minimum_determinant(rows, min_rows=quality.MIN_ROWS):
    """d2 per row: (lang, source, statistics) in, by concentration steps in numpy."""
    n = Counter((lang, src) for lang, src, _ in rows)
    by_lang = defaultdict(list)
    for (lang, _), c in n.items():
        by_lang[lang].append(c)
    pooled = {lang for lang, c in by_lang.items() if min(c) < min_rows}
    whole = any(sum(by_lang[lang]) < min_rows for lang in pooled)
    groups = defaultdict(list)
    for lang, src, s in rows:
        for key in [(0, lang, src)] + [(1, lang, None)] * (lang in pooled) + [(2, None, None)] * whole:
            groups[key].append(s)
    groups = {k: np.array(v) for k, v in groups.items()}
    raw = {}
    for key, v in groups.items():
        b = np.floor(v * 32 / quality.SCALE) / 32
        mean = np.array([median(c) for c in b.T])
        raw[key] = len(v), mean, np.diag([(1.4826 * median(np.abs(c - m))) ** 2 for c, m in zip(b.T, mean)])

    def shrunk():
        out = {}
        for key, (size, mean, cov) in raw.items():
            def towards(own, size, above):
                share = min(1.0, size / min_rows)
                return own if above is None or share == 1 else tuple(share * a + (1 - share) * b for a, b in zip(own, above))
            top = raw.get((2, None, None))
            above = top and top[1:]
            if key[0] == 0:
                lang = raw.get((1, key[1], None))
                above = towards(lang[1:], lang[0], above) if lang else None
            out[key] = (mean, cov) if key[0] == 2 else towards((mean, cov), size, above)
        return out

    def d2(v, model):
        d = v / quality.SCALE - model[0]
        inv = np.linalg.inv(model[1] + np.diag(np.square(quality.MIN_SCALE)))
        return np.einsum("ij,jk,ik->i", d, inv, d)

    for k in range(quality.STEPS + 1):
        models = shrunk()
        for key, v in groups.items():
            b = np.floor(np.log2(np.maximum(d2(v, models[key]), 1e-6)) * 8)
            if k == quality.STEPS:
                core = b <= math.floor(math.log2(quality._REWEIGHT) * 8)
                factor = quality._FACTOR_REWEIGHT
            else:
                need, core = math.ceil(quality.CORE * len(v)), np.zeros(len(v), bool)
                for x in np.unique(b):
                    if core.sum() < need:
                        core |= b == x
            if not core.any():
                core = b == b.min()
            share = core.mean()
            if k < quality.STEPS:
                factor = share / quality._chi2_cdf(quality.chi2_quantile(min(share, 1 - 1e-9), 5), 7)
            c = v[core].astype(float)
            mean = c.mean(0)
            raw[key] = len(v), mean / quality.SCALE, factor * (c.T @ c / len(c) - np.outer(mean, mean)) / quality.SCALE ** 2
    models = shrunk()
    return [float(d2(s[None], models[0, lang, src])[0]) for lang, src, s in rows]


def by_quality(docs):
    counted = [stats(d[1]) for d in docs]
    d2 = minimum_determinant([(d[2], d[3], c[2]) for d, c in zip(docs, counted)])
    return [d for d, (n, rep, _), x in zip(docs, counted, d2) if n >= 50 and 100 * rep <= 50 * n and x <= quality.CUTOFF]


def by_lines(docs):
    key = lambda x: lower(x.strip(WS))
    n = Counter(k for d in docs for k in {key(x) for x in (d[1] or "").split("\n")} if k)
    out = []
    for d in docs:
        lines = (d[1] or "").split("\n")
        left = [x for x in lines if not (key(x) and n[key(x)] >= 10)]
        out.append((d[0], "\n".join(left), *d[2:4], len("\n".join(left))) if len(left) < len(lines) else d)
    return out


def by_copies(docs):
    sets = []
    for d in docs:
        w = words(lower(d[1]))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    first = {}
    for a, d in enumerate(docs):
        first[find(a)] = min(first.get(find(a), d[0]), d[0])
    return [d for a, d in enumerate(docs) if not sets[a] or first[find(a)] == d[0]]


def bare(t):
    edge = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
    return [w for w in (x.strip(edge) for x in words((t or "").lower())) if w]


def coverage(item, doc, m=5):
    iu, du, total = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not iu[i + k] and not du[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        if best[0] < m:
            return total / max(1, len(item))
        n, i, j = best[0], -best[1], -best[2]
        iu[i:i + n], du[j:j + n] = [True] * n, [True] * n
        total += n


def by_benchmark(docs):
    items = [bare(t) for _, t in BENCH if t and len(bare(t)) >= 5]
    return [d for d in docs if all(coverage(item, bare(d[1])) < 0.6 for item in items)]


def mixed(docs):
    by = defaultdict(list)
    for d in docs:
        by[d[3]].append((hashlib.md5(str(d[0]).encode()).hexdigest(), d[0], len(words(d[1])), d))
    order = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    size = {s: sum(x[2] for x in by[s]) for s in order}
    target, left, free = {}, 1.5 * sum(size.values()), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if 2 * size[s] < level * weight[s]} or None
        for s in over or free:
            target[s] = 2.0 * size[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        free -= over
    out = []
    for k, s in enumerate(order):
        a, b = mixing.DEFAULT_SCHEDULE[k % 3]
        at, full = 0, int(target[s] // size[s])
        for _, _, n, d in sorted(by[s], key=lambda x: x[:3]):
            for e in range(full + 1):
                took = n if e < full else max(0, min(n, math.floor(target[s] - full * size[s]) - at))
                u = min(1.0, (e * size[s] + at) / target[s])
                # the weight a + (b - a) t, integrated and inverted by bisection
                lo, hi = 0.0, 1.0
                for _ in range(60):
                    t = (lo + hi) / 2
                    lo, hi = (t, hi) if a * t + (b - a) * t * t / 2 < u * (a + b) / 2 else (lo, t)
                if took > 0:
                    out.append((*d, e, round(lo, 6), took))
            at += n
    return out


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_every_stage_and_the_whole_run(spark, pipeline, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus()
    write_parquet(spark.createDataFrame(rows, SCHEMA).repartition(4), f"{sf}/documents.parquet")
    write_parquet(spark.createDataFrame(BENCH, "item_id long, text string"), f"{sf}/benchmark.parquet")
    plain = [by_quality, by_lines, by_copies, by_benchmark]
    docs, left = spark.read.parquet(f"{sf}/documents.parquet"), rows
    for (name, stage), brute in zip(pipeline.STAGES[:-1], plain):
        docs, before, left = cut(stage(spark, docs, sf), f"test-{name}"), left, brute(left)
        assert Counter(map(tuple, docs.collect())) == Counter(left), name
        assert Counter(left) != Counter(before), name  # each stage has something to do
    got = Counter((*r[:5], r.epoch, round(r.position, 6), r.words_taken) for r in pipeline.run(spark, sf).collect())
    want = Counter(mixed(left))
    near = {(*k[:6], k[7]): k[6] for k in want}
    assert sum(got.values()) == sum(want.values())
    for k in got:
        assert abs(near[(*k[:6], k[7])] - k[6]) < 1e-5
