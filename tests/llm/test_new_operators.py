"""Operators 11 to 13 against plain Python, with every awkward case."""

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import collocations as C
from medallion.llm import conversations as V
from medallion.llm.license_join import BASE_PHRASES, TEMPLATES, license_scan

DOCS = "doc_id long, text string, lang string, source string, n_words int, labels string, word string, n int, score string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "clash", "w", 2, "x") for i, t, lang in rows], DOCS).repartition(5)


# --- 11: license scans ----------------------------------------------------------------

def lic_words(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def lic_brute(text, threshold=80):
    w = lic_words(text)
    places, base = [], set()
    for phrase, label in BASE_PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    sets = [(label, set(lic_words(t))) for label, t in TEMPLATES]
    step = max([32] + [len(lic_words(t)) for _, t in TEMPLATES])
    labels, score = set(base), 0.0
    for i in range(0, len(w), step):
        block = set(w[i:i + 2 * step])
        for label, t in sets:
            if 100 * len(block & t) >= threshold * len(t):
                labels.add(label)
                score = max(score, len(block & t) / len(t))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


def lic_texts():
    rng = random.Random(3)
    filler = [f"wörd{n}" for n in range(50)] + ["the", "of", "under", "license", "public", "a", "to", "is"]

    def fill(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    out = [None, "", " \n", "MIT", "mit license", "MIT-License mit_license", "general public license general public license"]
    for _, t in TEMPLATES:
        ws = t.split()
        for drop in (0, 1, 2, 3, 5):
            kept = [w for i, w in enumerate(ws) if i not in set(rng.sample(range(len(ws)), min(drop, len(ws))))]
            out.append(f"{fill(rng.randrange(90))}\n{' '.join(kept).upper()} {fill(rng.randrange(90))}")
            out.append("\n".join(kept) + "\n" + fill(20))
        rng.shuffle(ws)
        out.append(" ".join(ws))
    out += [fill(5000) + " Licensed under CC BY-NC 4.0. " + fill(3000), "é" * 40 + "license", "apache\x00license apache\x7flicense"]
    return out


def test_license_scan_equals_all_pairs(spark):
    texts = lic_texts()
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, texts[10], "en"), (3, texts[3], None), (3, "other text", None)]
    got = license_scan(docs(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()
    want = Counter((i, *lic_brute(t)) for i, t, _ in rows)
    assert Counter(tuple(r) for r in got) == want
    assert len({w[6] for w in want}) > 5


def test_license_scan_of_other_templates_and_thresholds(spark):
    one = [("x", "alpha beta"), ("y", "alpha"), ("z", "alpha beta gamma delta epsilon")]
    got = license_scan(docs(spark, [(1, "alpha gamma beta", "en"), (2, "beta delta alpha epsilon", "en"), (3, "eta", "en")]), templates=one)
    assert {r.doc_id: (r.labels, r.score) for r in got.collect()} == {1: ("x,y", 1.0), 2: ("x,y,z", 1.0), 3: ("", 0.0)}
    assert license_scan(docs(spark, []), templates=one).count() == 0
    none = license_scan(docs(spark, [(1, "mit license", "en")]), templates=[]).first()
    assert (none.labels, none.base_labels, none.n_base, none.score) == ("mit", "mit", 1, 0.0)


# --- 12: collocations ------------------------------------------------------------------

def col_brute(rows, least, top):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    cands = {x: a for x, a in f.items() if len(x[1]) >= 2 and a >= least}
    inner = Counter()
    for (lang, p), a in cands.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner[lang, p[i:i + k]] = max(inner[lang, p[i:i + k]], a)
    out = {}
    for (lang, p), a in cands.items():
        if inner[lang, p] >= a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, c in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(c)[:top], 1)}


def col_rows():
    rng = random.Random(5)
    vocab = ["a", "B", "c", "straße", "d\x1fe", "1", "É", "f"]
    rows = []
    for k in range(300):
        ws = [rng.choice(vocab) if rng.random() < 0.8 else f"r{rng.randrange(300)}" for _ in range(rng.randrange(0, 60))]
        sep = [rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  ", "\r\n", ":"]) for _ in ws]
        rows.append(("".join(w + s for w, s in zip(ws, sep)), rng.choice(["en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", "en"), ("x y z " * 500, "fr"), ("one two three four five six. " * 40, "en"), ("A b C D E F" * 30, None)] * 2
    return rows


@pytest.mark.parametrize("shared", [C.MOST_SHARED, 20, 0])
def test_collocations_equal_counting_all(spark, monkeypatch, shared):
    monkeypatch.setattr(C, "MOST_SHARED", shared)  # with both arrays shared, the words alone, and neither
    rows = col_rows()
    df = docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)])
    got = C.collocations(df, least=20, top=30)
    assert got.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == col_brute(rows, 20, 30)


def test_collocations_of_nothing(spark):
    assert C.collocations(docs(spark, []), least=2).count() == 0
    assert C.collocations(docs(spark, [(1, None, None), (2, "a b c", "en")]), least=2).count() == 0


def test_shared_entries_reach_the_driver_packed(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 1 << 16)  # several pieces
    n, arrow = 300_000, "spark.sql.execution.arrow.pyspark.enabled"
    old = spark.conf.get(arrow)
    df = C.session(spark.range(1)).range(0, n, 1, 7).select((F.col("id") * 7919 % n - 5).alias("pair"), F.lit("x").alias("word"))
    C._shared(df.limit(3), "pair", 3)  # what is imported at first use does not count
    spark.conf.set(arrow, "false")  # Spark's own default
    tracemalloc.start()
    try:
        shared = C._shared(df, "pair", n)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(arrow, old)
    assert peak < 3 * 8 * n  # the array and a piece; as rows they took over ten times the array
    assert (shared.value == np.arange(n) - 5).all()


def test_nothing_shared_is_an_empty_array(spark):
    assert C._shared(spark.range(0).withColumnRenamed("id", "pair"), "pair", 0).value.tolist() == []
    with pytest.raises(RuntimeError, match="3 of 4 entries"):
        C._shared(C.session(spark.range(1)).range(3).withColumnRenamed("id", "pair"), "pair", 4)


def test_words_with_one_hash_are_told_apart(spark, monkeypatch):
    plain = C._stretches

    def clash(batch, seed):
        for data, s, e, piece, key, row in plain(batch, seed):
            yield data, s, e, piece, (key % 3 if seed == 0 else key), row

    monkeypatch.setattr(C, "_stretches", clash)
    monkeypatch.setattr(C, "session", lambda df: None)
    seeds = []
    monkeypatch.setattr(C, "_count_words", lambda seed, made=C._count_words: (seeds.append(seed), made(seed))[1])
    rows = [(i, t, "en") for i, t in enumerate(["a b", "b c", "c d", "d e", "e a"] * 3)]
    assert C.collocations(docs(spark, rows), least=3).count() >= 0
    assert seeds[0] == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, big + 7, big + 1, big + 3)], "a long, n_words long, l long, r long")
    got = df.select(F.expr("(cast(a as decimal(38,0)) * cast(n_words as decimal(38,0)) * cast(1000 as decimal(4,0))) div "
                           "(cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")).first()[0]
    assert got == 1000 * big * (big + 7) // ((big + 1) * (big + 3))


# --- 13: conversations --------------------------------------------------------------------

WS = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def conv_brute(rows, at_most=2):
    """All edit sequences with at most two insertions in a row, by enumeration."""
    bad = faults(rows)
    per_row = []
    for (role, text), fault in zip(rows, bad):
        extra = 3 if fault == "truncated" else 0
        ways = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            ways += [("K", extra, [(role, text)]), ("R", 3 + extra, [("user", text)]), ("R", 3 + extra, [("assistant", text)])]
        per_row.append(ways)
    inserts = [("I" * m, 3 * m, [(r, "") for r in roles]) for m in range(at_most + 1)
               for roles in itertools.product(("user", "assistant"), repeat=m)]
    slots = [inserts]
    for ways in per_row:
        slots += [ways, inserts]
    best = None
    for choice in itertools.product(*slots):
        said = [m for c in choice for m in c[2]]
        if all(r for r, _ in said) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said)):
            key = (sum(c[1] for c in choice), "".join(c[0] for c in choice), said)
            best = key if best is None or key[:2] < best[:2] else best
    return best


def conv_slow(rows):
    """From the end: per state the cheapest (cost, letters), as pairs instead of numbers."""
    bad = faults(rows)
    nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    inf = (10 ** 9, "")
    best = {q: (0, "") if q in ("", "a") else inf for q in ("", "s", "u", "a")}

    def close(b):
        for _ in range(3):
            b = {q: min([v] + [(3 + b[t][0], "I" + b[t][1]) for (p, x), t in nxt.items() if p == q and x in "ua"]) for q, v in b.items()}
        return b

    best = close(best)
    for (role, _), fault in reversed(list(zip(rows, bad))):
        extra = 3 if fault == "truncated" else 0
        new = {}
        for q in best:
            ways = [(4 + best[q][0], "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                for (p, x), t in nxt.items():
                    if p == q and x == role[:1]:
                        ways.append((extra + best[t][0], "K" + best[t][1]))
                    if p == q and x in "ua":
                        ways.append((3 + extra + best[t][0], "R" + best[t][1]))
            new[q] = min(ways)
        best = close(new)
    return best[""]


def conversation(rows):
    said = []
    conv = V.Conversation(lambda e, r, t: said.append((r, t)))
    for i, (role, text) in enumerate(rows):
        conv.add(i, role, text)
    return conv.close(), said


ROLES = ["system", "user", "assistant", "tool", " ", ""]
TEXTS = ["Yes.", "No!", "cut", "", " \n", "Why?", "a.b"]


def test_repair_equals_enumeration():
    rng = random.Random(1)
    for _ in range(150):
        rows = [(rng.choice(ROLES[:4] if rng.random() < 0.9 else ROLES), rng.choice(TEXTS)) for _ in range(rng.randrange(0, 4))]
        got, said = conversation(rows)
        cost, audit, repaired = conv_brute(rows)
        assert (got["cost"], got["audit"], said) == (cost, audit, repaired), rows


@pytest.mark.parametrize("block", [1, 2, 7, 128])
def test_long_conversations_equal_the_pairwise_recursion(monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(60):
        n = rng.randrange(0, 90)
        weights = rng.choice([[1, 5, 5, 1, 0, 0], [1, 1, 1, 1, 1, 1], [0, 9, 9, 0, 0, 0], [5, 1, 1, 0, 0, 0], [0, 0, 1, 0, 0, 0]])
        rows = [(rng.choices(ROLES, weights)[0], rng.choice(TEXTS) + (f" {i}." if rng.random() < 0.7 else "")) for i in range(n)]
        got, said = conversation(rows)
        assert (got["cost"], got["audit"]) == conv_slow(rows)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said))


def test_a_very_long_conversation_holds_little():
    held = 0
    conv = V.Conversation(lambda e, r, t: None)
    rng = random.Random(2)
    for i in range(20000):
        conv.add(i, rng.choice(["user", "assistant", "assistant", "user", "system"]), f"message {i}" + rng.choice([".", ""]))
        held = max(held, len(conv.rows))
    assert held < 1000 and len(conv.close()["audit"]) >= 20000


CONV = "conv_id long, turn long, role string, text string, cost string, audit int"


def conv_table():
    rng = random.Random(9)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t * rng.choice([1, 1, 2]) if rng.random() < 0.95 else None, rng.choice(ROLES[:3] + [None]),
                         rng.choice(TEXTS + [None, f"Long {'x' * 3000} {c}."])))
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), rows[0], rows[0], (900, None, "user", "Hi."), (900, None, "assistant", "Ho.")]
    lost = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    return [*rows, (lost, 1, "user", "Gone.")]


def damage(rows):
    out = {}
    for c, t, role, text in rows:
        group = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        group += [(t, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def test_repair_of_tables(spark):
    rows = conv_table()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], CONV).repartition(7)
    got = {r.conv_id: r for r in V.repair_summary(V.damaged(df)).collect()}
    said = {}
    for r in V.repair_messages(V.damaged(df)).orderBy("position").collect():
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = damage(rows)
    assert set(got) == set(want)
    assert any(not v for v in want.values())
    for c, group in want.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        pairs = [(role, text) for _, role, text in group]
        bad = Counter(faults(pairs))
        turns = [t for t, _, _ in group if t is not None]
        r = got[c]
        cost, audit = conv_slow(pairs) if pairs else (0, "")
        assert (r.cost, r.audit) == (cost, audit)
        assert (r.blank, r.duplicate, r.truncated) == (bad["blank"], bad["duplicate"], bad["truncated"])
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(said.get(c, [])).encode()).hexdigest()
    empty = spark.createDataFrame([], CONV)
    assert V.repair_summary(V.damaged(empty)).count() == 0 and V.repair_messages(empty).count() == 0
