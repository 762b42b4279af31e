"""The training-data operators against plain Python, on small tables with every awkward case."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from medallion.llm import mixing, quality
from medallion.llm.components import components
from medallion.llm.cotraining import quality_scores
from medallion.llm.decontaminate import contaminated_pairs, tile
from medallion.llm.jaccard import near_duplicates, representatives
from medallion.llm.line_dedup import line_dedup
from medallion.llm.substring_dedup import substring_dedup
from medallion.llm.token_count import Counter as TokenCounter
from medallion.llm.token_count import token_counts
from medallion.llm.toxicity import severity
from medallion.llm.url_filter import url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int"
WS = " \t\n\x0b\x0c\r"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def prose(seed, n, vocab=400):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{x % vocab}é" if x % 5 == 0 else f"v{x % vocab}")
    return out


def rows():
    base = prose(1, 120)
    near = list(base)
    near[60] = "changed"
    shared = "  A Common\tLine \r"
    texts = [" ".join(base), " ".join(base), " ".join(near), " ".join(base).upper(), None, "", " \n\t ", "one", "One", "two words",
             "\n".join([" ".join(prose(2, 30)), shared, " ".join(prose(3, 30))]), "Orre " * 300, "x " * 34 + "x",
             "\x85odd space " * 40, "# * $ | <>& " * 20, " ".join(prose(4, 6000)), "same line\nsame line\n\nsame line"]
    texts += [f"{' '.join(prose(20 + k, 15))}\n{shared.strip().lower()}\n{' '.join(prose(50 + k, 60))}" for k in range(12)]
    out = [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, len(t or ""), "clash", k) for k, t in enumerate(texts)]
    out += [(None, texts[0], "en", "s1", 1, "c", 1), (None, None, None, None, None, None, None), out[0], out[10], (7, "other text of a known id", "en", "s1", 3, "", 0)]
    return out


@pytest.fixture(scope="module")
def data():
    return rows()


@pytest.fixture()
def docs(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (20, 20), (30, 31), (30, 32), (None, 3)] + [(100, k) for k in range(101, 160)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "src long, dst long")).collect())
    want = {1: 1, 2: 1, 3: 1, 30: 30, 31: 30, 32: 30} | {k: 4 for k in range(4, 10)} | {k: 100 for k in range(100, 160)}
    assert got == want
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_jaccard(data):
    sets = []
    for r in data:
        w = words(lower(r[1]))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(data)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for a in range(len(data)):
        ids[find(a)].append(data[a][0])
    return Counter((r[0], len(sets[a]), min((i for i in ids[find(a)] if i is not None), default=None) if sets[a] else r[0])
                   for a, r in enumerate(data))


def test_jaccard_join(docs, data, empty):
    out = near_duplicates(docs)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
    assert got == brute_jaccard(data)
    kept = Counter((r.component_id, r.doc_id) for r in out.filter("set_id IS NOT NULL AND kept").dropDuplicates(["doc_id", "text_key"]).collect())
    assert all(a == b for a, b in kept) and set(kept) == {(r.component_id,) * 2 for r in out.filter("set_id IS NOT NULL").collect()}
    assert near_duplicates(empty).count() == 0


def test_jaccard_large_near_copy_group(spark):
    """Many near copies around the threshold: the first links leave several components, the
    blocks settle the rest."""
    base, data = prose(5, 100), []
    for k in range(90):
        w = list(base)
        for j in range(k % 4 + (3 if k % 7 == 0 else 0)):
            w[(k * 31 + j * 17) % 100] = f"u{k}x{j}"
        data.append((k, " ".join(w)))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect())
    assert got == brute_jaccard(data)


def test_mixing(docs, data, empty):
    plan = mixing.mix_plan(docs).collect()
    assert Counter(r.size for r in plan) == Counter(len(words(r[1])) for r in data)
    by = defaultdict(list)
    for r in plan:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
    total = sum(r.size for r in plan)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    want = dict.fromkeys(order, 0.0)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    cap = {s: 2.0 * sum(r.size for r in by[s]) for s in order}
    left, free = 1.5 * total, set(order)
    while free:  # share by weight, stop at the cap, share the excess again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if cap[s] < level * weight[s]}
        if not over:
            want |= {s: level * weight[s] for s in free}
            break
        want |= {s: cap[s] for s in over}
        left -= sum(cap[s] for s in over)
        free -= over
    for s in order:
        assert by[s][0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in by[s]) - want[s]) <= 1
    assert sorted(map(str, plan)) == sorted(map(str, mixing.mix_plan(docs.repartition(3)).collect()))
    t = mixing.training_order(docs)
    assert "kept" in t.columns and t.agg(F.sum("words_taken")).first()[0] <= sum(r.taken for r in plan) + 1
    assert mixing.mix_plan(empty).count() == 0 and mixing.training_order(empty).count() == 0


def test_token_counts(docs, data, empty):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(P.path("byte_bpe_50k.json"))
    tok = Tokenizer.from_file(path)
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    got = Counter(tuple(r) for r in token_counts(docs, path, chunk=900, overlap=40).collect())
    want = Counter((r[0], len((r[1] or "").encode()), n(r[1] or ""), n(r[1] or "") > 1024) for r in data)
    assert got == want
    assert token_counts(empty, path).count() == 0
    c = TokenCounter(path, chunk=50, overlap=8)
    odd = ["a" * 700, "  \n\n  x" * 90, "ab <|endoftext|> cd" * 30, "<|endoftext|>" * 40, " " * 400, "é　 ü\x1f  ß" * 60,
           "I'll we've 12345 !!!???" * 20, "\n" * 300 + "end", "x\xa0 y " * 60, "日本語のテキスト" * 40]
    assert c.counts(odd) == [n(t) for t in odd]
    assert TokenCounter(path).counts(odd) == [n(t) for t in odd]


def brute_quality(t):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))


def test_quality_counts(docs, data, empty):
    t = quality.quality_table(docs, min_rows=5)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in t.collect())
    want = Counter()
    for r in data:
        b = brute_quality(r[1])
        want[(r[0], *b, b[0] < 50 or 100 * b[4] > 50 * b[0])] += 1
    assert got == want
    assert t.filter("base_failed AND kept").count() == 0
    full = quality.quality_rules(docs, min_rows=5)
    assert Counter((r.doc_id, r.n_words, r.kept) for r in full.collect()) == Counter((r.doc_id, r.n_words, r.kept) for r in t.collect())
    assert quality.quality_table(empty).count() == 0 and quality.quality_rules(empty).count() == 0


def test_quality_outliers(spark):
    """Clean documents stay and each kind of junk goes, also when a quarter of a group is junk."""
    clean = [(k, " ".join(prose(k, 80, 3000)).capitalize(), "en", "a") for k in range(240)]
    junk = [(1000 + k, " ".join(x + "***" for x in prose(k + 500, 80, 3000)), "en", "a") for k in range(30)]
    junk += [(2000 + k, " ".join(x.upper() * 2 + "!!" for x in prose(k + 700, 80, 3000)), "en", "a") for k in range(30)]
    letters = str.maketrans("0123456789", "abcdefghij")
    clean, junk = ([(i, t.translate(letters), *x) for i, t, *x in rows_] for rows_ in (clean, junk))
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.quality_table(df, min_rows=50).filter("kept").collect()}
    assert not any(k >= 1000 for k in kept) and len(kept) >= 235
    assert quality.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)


def test_quality_small_groups_get_a_verdict(spark):
    """Sources of five documents and a language of six are judged, not passed; clean ones stay."""
    letters = str.maketrans("0123456789", "abcdefghij")
    text = lambda k: " ".join(prose(k, 80, 3000)).translate(letters)
    junk = lambda k: " ".join(x.upper() + "***" for x in text(k).split(" "))
    data = [(k, text(k), "en", f"s{k % 24}") for k in range(120)] + [(1000 + k, junk(k + 300), "en", f"s{5 * k}") for k in range(4)]
    data += [(200 + k, text(k + 400), "rare", f"r{k % 2}") for k in range(5)] + [(1100, junk(500), "rare", "r0"), (1101, junk(501), None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.quality_table(df).filter("kept").collect()}
    assert kept == {r[0] for r in data if r[0] < 1000}
    assert kept == {r.doc_id for r in quality.quality_rules(df).filter("kept").collect()}


def test_substring_dedup(docs, data, empty):
    where = defaultdict(list)
    for a, r in enumerate(data):
        w = words(r[1])
        for i in range(len(w) - 34):
            where[tuple(w[i:i + 35])].append((a, i))
    gone = defaultdict(set)
    for places in where.values():
        if len(places) > 1:
            for a, i in places:
                gone[a].update(range(i, i + 35))
    want = Counter((r[0], len(words(r[1])), len(gone[a]), sha(" ".join(x for i, x in enumerate(words(r[1])) if i not in gone[a])))
                   for a, r in enumerate(data))
    out = substring_dedup(docs)
    assert "kept" in out.columns
    got = Counter((r.doc_id, r.n_words, r.n_removed, sha(r.text or "")) for r in out.collect())
    assert got == want
    assert substring_dedup(empty).count() == 0


def test_line_dedup(docs, data, empty):
    key = lambda x: lower(x.strip(WS))
    n = Counter(k for r in data for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    want = Counter()
    for r in data:
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if not (key(x) and n[key(x)] >= 10)]
        want[(r[0], len(lines), len(lines) - len(left), sha("\n".join(left)))] += 1
    out = line_dedup(docs)
    assert sum(x[2] * c for x, c in want.items()) >= 12
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, sha(r.text or "")) for r in out.collect()) == want
    assert line_dedup(empty).count() == 0


def brute_tiles(item, doc, m):
    tiles, iu, du = [], [False] * len(item), [False] * len(doc)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not iu[i + k] and not du[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < m:
            return tiles
        n, i, j = best
        tiles.append(best)
        iu[i:i + n] = [True] * n
        du[j:j + n] = [True] * n


def test_string_tiling():
    import numpy as np
    for seed in range(6):
        item, doc = prose(seed, 40, 6), prose(seed + 1, 150, 6) + prose(seed, 40, 6)[10:30]
        i, j = zip(*[(a, b) for a in range(len(item) - 2) for b in range(len(doc) - 2) if item[a:a + 3] == doc[b:b + 3]], strict=True)
        assert tile(np.array(i), np.array(j), len(item), 3) == brute_tiles(item, doc, 3)


def test_decontaminate(spark, docs, empty):
    item = prose(77, 40, 5000)
    other = prose(78, 30, 5000)
    planted = [(900, " ".join(prose(9, 60, 5000) + item + prose(8, 20, 5000))), (901, " ".join(item[20:] + prose(9, 30, 5000) + item[:20])),
               (902, " ".join(item[:18])), (903, ", ".join(x.upper() for x in other) + "."), (None, " ".join(item)), (904, " ".join(prose(6, 90, 5000)))]
    more = spark.createDataFrame([(i, t, "en", "s", 0, "", 0) for i, t in planted], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other)), (3, None), (4, "too short"), (None, " ".join(prose(79, 20, 5000)))],
                                  "item_id long, text string")
    for block in (8 << 20, 300):
        got = {(r.doc_id, r.item_id): (round(r.coverage, 6), r.n_tiles) for r in contaminated_pairs(docs.unionByName(more), bench, block_bytes=block).collect()}
        assert got == {(900, 1): (1.0, 1), (901, 1): (1.0, 2), (903, 2): (1.0, 1), (None, 1): (1.0, 1)}
    assert contaminated_pairs(empty, bench).count() == 0 and contaminated_pairs(docs, bench.limit(0)).count() == 0


def test_url_filter(spark, monkeypatch):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "com/de/"), ("block", "bad.net/")]
    link = '<link href="{}" rel=canonical><LINK REL="Canonical" HREF=\'{}\'>'
    pages = [(1, "http://A.Example.org/es/1?x#y", None), (2, "https://x.org", ""), (3, "nothing", link.format("z", "http://bad.net/")),
             (4, None, None), (5, "http://c.net/p", link.format("http://bad.net/x", "ignored")), (6, "http://d.net/q", '<meta http-equiv="refresh" content="0; url=/r">'),
             (7, "http://d.net/r", '<meta http-equiv=refresh content="1;URL=http://c.net/p">'), (8, "http://e.net/", '<link rel="canonical" href="//f.org/ok">'),
             (9, "http://f.org/ok", '<link rel="canonical" href="https://bad.net/z">'), (10, "http://com/de/", None), (11, "http://notcom/de/", None), (None, "http://g.net/", None),
             (1, "http://A.Example.org/es/1?x#y", None)]
    out = url_filter(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out)
    assert got == Counter([(1, "a.example.org", "/es/1", "example.org/es/", "block")] * 2 + [
        (2, "x.org", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "c.net", "/p", None, "block"),
        (6, "d.net", "/q", None, "block"), (7, "d.net", "/r", None, "block"), (8, "e.net", "/", None, "allow"), (9, "f.org", "/ok", "org/", "allow"),
        (10, "com", "/de/", "com/de/", "block"), (11, "notcom", "/de/", None, "allow"), (None, "g.net", "/", None, "allow")])
    # as a table of rules, beyond the literal: the same, with rules of both verdicts and none that fits
    from medallion.llm import url_filter as U
    monkeypatch.setattr(U, "LITERAL_RULES", 2)
    again = url_filter(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
    both = url_filter(spark.createDataFrame(pages[:2], "page_id long, url string, html string"),
                      [("block", "org/"), ("allow", "org/"), ("block", "zzz/")]).collect()
    assert {(r.rule, r.verdict) for r in both} == {("org/", "allow"), (None, "allow")}  # the second has no path
    assert url_filter(spark.createDataFrame([], "page_id long, url string, html string"), rules).count() == 0


def test_models_on_held_out_labels(spark, sf, empty):
    """Accuracy on labelled documents that were not in the sample."""
    big = sf.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    seen = labels.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(2000)
    rest = labels.join(seen, "doc_id", "left_anti")
    tox = severity(docs, labels, sample=2000).withColumnRenamed("toxic", "found").join(rest, "doc_id")
    n = {(r.toxic, r.found): r["count"] for r in tox.groupBy("toxic", "found").count().collect()}
    assert n.get((1, True), 0) >= 0.9 * (n.get((1, True), 0) + n.get((1, False), 0)) and n.get((0, True), 0) <= 0.02 * n[(0, False)]
    q = quality_scores(docs, labels, sample=2000, pool=1500).join(rest, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in q.groupBy("quality", "kept").count().collect()}
    assert n[(1, True)] >= 0.97 * (n[(1, True)] + n.get((1, False), 0)) and n[(0, False)] >= 0.8 * (n[(0, False)] + n.get((0, True), 0))
    assert severity(empty, labels).count() == 0 and quality_scores(empty, labels).count() == 0
    none = labels.limit(0)
    assert severity(docs.limit(5), none).filter("toxic").count() == 0
    assert quality_scores(docs.limit(5), none).filter("NOT kept").count() == 0


def test_cotraining_sees_every_unlabelled_document(spark):
    """Pseudo-labels come from the whole corpus, not from ``pool`` documents: sources that only unlabelled documents
    have each get a metadata weight, also where the fit takes several parts."""
    text = lambda k: " ".join(x.upper() + "!!" if k % 2 else x + "aa" for x in prose(k, 60, 300))  # noqa: E731  (equally long)
    data = [(k, text(k), "en", f"s{k % 4}") for k in range(200)] + [(1000 + k, text(k + 300), "en", f"new{k % 60}") for k in range(600)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.lit(0)).repartition(3)
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(200)], "doc_id long, quality int")
    out = quality_scores(df, labels, pool=50, hand_over=0.3).collect()
    assert all(r.kept == (r.doc_id % 2 == 0) for r in out)
    by = defaultdict(list)
    for r in out:
        if r.doc_id >= 1000:
            by[r.doc_id % 60].append(r.metadata_score)
    mean = {k: sum(v) / len(v) for k, v in by.items()}
    assert min(v for k, v in mean.items() if k % 2 == 0) > max(v for k, v in mean.items() if k % 2)


def test_rare_class_is_sampled(spark):
    """Ten bad documents among 600 labelled ones are fitted on, though the bound is 60."""
    text = lambda k: " ".join(prose(k, 60, 300) + ["vile", "nasty!!", "BAD!!"] * (4 if k % 60 == 7 else 0))
    data = [(k, text(k), "en", f"s{k % 4}", 0) for k in range(900)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 60 != 7), int(k % 60 == 7)) for k in range(600)], "doc_id long, quality int, toxic int")
    bad = {k for k in range(900) if k % 60 == 7}
    assert {r.doc_id for r in severity(df, labels, sample=60).filter("toxic").collect()} == bad
    assert {r.doc_id for r in quality_scores(df, labels, sample=60).filter("NOT kept").collect()} == bad


def test_models_accept_awkward_rows(spark, docs, data):
    labels = spark.createDataFrame([(k, k % 2, k % 3 == 0) for k in range(30)] + [(None, 1, True), (999, 0, False), (3, None, None)],
                                   "doc_id long, quality int, t boolean").withColumn("toxic", F.col("t").cast("int"))
    assert severity(docs, labels).count() == len(data)
    assert quality_scores(docs, labels).count() == len(data)


def test_training_order_keeps_the_plan_of_every_source(spark):
    rows = [(i, " ".join(prose(i + 1, 60)), "en", s, 1, "clash", 7) for s in ("a", "b") for i in range(40)]
    rows += [(3, rows[3][1], "en", "a", k, "other", 8) for k in range(6)] + [(None, "no id " * 9, "en", None, 1, "", 0)] * 5
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    planned, ordered = defaultdict(int), defaultdict(int)
    for r in mixing.mix_plan(df).collect():
        planned[r.source] += r.taken
    out = mixing.training_order(df).collect()
    for r in out:
        ordered[r.source] += r.words_taken
    assert dict(planned) == dict(ordered)
    again = mixing.training_order(df.repartition(3)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_representatives_agree_whatever_the_partitioning(spark):
    text = " ".join(prose(7, 80))
    rows = [(1, text, "en", f"s{k}", k, f"x{k}", k) for k in (4, 2, 9, 0, 5)] + [(1, text, "en", None, 3, "y", 3), (2, text, "en", "s", 1, "z", 1)]
    rows += [(None, "", "en", "s", 1, "z", 1)] * 2
    got = [representatives(spark.createDataFrame(rows, SCHEMA).repartition(n)).collect() for n in (1, 2, 5)]
    assert got[0] == sorted(got[0], key=str) or len(got[0]) == 3
    assert all(Counter(map(tuple, g)) == Counter(map(tuple, got[0])) for g in got)
    assert Counter(map(tuple, got[0])) == Counter([(1, text, "en", None, 3, "y", 3), rows[-1], rows[-1]])


@pytest.mark.parametrize("labelled_bad", [1, 4, 5])
def test_few_bad_labels_are_enough(spark, labelled_bad):
    rows = [(i, ("buy cheap pills now click here " * 12 if i % 50 == 0 else " ".join(prose(i + 1, 80))), "en", "s", 1, "", 0) for i in range(400)]
    bad = [i for i in range(400) if i % 50 == 0]
    labels = [(i, 0) for i in bad[:labelled_bad]] + [(i, 1) for i in range(400) if i % 50 and i % 2]
    out = quality_scores(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len({r.score for r in out}) > 10
    rejected = {r.doc_id for r in out if not r.kept}
    assert rejected <= set(bad) and len(rejected) >= (8 if labelled_bad > 1 else 1)


def test_labelled_ids_beyond_the_bound_are_joined(spark, docs, monkeypatch):
    from medallion.llm import cotraining

    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 24)], "doc_id long, quality int")
    want = {(r.doc_id, r.score) for r in quality_scores(docs, labels).collect()}
    monkeypatch.setattr(cotraining, "MOST_IDS", 3)
    assert {(r.doc_id, r.score) for r in quality_scores(docs, labels).collect()} == want


def test_models_are_summed_in_a_tree(spark, monkeypatch):
    import numpy as np

    from medallion.llm import cotraining

    monkeypatch.setattr(cotraining, "FAN_IN", 3)
    parts = [(i, 1, cotraining.dump({"wt": np.full(4, float(i)), "wm": np.array([1.0, i])})) for i in range(11)]
    mean = cotraining._mean_model(spark.createDataFrame(parts, cotraining._MODEL).repartition(4), 11)
    assert np.allclose(mean["wt"], 5.0) and np.allclose(mean["wm"], [1.0, 5.0])
