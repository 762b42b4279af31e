"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.collocations import collocations
from medallion.llm.common import read
from medallion.llm.conversations import damaged, repair_summary
from medallion.llm.cotraining import quality_scores
from medallion.llm.decontaminate import contaminated_pairs
from medallion.llm.jaccard import near_duplicates
from medallion.llm.license_join import BASE_PHRASES, TEMPLATES, license_scan, split_words
from medallion.llm.line_dedup import line_dedup
from medallion.llm.mixing import DEFAULT_SCHEDULE, mix_plan
from medallion.llm.quality import quality_table
from medallion.llm.substring_dedup import substring_dedup
from medallion.llm.token_count import token_counts
from medallion.llm.toxicity import severity
from medallion.llm.url_filter import url_filter

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(read(spark, sf_dir, "documents"))
    first = F.array_min(F.transform("copies", lambda c: c["position"]))
    return (plan.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position"))
            .repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = quality_table(read(spark, sf_dir, "documents"))
    return t.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = substring_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"), URL_RULES).drop("redirect_class")


def op11_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_summary(damaged(read(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_jaccard_join, op2_mixing, op3_token_counts, op4_quality_rules, op5_substring_dedup,
                                   op6_cotraining, op7_toxicity, op8_line_dedup, op9_decontaminate, op10_url_filter,
                                   op11_license_join, op12_collocations, op13_conversation_repair)}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRIM = r"'\x20\x09-\x0D'"

_OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')")} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a AS u, b AS v FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT u, min(v) AS component_id FROM r GROUP BY u) c ON s.doc_id = c.u"""

_OP2 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size,
    md5(CAST(doc_id AS VARCHAR)) AS ord FROM documents),
p AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight
  FROM d GROUP BY source),
q AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM p),
l AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
    sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap AS capped,
    sum(weight) OVER () - sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING) + weight AS rest
  FROM q),
v AS (SELECT *, (budget - capped) / rest AS level FROM l),
b AS (SELECT level FROM v WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, weight, source_size, coalesce(least(cap, (SELECT level FROM b) * weight), cap) AS target FROM q),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS bgn,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS f,
    CASE t.weight WHEN 5 THEN {{s0}} WHEN 2 THEN {{s1}} ELSE {{s2}} END AS x, CASE t.weight WHEN 5 THEN {{e0}} WHEN 2 THEN {{e1}} ELSE {{e2}} END AS y
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
z AS (SELECT *, f * size + greatest(0, least(size, CAST(floor(target - f * source_size) AS BIGINT) - bgn)) AS taken,
        least(1.0::DOUBLE, bgn / target) AS u FROM r)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CASE WHEN x = y THEN u ELSE (-x + sqrt(x * x + (y - x) * (x + y) * u)) / (y - x) END END AS first_position FROM z"""
for _k, (_s, _e) in enumerate(DEFAULT_SCHEDULE):  # the weights at the start and at the end of training
    _OP2 = _OP2.replace(f"{{s{_k}}}", f"{_s}::DOUBLE").replace(f"{{e{_k}}}", f"{_e}::DOUBLE")

_OP5 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
h AS (SELECT doc_id, i FROM x WHERE g IN (SELECT g FROM x GROUP BY g HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + k AS p FROM h, range(35) t(k)),
r AS (SELECT doc_id, list(p) AS ps FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ')
    ELSE coalesce(array_to_string(list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_contains(ps, i) THEN NULL ELSE w[i] END),
      lambda z: z IS NOT NULL), ' '), '') END) AS kept_sha256
FROM w LEFT JOIN r ON w.doc_id = r.doc_id"""

_OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT r, doc_id, line, pos, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
      '{_UP}', '{_LOW}') AS key FROM l),
hot AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, hot.key IS NOT NULL AS drop FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN drop THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN drop THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""


def _node(url: str) -> str:
    return (f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || {_path(url)} || "
            f"coalesce(regexp_extract({url}, '://[^?#]*(\\?[^#]*)', 1), '') END")


def _host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '')"


_FITS = "(h.host = r.rh OR ends_with(h.host, '.' || r.rh)) AND starts_with(h.path, r.rp)"
_RULES = ", ".join(f"('{r}', '{v}', '{r.split('/')[0]}', '/{r.split('/', 1)[1]}')" for v, r in URL_RULES)
_LINK = (r"CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN starts_with(l, '//') THEN 'http:' || l "
         r"WHEN starts_with(l, '/') THEN regexp_extract(url, '^([^:]*://[^/?#]*)', 1) || l "
         r"WHEN NOT regexp_matches(l, '^([A-Za-z][A-Za-z0-9+.-]*:|[?#])') THEN regexp_extract(url, '^([^:]*://[^/?#]*)', 1) || "
         r"CASE WHEN regexp_extract(" + _path("url") + r", '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(" + _path("url")
         + r", '^(.*/)', 1) END || l END")

_OP10 = f"""
WITH RECURSIVE rules(rule, verdict, rh, rp) AS (VALUES {_RULES}),
pg AS (SELECT row_number() OVER () AS k, page_id, url, html, {_host('url')} AS host, {_path('url')} AS path, {_node('url')} AS node FROM pages),
links AS (
  SELECT url, node, regexp_extract(regexp_extract(html, '(?i)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>', 0),
    '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS l FROM pg
  UNION ALL
  SELECT url, node, regexp_extract(regexp_extract(html, '(?i)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>', 0),
    '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1) FROM pg),
tgt AS (SELECT node AS a, {_LINK} AS t FROM links WHERE l <> ''),
e AS (SELECT a, {_node('t')} AS b FROM tgt),
s AS (SELECT a AS u, b AS v FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach AS (SELECT DISTINCT u, u AS v FROM s UNION SELECT reach.u, s.v FROM reach JOIN s ON reach.v = s.u),
h AS (SELECT DISTINCT v AS node, {_host("('x://' || v)")} AS host, {_path("('x://' || v)")} AS path FROM reach),
nr AS (SELECT h.node, arg_max(r.verdict, length(r.rule)) AS verdict FROM h JOIN rules r ON {_FITS} GROUP BY h.node),
cv AS (SELECT reach.u AS node, CASE WHEN bool_or(nr.verdict = 'allow') THEN 'allow' WHEN bool_or(nr.verdict = 'block') THEN 'block' END AS cv
       FROM reach LEFT JOIN nr ON reach.v = nr.node GROUP BY reach.u),
own AS (SELECT h.k, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict FROM pg h JOIN rules r ON {_FITS} GROUP BY h.k)
SELECT pg.page_id, pg.host, pg.path, own.rule, coalesce(own.verdict, cv.cv, 'allow') AS verdict
FROM pg LEFT JOIN own ON pg.k = own.k LEFT JOIN cv ON pg.node = cv.node"""


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_LIC_SETS = [(label, list(dict.fromkeys(split_words(t)))) for label, t in TEMPLATES]
_LIC_TEMPLATES = ", ".join(f"('{label}', {_sql_list(ws)})" for label, ws in _LIC_SETS)
_LIC_STEP = max([32] + [len(split_words(t)) for _, t in TEMPLATES])
_LIC_PHRASES = [(split_words(p), label) for p, label in BASE_PHRASES]
_LIC_AT = ", ".join("list_filter(range(1, len(w) + 1), lambda i: " + " AND ".join(
    f"w[i + {k}] = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(ws)) + f") AS p{n}"
    for n, (ws, _) in enumerate(_LIC_PHRASES))
_LIC_ALL = " || ".join(f"p{n}" for n in range(len(_LIC_PHRASES)))
_LIC_BASE = " || ".join(f"CASE WHEN len(p{n}) > 0 THEN ['{label}'] ELSE CAST([] AS VARCHAR[]) END"
                        for n, (_, label) in enumerate(_LIC_PHRASES))

_OP11 = f"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n_words, {_LIC_AT} FROM w),
t(label, t) AS (VALUES {_LIC_TEMPLATES}),
x AS (SELECT k, unnest(range(0, len(w), {_LIC_STEP})) AS i, w FROM w),
s AS (SELECT k, list_distinct(w[i + 1:i + 2 * {_LIC_STEP}]) AS s FROM x),
m AS (SELECT k, label, len(list_intersect(s, t)) AS o, len(t) AS z FROM s CROSS JOIN t),
f AS (SELECT k, list(DISTINCT label) AS ls, max(o / z) AS score FROM m WHERE 100 * o >= 80 * z GROUP BY k)
SELECT b.doc_id, n_words, CAST(len({_LIC_ALL}) AS BIGINT) AS n_base, CAST(list_min({_LIC_ALL}) - 1 AS BIGINT) AS first_word,
  CAST(list_max({_LIC_ALL}) - 1 AS BIGINT) AS last_word, array_to_string(list_sort(list_distinct({_LIC_BASE})), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(({_LIC_BASE}) || coalesce(ls, CAST([] AS VARCHAR[])))), ',') AS labels,
  coalesce(score, 0.0::DOUBLE) AS score
FROM b LEFT JOIN f ON b.k = f.k"""

_OP12 = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k FROM (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, k, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY lang, phrase, k HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k >= 2),
x AS (SELECT c.lang, c.phrase, c.a, unnest(range(1, c.k)) AS j, string_split(c.phrase, ' ') AS ws FROM c),
s AS (
  SELECT x.lang, x.phrase, x.a, min(struct_pack(score := 1000 * x.a * n.n // (l.a * r.a), j := x.j, l := l.a, r := r.a)) AS b, any_value(n.n) AS n
  FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1:x.j], ' ')
    JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[x.j + 1:], ' ') JOIN n ON n.lang = x.lang
  GROUP BY x.lang, x.phrase, x.a),
i AS (SELECT DISTINCT s.lang, s.phrase FROM s JOIN c ON c.lang = s.lang AND c.a >= s.a AND len(c.phrase) > len(s.phrase)
      AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')),
o AS (SELECT s.lang, s.phrase, a, b.l AS l, b.r AS r, n, b.score AS score,
        row_number() OVER (PARTITION BY s.lang ORDER BY b.score DESC, a DESC, s.phrase) AS rank
      FROM s ANTI JOIN i ON i.lang = s.lang AND i.phrase = s.phrase)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 2000"""


def _edit(state: str, cost: str, letter: str, said: str | None = None) -> str:
    """The path in ``state`` with one more edit, which says ``said``."""
    return (f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}', "
            f"o := {state}.o" + (f" || chr(10) || {said})" if said else ")"))


def _edits(given: str, *states: str) -> str:
    """A row kept or given the role ``given``, from any of ``states``."""
    kept = [f"CASE WHEN NOT gone AND ini = '{given[0]}' THEN {_edit(x, 'extra', 'K', _KEPT)} ELSE {_FAR} END" for x in states]
    return ", ".join(kept + [f"CASE WHEN NOT gone THEN {_edit(x, '3 + extra', 'R', chr(39) + given + ':' + chr(39) + ' || text')} ELSE {_FAR} END"
                             for x in states])


_KEPT = "role || ':' || text"
_ZERO = "struct_pack(c := 0::BIGINT, a := '', o := '')"
_FAR = "struct_pack(c := 1000000::BIGINT, a := '', o := '')"
_SAY_U, _SAY_A = "'user:'", "'assistant:'"
_OPEN = (f"(SELECT * EXCLUDE (U, A), U, least(A, {_edit('U', '3', 'I', _SAY_A)}) AS A FROM (SELECT * EXCLUDE (U), "
         f"least(U, {', '.join(_edit(x, '3', 'I', _SAY_U) for x in 'ESA')}) AS U FROM dp))")

# Paths are compared by cost, then by their letters as text, in place of the weights.
_OP13 = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(key, ''), lambda z: CAST(ascii(z) AS BIGINT)),
    lambda p, y: xor(p // 256, list_reduce([xor(p, y) % 256, 0, 0, 0, 0, 0, 0, 0, 0], lambda q, z: xor(q // 2, 3988292384 * (q % 2))))),
    4294967295) % 20 AS code FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
    ELSE text END AS text, unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE code <> 0),
o AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
e AS (SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare, left(role, 1) AS ini,
        min(i) OVER (PARTITION BY conv_id, role, text) < i AS again, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS prev FROM o),
r AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM e),
q AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM r),
m AS (SELECT conv_id, max(i) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM q GROUP BY conv_id),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, {_ZERO} AS E, {_FAR} AS S, {_FAR} AS U, {_FAR} AS A FROM m
  UNION ALL
  SELECT p.conv_id, q.i, {_edit('E', '4', 'D')}, least({_edit('S', '4', 'D')}, CASE WHEN NOT gone AND ini = 's' THEN {_edit('E', 'extra', 'K', _KEPT)} ELSE {_FAR} END),
    least({_edit('U', '4', 'D')}, {_edits('user', 'E', 'S', 'A')}), least({_edit('A', '4', 'D')}, {_edits('assistant', 'U')})
  FROM {_OPEN} p JOIN q ON p.conv_id = q.conv_id AND q.i = p.i + 1),
f AS (SELECT m.*, least(p.E, p.A) AS b FROM {_OPEN} p JOIN m ON m.conv_id = p.conv_id AND m.m = p.i)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN f ON f.conv_id = c.conv_id"""

ORACLES = {"op1_jaccard_join": _OP1, "op2_mixing": _OP2, "op5_substring_dedup": _OP5, "op8_line_dedup": _OP8,
           "op10_url_filter": _OP10, "op11_license_join": _OP11, "op12_collocations": _OP12,
           "op13_conversation_repair": _OP13}
