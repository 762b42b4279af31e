"""URL filters (operator 10): rules on host and path, spread over redirect equivalence.

Rules ``[host]/[path]`` are looked up by every suffix of a page's host in a literal map,
so no join is needed, up to :data:`LITERAL_RULES` rules; more are a table, joined on host suffix and path prefix to the
distinct hosts and paths, with the same result. The longest fitting rule decides; of equally long ones an
allowing one, then the greater text. Pages without a rule of their own take
the decision of their redirect class: the connected component, over redirect and
canonical-link edges between URLs, that the page lies in. A class with a URL that is
explicitly allowed is allowed; otherwise one with a blocked URL is blocked; otherwise the
default holds. A page's own rule always stands (explicit allow precedence).

A URL's node is its host, path and query without scheme and fragment. Edges come from the
pages themselves (``<link rel="canonical">``, ``<meta http-equiv="refresh">``) and, if
given, from a table of observed redirects (``src_url``, ``dst_url``). Edge targets that are
not pages themselves are nodes too, and rules apply to them.

Defined cases: a URL that is NULL or has no ``://`` has an empty host and path, fits no rule and
lies on no edge; NULL html has no links; equal rows get equal answers; NULL page ids are
allowed; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import ascii_lower, session
from medallion.llm.components import components

LITERAL_RULES = 10_000  # rules that are a literal in the plan; more are a table

_HOST, _PATH, _QUERY = r"://([^/?#]*)", r"://[^/?#]*([^?#]*)", r"://[^?#]*(\?[^#]*)"
# Values of an href may be quoted either way or not at all.
_CANONICAL = (r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""")
_REFRESH = (r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""")
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Host, path and query; NULL where the URL has no host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url), F.coalesce(F.regexp_extract(url, _QUERY, 1), F.lit(""))))


def resolve(base: Column, link: Column) -> Column:
    """``link`` as an absolute URL, seen from ``base``; NULL where there is none."""
    link = F.when(link != "", link)
    root = F.regexp_extract(base, r"^([^:]*://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(base), r"^(.*/)", 1)
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .when(~link.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|[?#])"),
                  F.concat(root, F.when(folder == "", "/").otherwise(folder), link)))


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(len, allow, rule), or NULL. ``rules``: (verdict, rule)."""
    if not rules:
        return F.lit(None).cast("struct<len:int,allow:boolean,rule:string>")
    by_host: dict[str, list[Column]] = {}
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        by_host.setdefault(h.lower(), []).append(F.struct(
            F.lit(len(rule)).alias("len"), F.lit(verdict == "allow").alias("allow"), F.lit(rule).alias("rule"),
            F.lit("/" + p).alias("path")))
    table = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*rs))])
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull()))
    fits = F.filter(found, lambda r: path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(r["len"].alias("len"), r["allow"].alias("allow"),
                                                            r["rule"].alias("rule"))))


def match_rules_joined(pairs: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(r_host, r_path, own) of the distinct (host, path) rows of ``pairs`` that some rule fits, by joins: each host's
    suffixes, and of each path the beginnings as long as some rule's path, meet the rules' own."""
    rows = [(h.lower(), "/" + p, len(rule), verdict == "allow", rule)
            for verdict, rule in rules for h, _, p in [rule.partition("/")]]
    table = pairs.sparkSession.createDataFrame(rows, "u_host string, u_path string, len int, allow boolean, rule string")
    sizes = F.array(*[F.lit(n) for n in sorted({len(r[1]) for r in rows})])
    labels = F.split("host", r"\.", -1)
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    begin = F.transform(F.filter(sizes, lambda n: n <= F.char_length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    probe = (pairs.select("host", "path").distinct().withColumn("u_host", F.explode(suffix)).withColumn("u_path", F.explode(begin)))
    return (probe.join(table, ["u_host", "u_path"]).groupBy(F.col("host").alias("r_host"), F.col("path").alias("r_path"))
            .agg(F.max(F.struct("len", "allow", "rule")).alias("own")))


def _with_rules(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``df`` (host, path) with ``own``, the longest fitting rule."""
    if len(rules) <= LITERAL_RULES:
        return df.withColumn("own", match_rules(F.col("host"), F.col("path"), rules))
    found = match_rules_joined(df, rules)
    return (df.join(found, (F.col("host") == F.col("r_host")) & (F.col("path") == F.col("r_path")), "left")
            .drop("r_host", "r_path"))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) nodes of canonical links and refresh redirects found in the pages."""
    links = F.array(F.regexp_extract(F.regexp_extract(F.col(html_col), _CANONICAL, 0), _HREF, 1),
                    F.regexp_extract(F.regexp_extract(F.col(html_col), _REFRESH, 0), _URL, 1))
    return (pages.select(F.col(url_col).alias("u"), F.explode(links).alias("l")).filter(F.col("l") != "")
            .select(node_of(F.col("u")).alias("src"), node_of(resolve(F.col("u"), F.col("l"))).alias("dst"))
            .filter(F.col("src").isNotNull() & F.col("dst").isNotNull()))


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None,
               default: str = "allow", id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, redirect_class) for every page."""
    session(pages)
    edges = page_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("src_url")).alias("src"),
                                                   node_of(F.col("dst_url")).alias("dst")).dropna())
    members = components(edges)
    url = F.concat(F.lit("x://"), F.col("node"))
    members = (_with_rules(members.withColumns({"host": host_of(url), "path": path_of(url)}), rules)
               .withColumn("allow", F.col("own.allow")).drop("host", "path", "own"))
    votes = (members.groupBy("root").agg(F.max("allow").alias("any_allow"), F.min("allow").alias("all_allow"))
             .select(F.col("root").alias("v_root"),
                     F.when(F.col("any_allow"), "allow").when(~F.col("all_allow"), "block").alias("class_verdict")))
    classes = (members.join(votes, F.col("root") == F.col("v_root"))
               .select(F.col("node").alias("c_node"), F.col("root").alias("redirect_class"), "class_verdict"))
    u = F.col(url_col)
    out = (pages.select(F.col(id_col).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"),
                        node_of(u).alias("node")))
    out = (_with_rules(out, rules)
           .join(classes, F.col("node") == F.col("c_node"), "left"))
    verdict = (F.when(F.col("own.allow"), "allow").when(~F.col("own.allow"), "block")
               .otherwise(F.coalesce("class_verdict", F.lit(default))))
    return out.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"),
                      "redirect_class")
