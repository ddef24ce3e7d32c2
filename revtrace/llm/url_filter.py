"""URL filter with redirect equivalence.

1. *Rules.* A rule (verdict, host, path) fits its host and all subdomains, if the
   url's path starts with the rule's. The longest fitting rule decides (of equally
   long ones an allowing rule). Rules are a short policy list and become one expression.
2. *Edges.* ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` of a page, and the
   rows of a redirect log (``from_url``, ``to_url``) if one is given, say that two
   urls are one resource. Comments, scripts, styles and textareas count for
   nothing. Targets are resolved against the page's url; ``&amp;`` is read as ``&``.
3. *Classes.* Connected components of the edges by large-star and small-star
   (:mod:`revtrace.operators.graph`): urls are compared by 128-bit digests of host, path (``/`` if
   empty) and query; scheme and fragment do not count, dot segments stay as they are.
   Only edges are shuffled, never pages.
4. *Propagation.* A url with a rule keeps the rule's verdict. One without takes its class's: allowed
   if any member is allowed by a rule (explicit allow outranks block), else blocked if any
   member is blocked, also when that member is no row of the table. A url
   alone, or in a class without rules, is allowed.

The rows of the table are joined with the blocked urls only, one row per url, so a
page that is repeated a million times is a skewed left side that adaptive execution splits.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and no
class: allowed. Null or empty html has no edges. Repeated rows get equal rows; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrace.llm.common import lower_ascii, materialize
from revtrace.operators.graph import components


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style|textarea)\b.*?(?:</(?:script|style|textarea)\s*>|\z)"
TAG = r"(?is)<(?:link|meta)\s[^<>]*>"
LIKELY = r"(?i)canonical|refresh"


def _ordered(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r.name), r.verdict, r.name))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def ruled(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null."""
    of = [F.when(_fits(r, host, path), F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))) for r in _ordered(rules)]
    return F.coalesce(*of) if of else F.lit(None).cast("struct<name:string,verdict:string>")


def node_of(host: Column, path: Column, query: Column) -> Column:
    """128-bit digest of host, path and query."""
    query = F.when(query != "?", query).otherwise(F.lit(""))
    return F.unhex(F.md5(F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query)))


def _parts(rows: DataFrame, url: str, name: str = "") -> DataFrame:
    """``rows`` with the url's _host, _path and _query; a null or relative url has empty ones."""
    of = lambda k: F.coalesce(F.regexp_extract(url, URL, k), F.lit(""))
    return rows.withColumns({f"_host{name}": lower_ascii(of(1)), f"_path{name}": of(2), f"_query{name}": of(3)})


def _attribute(tag: str, name: str) -> Column:
    """The attribute's value without its quotes, '' if absent."""
    value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.replace(F.regexp_replace(value, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&"))


def _targets(tags: DataFrame) -> DataFrame:
    """``tags`` with ``_to``: what a canonical link or a refresh points at; other tags go."""
    rows = tags.withColumns({"_rel": _attribute("_tag", "rel"), "_kind": _attribute("_tag", "http-equiv")})
    canonical = F.concat(F.lit(" "), F.lower("_rel"), F.lit(" ")).rlike(r"\scanonical\s") & F.col("_tag").rlike("(?i)^<link")
    refresh = (F.lower(F.trim("_kind")) == "refresh") & F.col("_tag").rlike("(?i)^<meta")
    rows = rows.where(canonical | refresh).withColumn("_value", F.when(canonical, _attribute("_tag", "href")).otherwise(_attribute("_tag", "content")))
    to = F.when(canonical, F.col("_value")).otherwise(F.regexp_extract("_value", r"""(?is)url\s*=\s*["']?([^"']*)""", 1))
    return rows.select("from_url", F.regexp_replace(to, r"^\s+|\s+$", "").alias("_to"))


def resolved(link: str) -> Column:
    """The absolute url of a link on a page of ``_host`` and ``_path``; null if it leads nowhere."""
    at, root, path = F.col(link), F.concat(F.lit("http://"), F.col("_host")), F.col("_path")
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (
        F.when(at.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), at)
        .when(at.rlike(r"^$|^#|^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(F.startswith(at, F.lit("//")), F.concat(F.lit("http:"), at))
        .when(F.startswith(at, F.lit("/")), F.concat(root, at))
        .when(F.startswith(at, F.lit("?")), F.concat(root, path, at))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), at))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url): canonical links and refreshes of every whole page, resolved."""
    rows = pages.select(F.col(f"`{url_col}`").alias("from_url"), F.col(f"`{html_col}`").alias("_html"))
    rows = rows.where(F.contains("from_url", F.lit("://")) & F.col("_html").rlike(LIKELY))
    tags = rows.select("from_url", F.explode(F.regexp_extract_all(F.regexp_replace("_html", HIDDEN, " "), F.lit(TAG), F.lit(0))).alias("_tag"))
    # Few tags are left: written, so that later filters do not repeat the work above them.
    tags = materialize(tags.where(F.col("_tag").rlike(LIKELY)), "url-tags")
    found = _parts(_targets(tags), "from_url")
    return materialize(found.select("from_url", resolved("_to").alias("to_url")), "url-links").where("to_url IS NOT NULL")


def blocked_aliases(links: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(_node): the urls of all classes that a block rule reaches and no allow rule does; one row each."""
    rows = links.where(F.contains("from_url", F.lit("://")) & F.contains("to_url", F.lit("://")))
    rows = _parts(_parts(rows, "from_url", "_a"), "to_url", "_b")
    node = lambda s: node_of(*[F.col(f"_{p}_{s}") for p in ("host", "path", "query")]).alias(f"_{s}")
    rule = lambda s: ruled(rules, F.col(f"_host_{s}"), F.col(f"_path_{s}"))["verdict"].alias(f"_v{s}")
    edges = rows.select(node("a"), node("b"), rule("a"), rule("b")).distinct()
    edges = materialize(edges, "url-edges").where("_a <> _b")
    labels = materialize(components(edges, "url-classes"), "url-labels")
    sides = [edges.select(F.col(n).alias("_node"), F.col(v).alias("_verdict")) for n, v in (("_a", "_va"), ("_b", "_vb"))]
    said = reduce(DataFrame.unionByName, sides).where("_verdict IS NOT NULL").distinct()
    classes = said.join(labels, "_node").groupBy("_label").agg(F.max(F.col("_verdict") == "allow").alias("_allowed"))
    return labels.join(classes.where("NOT _allowed"), "_label", "left_semi").select("_node")


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, by_alias (blocked through its class)."""
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    blocked = blocked_aliases(links, rules).withColumn("_blocked", F.lit(True))
    rows = _parts(pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url")), "_url")
    node = F.when(F.contains("_url", F.lit("://")), node_of(F.col("_host"), F.col("_path"), F.col("_query")))
    rows = rows.select("_id", "_host", "_path", node.alias("_node"), ruled(rules, F.col("_host"), F.col("_path")).alias("_rule"))
    rows = rows.join(blocked, "_node", "left")
    through = F.col("_rule").isNull() & F.col("_blocked").isNotNull()
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.name").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(through, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        through.alias("by_alias"),
    )


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    url = quote(r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = lambda c: f"translate(coalesce(regexp_extract({c}, {url}, 1), ''), '{upper}', '{upper.lower()}')"
    path = lambda c: f"coalesce(regexp_extract({c}, {url}, 2), '')"
    query = lambda c: f"replace(regexp_extract({c}, {url}, 3) || '|', '?|', '|')"
    node = lambda c: f"CASE WHEN contains({c}, '://') THEN {host(c)} || CASE {path(c)} WHEN '' THEN '/' ELSE {path(c)} END || {query(c)} END"
    attribute = r"""(?is)\sNAME\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    value = lambda name: (
        f"replace(regexp_replace(regexp_extract(tag, {quote(attribute.replace('NAME', name))}, 1), '^[\"'']|[\"'']$', '', 'g'), '&amp;', '&')"
    )
    values = ", ".join(f"({quote(r.verdict)}, {quote(r.host)}, {quote(r.path)})" for r in RULES)
    hidden = quote(r"(?is)<!--.*?(?:-->|\z)|<(?:script|style|textarea)\b.*?(?:</(?:script|style|textarea)\s*>|\z)")
    return rf"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {values}),
pages_ AS (SELECT row_number() OVER () AS r, page_id, url, html FROM pages),
tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, {hidden}, ' ', 'g'), '(?is)<(?:link|meta)\s[^<>]*>')) AS tag
         FROM pages_ WHERE contains(url, '://')),
targets AS (SELECT url AS base, regexp_replace(CASE
    WHEN tag ILIKE '<link%' AND regexp_matches(' ' || lower({value('rel')}) || ' ', '\scanonical\s') THEN {value('href')}
    WHEN tag ILIKE '<meta%' AND lower(trim({value('http-equiv')})) = 'refresh'
      THEN regexp_extract({value('content')}, '(?is)url\s*=\s*["'']?([^"'']*)', 1) END, '^\s+|\s+$', '', 'g') AS link FROM tags),
links AS (SELECT base, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN regexp_matches(link, '^(#|$)') OR regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN link LIKE '//%' THEN 'http:' || link
    WHEN link LIKE '/%' THEN 'http://' || {host('base')} || link
    WHEN link LIKE '?%' THEN 'http://' || {host('base')} || {path('base')} || link
    ELSE 'http://' || {host('base')} || coalesce(nullif(regexp_extract({path('base')}, '(?s)^(.*/)', 1), ''), '/') || link END AS target FROM targets),
ends AS (SELECT {node('base')} AS a, {node('target')} AS b, base, target FROM links WHERE target IS NOT NULL),
urls AS (SELECT url AS u FROM pages_ UNION SELECT target FROM ends),
judged AS (SELECT u, {node('u')} AS node, {host('u')} AS host, {path('u')} AS path FROM urls),
fits AS (SELECT j.u, max_by({{'name': r.host || r.path, 'verdict': r.verdict}}, length(r.host || r.path)) AS rule
         FROM judged j JOIN rules r ON (j.host = r.host OR ends_with(j.host, '.' || r.host)) AND starts_with(j.path, r.path) GROUP BY j.u),
reach AS (SELECT a, b FROM ends WHERE a <> b UNION SELECT b, a FROM ends WHERE a <> b
          UNION SELECT reach.a, e.b FROM reach JOIN (SELECT a, b FROM ends UNION SELECT b, a FROM ends) e ON e.a = reach.b),
classes AS (SELECT reach.a AS node, bool_or(f.rule.verdict = 'allow') AS allowed
            FROM reach JOIN judged j ON j.node = reach.b JOIN fits f ON f.u = j.u GROUP BY reach.a)
SELECT page_id, j.host, j.path, f.rule.name AS rule,
       coalesce(f.rule.verdict, CASE WHEN c.allowed IS FALSE THEN 'block' ELSE 'allow' END) AS verdict,
       f.rule IS NULL AND c.allowed IS FALSE AS by_alias
FROM pages_ p JOIN judged j ON j.u IS NOT DISTINCT FROM p.url LEFT JOIN fits f ON f.u IS NOT DISTINCT FROM p.url LEFT JOIN classes c ON c.node = j.node
"""


ORACLE_SQL = _sql()
