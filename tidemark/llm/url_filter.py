"""URL block and allow rules that also reach the aliases of a page.

A rule (host, path, verdict) fits a URL on its host or a subdomain whose path starts with the rule's
path; of several, the longest (host and path together, then by text) decides. Redirects (meta refresh, or a
table of them) and canonical links join URLs into groups of aliases: connected components,
computed by joins. Every canonical link and refresh of a page counts, and a URL with an empty path is
the same node as with ``/``. Rules are matched with URLs as they are written, on pages and in links. A URL without a rule
is blocked if a rule blocks a written form of another node in its group; forms of its own node
decide nothing, so its verdict does not depend on whether it has links. An explicit allow always wins
for the URL that it fits, and shields no other alias.

Rules are configuration and become one CASE expression, so their number is checked (MAX_RULES).

Defined cases: a URL that is null or has no ``://`` has an empty host and path, fits no rule and is
allowed; null or empty html has no links; a link to the page itself, or one that cannot be resolved,
is ignored; repeated pages each get their row; an empty table gives no rows; other columns are kept
unless they are named like a result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.plans.materialize import materialize

BLOCK, ALLOW = "block", "allow"
MAX_RULES = 500
RESULTS = ("host", "path", "rule", "verdict")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*(?:\"(?:[^\">]*\s)?canonical(?:\s[^\">]*)?\"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|[\"']?canonical(?=[\"'\s/>]))[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_META = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_GOTO = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z in lower case."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The deciding rule as struct<rule, verdict>; null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; more than {MAX_RULES} do not belong in one expression")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        on_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = on_host & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _resolved(link: Column, base: Column) -> Column:
    """An absolute URL for a link found on the page at `base`, without fragment; null if there is none."""
    plain = F.substring_index(F.replace(link, F.lit("&amp;"), F.lit("&")), "#", 1)
    origin = F.regexp_extract(base, r"^(?s)(.*?://[^/?#]*)", 1)
    scheme = F.substring_index(base, "://", 1)
    folder = F.regexp_extract(base, r"^(?s)(.*?://[^/?#]*(?:/(?:[^?#]*/)?)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(F.length(plain) == 0, None)
        .when(plain.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), plain)
        .when(origin == "", None)
        .when(F.startswith(plain, F.lit("//")), F.concat(scheme, F.lit(":"), plain))
        .when(F.startswith(plain, F.lit("/")), F.concat(origin, plain))
        .when(plain.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .otherwise(F.concat(folder, plain))
    )


def node_of(url: Column) -> Column:
    """The URL as a node of the alias graph: host in lower case, an empty path as /, no fragment."""
    bare = F.substring_index(url, "#", 1)
    head = F.regexp_extract(bare, r"^(?s).*?://[^/?#]*", 0)
    rest = F.substr(bare, F.length(head) + F.lit(1))
    root = F.when((head != "") & ~F.startswith(rest, F.lit("/")), F.lit("/")).otherwise("")
    return F.concat(F.translate(head, _UPPER, _LOWER), root, rest)


def alias_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url), as written, for every canonical link and meta refresh of the pages."""
    html = F.col("html")
    tags = F.concat(
        F.transform(F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)), lambda tag: F.regexp_extract(tag, _HREF, 1)),
        F.transform(F.regexp_extract_all(html, F.lit(_META), F.lit(0)), lambda tag: F.regexp_extract(tag, _GOTO, 1)),
    )
    has_tag = html.rlike(r"(?i)canonical|http-equiv")
    links = pages.where(has_tag).select("url", F.explode(tags).alias("link"))
    return links.select(F.col("url").alias("from_url"), _resolved(F.col("link"), F.col("url")).alias("to_url"))


def _rule(url: Column, rules: list[Rule]) -> Column:
    return rule_for(host_of(url), path_of(url), rules)


def tainted_nodes(links: DataFrame, rules: list[Rule]) -> DataFrame:
    """Nodes that have another node among their aliases of which a written form is blocked."""
    links = materialize(links.where("from_url is not null and to_url is not null"))
    ends = links.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b"))
    groups = materialize(connected_components(ends, "a", "b"))
    written = links.select(F.col("from_url").alias("url")).unionByName(links.select(F.col("to_url").alias("url")))
    blocked = written.where(_rule(F.col("url"), rules)["verdict"] == BLOCK).select(node_of(F.col("url")).alias("node")).distinct()
    # The smallest and the largest blocked node of a group tell whether any other than a given one is.
    ends_of = groups.join(blocked, "node", "left_semi").groupBy("component").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return groups.join(ends_of, "component").where("low <> node or high <> node").select("node")


def judge_urls(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """Add host, path, rule and verdict to pages (url, html, ...).

    `redirects` (from_url, to_url) adds known redirects to those found in the pages.
    """
    links = alias_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    tainted = tainted_nodes(links, rules).select(F.col("node").alias("_alias"))
    url = F.col("_page.url")
    kept = [c for c in pages.columns if c not in RESULTS]
    # The page's own columns stay apart in a struct, whatever their names are.
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_page"))
    judged = rows.withColumns({"host": host_of(url), "path": path_of(url), "_rule": _rule(url, rules), "_node": node_of(url)})
    judged = judged.join(tainted, F.col("_node") == F.col("_alias"), "left")
    by_group = F.when(F.col("_alias").isNotNull(), BLOCK).otherwise(ALLOW)
    return judged.select(
        "_page.*", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", by_group).alias("verdict")
    )
