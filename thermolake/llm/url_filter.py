"""URL filter with redirect equivalence: a blocked address takes its aliases along.

Rules name a host and a path prefix and say ``allow`` or ``block``. A rule fits its host and all
subdomains of it when the path of a url starts with its path; of the rules that fit, the one with
the longest text (host and path) decides, of equally long ones the one with the longer host, and
``allow`` before ``block`` where both say the same host and path.

A url that no rule decides is judged by the addresses it is known to be an alias of. Redirects
(``<meta http-equiv="refresh">`` of a page, and rows (url, target) of a crawler's log) and canonical
links (``<link rel="canonical">``) are edges between addresses; connected components over all edges
are sets of aliases. If any address of a component is blocked by a rule, every url of it that no rule
decides is blocked too. An explicit allow has precedence: a url that an allow rule decides stays
allowed whatever its aliases are. It does not clear them, nor does it stop a block from reaching
others through it. A url without rule and without blocked alias is allowed.

An address is host, path without dot segments (``/`` if empty) and query: the scheme and the fragment
do not tell resources apart. References are resolved against the url of their page; those to other
schemes than http and https, or back to the page itself, are no edges. Tags inside comments and
scripts do not count.

Everything is DataFrame functions. Rules are joined by the suffixes of a host, one equality join per
number of labels that occurs in a rule, so neither urls nor rules are grouped or paired; Spark
broadcasts the rules if they are few and splits a hot host otherwise. Components come from stored
rounds of joins and aggregations, so a page that a third of all pages point to is no hot group.

Odd rows: a null url, or one without ``://``, has empty host and path, no rule, no alias and is
allowed; null or empty html has no edges; repeated rows are judged alike, each on its own; an empty
table gives an empty result; only the columns named here are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolake.llm.common import stored
from thermolake.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What a browser does not read as tags.
HIDDEN = r"(?is)<!--.*?-->|<(script|style|template|noscript|textarea|title)\b.*?</\1\s*>"
TAG = r"(?i)<(?:link|meta)\s[^>]*>"
REFRESH = r"""(?is)^[\s\d.]*[;,]?\s*url\s*=\s*["']?\s*([^"']*)"""


@dataclass(frozen=True)
class Rule:
    """A decision for a host with all its subdomains, below a path prefix that starts with ``/``."""

    host: str
    path: str
    verdict: str


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as rows (host, path, verdict)."""
    rows = [F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in rules]
    if not rows:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS verdict WHERE false")
    return spark.range(1).select(F.inline(F.array(*rows)))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """Up to the first ``/``, ``?`` or ``#`` after ``://``, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(of: Column) -> Column:
    """A path with its ``.`` and ``..`` segments worked off."""
    parts = F.split(of, "/")
    last = F.element_at(parts, -1)
    closed = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    kept = F.aggregate(
        F.slice(closed, 2, F.size(closed)),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.when(of.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(of)


def address(url: Column) -> Column:
    """Host, path and query of a url; null without a host."""
    name, rest = host(url), _rest(url)
    below = F.when(path(url) == "", "/").otherwise(_without_dots(path(url)))
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(name != "", F.concat(name, below, query))


def resolved(base: Column, reference: Column) -> Column:
    """A reference as an absolute url; null for one without a target of its own or another scheme."""
    scheme = F.regexp_extract(base, r"^([^:]*):", 1)
    name, below = host(base), path(base)
    site = F.concat(scheme, F.lit("://"), name)
    folder = F.when(below == "", "/").otherwise(F.regexp_extract(below, r"^(.*/)", 1))
    return (
        F.when((reference == "") | reference.startswith("#"), None)
        .when(reference.rlike(r"(?i)^https?://"), reference)
        .when(reference.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), None)
        .when(reference.startswith("//"), F.concat(scheme, F.lit(":"), reference))
        .when(reference.startswith("/"), F.concat(site, reference))
        .when(reference.startswith("?"), F.concat(site, below, reference))
        .otherwise(F.concat(site, folder, reference))
    )


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, quoted or not; empty if it has none."""
    pattern = rf"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])


def page_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between addresses, from the canonical links and refreshes of pages (url, html)."""
    named = pages.select("url", "html").filter(F.lower("html").contains("canonical") | F.lower("html").contains("refresh"))
    tags = named.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", HIDDEN, " "), F.lit(TAG), 0)).alias("tag"))
    is_link = F.col("tag").rlike(r"(?i)^<link")
    canonical = is_link & _attribute(F.col("tag"), "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = ~is_link & (F.lower(F.trim(_attribute(F.col("tag"), "http-equiv"))) == "refresh")
    target = F.when(canonical, _attribute(F.col("tag"), "href")).when(
        refresh, F.regexp_extract(_attribute(F.col("tag"), "content"), REFRESH, 1)
    )
    clean = F.replace(F.regexp_replace(target, r"^\s+|\s+$", ""), F.lit("&amp;"), F.lit("&"))
    # Stored, as the expressions that follow name it often and would each repeat how it is made.
    found = stored(tags.filter(canonical | refresh).select("url", clean.alias("target")), "targets")
    return edges_of(stored(found.select("url", resolved(F.col("url"), F.col("target")).alias("target")), "references"))


def edges_of(redirects: DataFrame) -> DataFrame:
    """Edges (a, b) between addresses from absolute urls (url, target)."""
    both = stored(redirects.select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b")), "addresses")
    return both.filter("a is not null and b is not null and a <> b")


def match(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` (its text) and ``decision`` to rows with columns ``host`` and ``path``; null where
    no rule fits."""
    text = F.concat("host", "path")
    # Compared as a whole: length, length of the host, allow first; the largest wins.
    worth = F.struct(
        F.length(text).alias("size"),
        F.length("host").alias("of_host"),
        (F.col("verdict") == "allow").alias("allow"),
        text.alias("text"),
        "path",
        "verdict",
    )
    by_host = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_set(worth).alias("worth"))
    by_host = by_host.withColumn("labels", F.size(F.split("rule_host", r"\.")))
    best = []
    for labels in sorted(r["labels"] for r in by_host.select("labels").distinct().collect()):
        mine = by_host.filter(F.col("labels") == labels).select("rule_host", F.col("worth").alias(f"worth_{labels}"))
        rows = rows.withColumn("suffix", F.substring_index("host", ".", -labels))
        rows = rows.join(mine, F.col("suffix") == F.col("rule_host"), "left").drop("suffix", "rule_host")
        best.append(F.array_max(F.filter(f"worth_{labels}", lambda r: F.col("path").startswith(r["path"]))))
    if not best:
        none = F.lit(None).cast("string")
        return rows.withColumns({"rule": none, "decision": none})
    top = best[0] if len(best) == 1 else F.greatest(*best)
    used = [c for c in rows.columns if c.startswith("worth_")]
    rows = rows.withColumn("_top", top).withColumns({"rule": F.col("_top.text"), "decision": F.col("_top.verdict")})
    return rows.drop("_top", *used)


def blocked_aliases(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Addresses (node) of components that hold an address blocked by a rule."""
    member = components(edges)
    split = member.select("node", "component", F.regexp_extract("node", r"^[^/?#]*", 0).alias("host"), F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    hit = match(split, rules).filter("decision = 'block'").select("component").distinct()
    return member.join(hit, "component", "left_semi").select("node")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) for pages with page_id, url and html.

    ``rules`` has (host, path, verdict); ``redirects``, if given, (url, target) of a crawler's log.
    """
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(edges_of(redirects))
    blocked = stored(blocked_aliases(edges, rules), "blocked").withColumn("is_alias", F.lit(True))
    own = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    own = match(own, rules).withColumn("node", F.when(F.col("decision").isNull(), address(F.col("url"))))
    verdict = F.coalesce("decision", F.when(F.col("is_alias"), "block").otherwise("allow"))
    return own.join(blocked, "node", "left").select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"))
