"""Operator 3: URL rules, carried over to aliases by redirect and canonical links.

A page's own rule decides it: the longest rule whose host is the url's host or a parent of
it and whose path begins the url's path. A page without a rule takes the verdict of its
aliases: urls joined by canonical links and refresh redirects, in either direction and over any
number of steps. A url is known by its host, its path without dot segments and its query; the
fragment is no part of it. One allowed alias allows them all; otherwise one
blocked alias blocks them; otherwise the page is allowed. Components are Spark jobs
(components.py), so a hub that a third of all pages link to is split like any other.

Rules are a list given by the caller, applied as one expression. A null url, or one without
``://``, has an empty host and path, fits no rule and has no aliases. Null and empty pages
link to nothing; a page's links count wherever they stand in it. Links to other schemes are
none. Repeated rows get the same verdict; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.components import connected_components
from vecloom.session import settled

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query with its question mark) of a url."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"^[^/?#]*[^?#]*(\?[^#]*)", 1)


def without_dots(path: Column) -> Column:
    """The path with its . and .. segments resolved."""

    def step(done: Column, segment: Column) -> Column:
        up = F.regexp_replace(done, "/[^/]*$", "")
        return F.when(segment == ".", done).when(segment == "..", up).otherwise(F.concat(done, F.lit("/"), segment))

    segments = F.split(path, "/")
    done = F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), F.lit(""), step)
    folder = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.when(path.contains("/."), F.concat(done, folder)).otherwise(path)


def url_node(host: Column, path: Column, query: Column) -> Column:
    return F.concat(host, without_dots(path), query)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):
        own_host, own_path = text.split("/", 1)
        fits = (host == own_host) | host.endswith("." + own_host)
        fits = fits & path.startswith("/" + own_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _links(html: Column) -> Column:
    """The targets of canonical links and refresh redirects, as written."""

    def href(tag: Column) -> Column:
        return F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)

    def target(tag: Column) -> Column:
        return F.regexp_extract(tag, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)

    canonical = F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    refresh = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    found = F.concat(F.transform(canonical, href), F.transform(refresh, target))
    found = F.filter(F.transform(found, lambda x: F.replace(x, F.lit("&amp;"), F.lit("&"))), lambda x: x != "")
    likely = html.rlike(r"(?i)canonical|refresh")
    return F.when(likely, found).otherwise(F.array().cast("array<string>"))


def aliases(pages: DataFrame) -> DataFrame:
    """(a, b): urls, as nodes, that one link joins. pages: (host, path, query, node, html)."""
    links = pages.where("host <> ''").select(
        "host", "path", "query", "node", F.explode(_links(F.col("html"))).alias("link")
    )
    scheme = F.regexp_extract("link", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    folder = F.regexp_extract("path", r"^(.*/)", 1)
    absolute = (
        F.when(F.lower(scheme).isin("http", "https"), F.col("link"))
        .when(scheme != "", F.lit(None))
        .when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link"))
        .when(F.col("link").startswith("/"), F.concat(F.lit("x://"), "host", "link"))
        .when(F.col("link").startswith("?"), F.concat(F.lit("x://"), "host", "path", "link"))
        .when(F.col("link").startswith("#"), F.concat(F.lit("x://"), "host", "path", "query"))
        .otherwise(F.concat(F.lit("x://"), "host", F.when(folder == "", "/").otherwise(folder), "link"))
    )
    parts = url_parts(absolute)
    named = links.select(F.col("node").alias("a"), parts[0].alias("host"), url_node(*parts).alias("b"))
    return named.where("host <> ''").select("a", "b")


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    host, path, query = url_parts(F.col(url))
    named = pages.select(
        F.col(page_id).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        query.alias("query"),
        F.when(host != "", url_node(host, path, query)).alias("node"),
        F.col(html).alias("html"),
    )
    parts = connected_components(settled(aliases(named), "aliases"), "a", "b")
    of_node = F.regexp_extract("node", "^([^/?]*)", 1), F.regexp_extract("node", "^[^/?]*([^?]*)", 1)
    _, verdict = rule_for(*of_node, rules)
    parts = settled(parts.withColumn("verdict", verdict), "parts")
    decided = (
        parts.groupBy("component")
        .agg(
            F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked")
        )
        .select(
            "component",
            F.when(F.coalesce("allowed", F.lit(False)), "allow")
            .when(F.coalesce("blocked", F.lit(False)), "block")
            .alias("carried"),
        )
    )
    carried = parts.join(decided, "component").where("carried IS NOT NULL").select("node", "carried")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = named.select("page_id", "host", "path", "node", rule.alias("rule"), verdict.alias("own"))
    return judged.join(carried, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "carried", F.lit("allow")).alias("verdict")
    )
