"""URL rules, with block decisions spread over redirects and canonical links.

A rule names a host and the start of a path; it fits its host and all subdomains, and the longest
fitting rule decides. Urls without a rule take part in redirect equivalence: urls joined by redirect or
canonical-link edges are aliases (connected components), and where a rule blocks one of them, the
others are blocked too. An explicit allow of a url always stands, whatever its aliases are. Urls that
neither have a rule nor a blocked alias are allowed.

Rules are met by joins: each distinct url is joined on its host's suffixes to the lengths of the rule
paths there, then on suffix and path start to the rules, so neither many rules nor many urls of one
host multiply beyond the lengths a host's rules have.

Defined results: a null url or one without ``://`` has empty host and path, no rule and no aliases and
is allowed; equal urls get equal verdicts; of rules of equal length an allow goes first. Input columns
stay, but for ``host``, ``path``, ``rule`` and ``verdict``, which are replaced. Pages of any length are read
whole; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import LOWER, UPPER
from starmart.llm.components import components

ALLOW, BLOCK = "allow", "block"

_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``, without query and fragment; null where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.regexp_extract(rest, r"^[^?#]*", 0)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/]*([\s\S]*)$", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """The url as a node: scheme and host in lower case, no fragment; null without ``://``."""
    at = F.instr(url, "://")
    scheme = F.translate(F.substring(url, F.lit(1), at - 1), UPPER, LOWER)
    rest = F.substring(url, at + 3, F.length(url))
    query = F.regexp_extract(rest, r"^[^#?]*(\?[^#]*)?", 1)
    return F.when(at > 0, F.concat(scheme, F.lit("://"), host_of(url), path_of(url), query))


def resolved(link: Column, base: Column) -> Column:
    """The absolute url of a link on the page ``base``."""
    root = F.regexp_extract(base, r"^[^/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^([^/?#]*://[^/?#]*(?:/[^/?#]*(?=/))*)", 1)
    return (
        F.when(F.contains(link, F.lit("://")), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, r"^[^/?#]*:", 0), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .when(F.startswith(link, F.lit("#")) | F.startswith(link, F.lit("?")), F.lit(None).cast("string"))
        .otherwise(F.concat(folder, F.lit("/"), link))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """``(url, target)`` of the canonical links and refresh redirects in the pages' html."""

    def targets(tag: str, link: str) -> Column:
        return F.transform(
            F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, link, 1)
        )

    links = F.concat(targets(_CANONICAL, _HREF), targets(_REFRESH, _REFRESH_URL))
    found = pages.select("url", F.explode(links).alias("link")).filter("link != ''")
    link = F.replace(F.col("link"), F.lit("&amp;"), F.lit("&"))
    return found.select("url", resolved(link, F.col("url")).alias("target"))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``(verdict, rule)`` from pairs such as ``("block", "example.org/es/")``."""
    pairs = [F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, rule, rule_verdict)`` of the distinct urls that a rule fits."""
    slash = F.instr("rule", "/")
    split = rules.filter(F.col("verdict").isin(ALLOW, BLOCK) & (slash > 0)).select(
        F.translate(F.substring("rule", F.lit(1), slash - 1), UPPER, LOWER).alias("suffix"),
        F.substring("rule", slash, F.length("rule")).alias("start"),
        "rule",
        "verdict",
    )
    split = split.groupBy("suffix", "start").agg(F.min(F.struct("verdict", "rule")).alias("r"))
    lengths = split.groupBy("suffix").agg(F.collect_set(F.length("start")).alias("lengths"))
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    split_urls = urls.select("url").distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    asked = (
        split_urls.filter("host != ''")
        .select("url", "path", F.explode(suffixes).alias("suffix"))
        .join(lengths, "suffix")
        .select("url", "suffix", "path", F.explode("lengths").alias("n"))
        .filter(F.col("n") <= F.length("path"))
        .select("url", "suffix", F.substring("path", F.lit(1), F.col("n")).alias("start"))
    )
    order = F.struct(-F.length("r.rule"), F.col("r.verdict"), F.col("r.rule"))
    best = asked.join(split, ["suffix", "start"]).groupBy("url").agg(F.min_by("r", order).alias("r"))
    return best.select("url", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("rule_verdict"))


def blocked_aliases(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Keys of the urls that have a blocked alias. ``edges`` holds two columns of urls."""
    a, b = edges.columns
    keys = edges.select(alias_key(F.col(a)).alias("u"), alias_key(F.col(b)).alias("v"))
    members = components(keys)
    blocks = ruled(members.select(F.col("node").alias("url")), rules).filter(F.col("rule_verdict") == BLOCK)
    hit = members.join(blocks.select(F.col("url").alias("node")), "node").select("component").distinct()
    return members.join(hit, "component").select(F.col("node").alias("key"), F.lit(True).alias("alias_blocked"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` (with url and html) and ``host``, ``path``, ``rule`` and ``verdict``.

    ``redirects`` adds edges of two url columns to those found in the html.
    """
    kept = pages.drop("host", "path", "rule", "verdict")
    edges = link_edges(kept)
    if redirects is not None:
        edges = edges.union(redirects)
    found = ruled(kept, rules).withColumnRenamed("rule_verdict", "_rule_verdict")
    blocked = blocked_aliases(edges, rules).withColumnsRenamed({"key": "_key", "alias_blocked": "_alias_blocked"})
    url = F.col("url")
    return (
        kept.join(found, "url", "left")
        .withColumn("_key", alias_key(url))
        .join(blocked, "_key", "left")
        .withColumns(
            {
                "host": host_of(url),
                "path": path_of(url),
                "verdict": F.coalesce(
                    "_rule_verdict", F.when(F.col("_alias_blocked"), F.lit(BLOCK)), F.lit(ALLOW)
                ),
            }
        )
        .drop("_rule_verdict", "_key", "_alias_blocked")
    )
