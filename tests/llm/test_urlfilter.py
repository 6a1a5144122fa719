"""URL rules and redirect equivalence against plain Python."""

import random
import re

import pytest

from starmart.llm import urlfilter
from starmart.llm.components import components
from starmart.llm.queries import URL_RULES, op4_url_filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def rule_of(url, rules):
    host, path = parts(url)
    fits = []
    for verdict, rule in rules:
        own, slash, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start) and host:
            fits.append((-len(rule), verdict, rule))
    return (min(fits)[2], min(fits)[1]) if fits else (None, None)


def verdicts(urls, edges, rules):
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        group[root(a)] = root(b)
    bad = {root(u) for u in list(group) if rule_of(u, rules)[1] == "block"}
    return [rule_of(u, rules)[1] or ("block" if u in group and root(u) in bad else "allow") for u in urls]


RULES = [*URL_RULES, ("block", "bad.net/"), ("allow", "bad.net/ok"), ("block", "same.net/x"), ("allow", "same.net/x")]


def page(url, canonical=None, refresh=None):
    links = f'<link href="{canonical}" rel=canonical>' if canonical else ""
    links += f'<META http-equiv="refresh" content="0; url={refresh}">' if refresh else ""
    return url, f"<html><head>{links}</head><body>x</body></html>"


def test_rules_and_aliases(spark):
    pages = [
        page("http://a.net/1", canonical="http://b.net/2"),
        page("http://b.net/2", refresh="http://bad.net/3"),
        page("http://c.net/4"),
        page("http://bad.net/ok/5", canonical="/6"),
        page("http://bad.net/ok/5"),
        page("HTTP://Sub.Example.ORG/en/1?x#y"),
        page("http://example.org/en/2"),
        page("http://org"),
        page("http://notexample.org/en/1"),
        page("http://x.com/de/1", canonical="http://y.com/fr/1"),
        page("http://y.com/fr/1"),
        page("http://same.net/xy"),
        ("no scheme", "<link rel=canonical href=http://bad.net/3>"),
        ("", None),
        (None, None),
    ]
    edges = [
        ("http://a.net/1", "http://b.net/2"),
        ("http://b.net/2", "http://bad.net/3"),
        ("http://bad.net/ok/5", "http://bad.net/6"),
        ("http://x.com/de/1", "http://y.com/fr/1"),
    ]
    frame = spark.createDataFrame([(i, *p, "c") for i, p in enumerate(pages)], "page_id long, url string, html string, host string")
    rows = urlfilter.judge(frame, urlfilter.rules_frame(spark, RULES)).orderBy("page_id").collect()
    urls = [u for u, _ in pages]
    assert [r.verdict for r in rows] == verdicts(urls, edges, RULES)
    assert [(r.host, r.path) for r in rows] == [parts(u) for u in urls]
    assert [r.rule for r in rows] == [rule_of(u, RULES)[0] for u in urls]
    assert rows[0].verdict == "block" and rows[3].verdict == "allow" and rows[10].verdict == "allow"
    empty = urlfilter.judge(frame.limit(0), urlfilter.rules_frame(spark, RULES))
    assert empty.collect() == []


def test_redirect_table(spark):
    frame = spark.createDataFrame([(1, "http://q.net/#top", "")], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://q.net/", "http://www.bad.net/z")], "a string, b string")
    rows = urlfilter.judge(frame, urlfilter.rules_frame(spark, RULES), redirects).collect()
    assert rows[0].verdict == "block"


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    noise = random.Random(seed)
    edges = [(noise.randrange(150), noise.randrange(150)) for _ in range(110)]
    edges += [(200, i) for i in range(201, 260)] + [(i, i + 1) for i in range(300, 340)] + [(None, 5), (7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            group[high] = low
    assert found == {x: root(x) for x in group}


def test_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op4_url_filter(spark, sf_dir).collect():
        url = urls.pop(r.page_id)
        rule, verdict = rule_of(url, URL_RULES)
        assert (r.host, r.path) == parts(url) and r.rule == rule and r.verdict == (verdict or "allow")
    assert not urls


def test_other_columns_stay(spark):
    """Also those named as the operator's own steps; those named as its results are replaced."""
    names = ["key", "alias_blocked", "rule_verdict", "suffix", "node"]
    schema = "url string, html string, verdict string, " + ", ".join(f"{n} string" for n in names)
    pages = spark.createDataFrame([("http://a.org/x", "", "old", *names), (None, None, None, *names)], schema)
    rows = urlfilter.judge(pages, urlfilter.rules_frame(spark, [("block", "a.org/")])).collect()
    assert sorted((r.url or "", r.verdict, [r[n] for n in names] == names) for r in rows) == [
        ("", "allow", True),
        ("http://a.org/x", "block", True),
    ]
