from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from llm import url_filter as U
from llm.simhash import Union
from tests.llm.conftest import rows_of_sql


def parts(url):
    if not url or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    query = re.match(r"(\?[^#]*)?", rest[len(host) + len(path):])[0]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    return low, path, low + path + query


def rule(host, path):
    fits = []
    for _, text in U.RULES:
        domain, start = text.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append(text)
    return max(fits, key=len, default=None)


VERDICT = {text: verdict for verdict, text in U.RULES}


@pytest.mark.parametrize("url", [
    None, "", "nourl", "http://net", "http://net/", "HTTP://Sub.NET/x?y#z", "a://b://net/x", "://h/p", "http://example.net/en/",
    "http://x.example.net/EN/", "http://example.com/de/a", "http://notexample.com/de/a", "http://ÄÖ.org/fr/é", "ftp://u:p@h.net:80/a",
    "http://h.org?q=/fr/", "http://h.org#/fr/", "http://a.example.net/en", "x" * 5000 + "://net/"])
def test_parts_and_rule(spark, url):
    u = F.col("u")
    host, path, node, found = spark.createDataFrame([(url,)], "u string").select(
        F.coalesce(U.host_of(u), F.lit("")), F.coalesce(U.path_of(u), F.lit("")), F.coalesce(U.node_of(u), F.lit("")),
        U.rule_for(U.host_of(u), U.path_of(u))).first()
    assert (host, path, node) == parts(url)
    assert found == rule(host, path)


def test_links_of_a_page(spark):
    html = """<html><head><link rel="stylesheet" href="/a.css"><LINK REL='alternate canonical' HREF='/c'>
    <meta http-equiv=refresh content="0; URL='rel/x?y=1'"><link href=//h.org/z rel=canonical><link rel=canonical href="mailto:a@b.c">
    <link rel=canonical href="#top"><link rel="canonical" href=""></head>"""
    got = spark.createDataFrame([(html,)], "h string").select(
        U.link_targets(F.col("h"), F.lit("x.org"), F.lit("/d/e"))).first()[0]
    assert got == ["http://x.org/c", "http://h.org/z", "http://x.org/d/rel/x?y=1"]


def test_verdicts_against_union_find(spark, as_tables, tmp_path):
    rng = random.Random(1)
    hosts = ["a.org", "b.org", "c.com", "evil.net", "ok.example.net", "www.example.com"]
    paths = ["/", "/en/1", "/de/2", "/fr/3", "/x?q=1"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths]
    rows = []
    for i in range(60):
        html = None if i % 7 == 0 else "<p>text</p>"
        if i % 3 == 0 and html:
            html += f'<link rel="canonical" href="{rng.choice(urls)}">'
        rows.append((i, rng.choice(urls), html))
    rows += [(90, None, "<link rel=canonical href='http://evil.net/'>"), (91, "no url", None), (None, urls[3], None), (5, rows[5][1], None)]
    # very many pages with one canonical target
    rows += [(200 + i, f"http://many.org/{i}", '<link rel="canonical" href="http://hub.org/">') for i in range(80)]
    nodes, sets = {}, Union(2000)
    number = lambda n: nodes.setdefault(n, len(nodes))
    for _, url, html in rows:
        target = re.search(r"href=[\"'](http[^\"']*)", html or "")
        if target and parts(url)[2]:
            sets.join(number(parts(url)[2]), [number(parts(target[1])[2])])
    blocked = {sets.find(x) for n, x in nodes.items() if VERDICT.get(rule(*parts("x://" + n)[:2])) == "block"}

    def expected(url):
        host, path, node = parts(url)
        own = rule(host, path)
        if own:
            return host, path, own, VERDICT[own]
        return host, path, None, "block" if node in nodes and sets.find(nodes[node]) in blocked else "allow"

    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("x"))
    got = U.op5_urls(spark, as_tables(pages=pages)).collect()
    assert sorted(map(repr, ((r.page_id, *r[1:]) for r in got))) == sorted(
        repr((i, *expected(url))) for i, url, _ in rows)
    assert any(r.rule is None and r.verdict == "block" for r in got)
    assert rows_of_sql(spark, tmp_path, "op5_urls") == sorted(map(repr, map(tuple, got)))


def test_log_edges_and_allow_precedence(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", None), (2, "http://b.org/fr/y", None), (3, "http://c.org/z", None)],
                                  "page_id long, url string, html string")
    log = spark.createDataFrame([("http://a.org/x", "http://t.net/"), ("http://b.org/fr/y", "http://a.org/x")], "src string, dst string")
    got = {r.page_id: r._verdict for r in U.judge(pages, log).select("page_id", "_verdict").collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}
    assert U.judge(pages.limit(0)).count() == 0


def test_character_references_and_dot_segments(spark):
    import html as plain_html
    from urllib.parse import urljoin, urlsplit

    values = ["?page=2&amp;ref=x", "?page=2&#38;ref=x", "?a=1&#x26;b=&#252;&#x1F600;", "/a&sol;b&quot;&apos;&AMP;", "?a=1&b=2&copy=3",
              "?x=&amp;lt;&amp;#38;&#38;amp;", "?a&amp=1&ampx&amp", "&#0;&#xD800;&bogus;"]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", U.decoded(F.col("v")).alias("d")).collect()
    for r in got[:-1]:
        if "copy" not in r.v and "&ampx" not in r.v:
            assert r.d == plain_html.unescape(r.v)
    assert got[4].d == values[4] and got[6].d == "?a&amp=1&ampx&" and got[7].d == values[7]
    links = ["../c", "./c", "../../../c", "x/./../y/", "..", ".", "/a/../b/./c?q=../z", "a/..b/.c/...", "/.."]
    rows = spark.createDataFrame([(f"<link rel=canonical href='{v}'>",) for v in links], "h string").select(
        F.transform(U.link_targets(F.col("h"), F.lit("h.org"), F.lit("/d/e/f")), U.node_of)[0].alias("n")).collect()
    for v, r in zip(links, rows):
        to = urlsplit(urljoin("http://h.org/d/e/f", v))
        assert r.n == "h.org" + to.path + ("?" + to.query if to.query else ""), v


def test_verdicts_reach_aliases_by_references_and_dots(spark):
    pages = spark.createDataFrame([
        (1, "http://a.org/x?page=2&ref=x", None), (2, "http://evil.net/b", '<link rel="canonical" href="http://a.org/x?page=2&amp;ref=x">'),
        (3, "http://b.org/p/q", None), (4, "http://evil.net/c", "<link rel=canonical href='http://b.org/p/z/../q'>")],
        "page_id int, url string, html string")
    assert {r.page_id: r._verdict for r in U.judge(pages).collect()} == dict.fromkeys([1, 2, 3, 4], "block")
